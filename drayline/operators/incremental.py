"""Incremental loading: watermarks, merges, schema evolution, row-level maintenance.

All functions are DataFrame to DataFrame; ``drayline.sources.tables`` applies
them to stored tables. Watermarks are read first and used as literals, so that
the filter reaches the scan and prunes files.
"""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from drayline.operators.latest import latest_per_key, top_n_per_key


# --- watermarks ----------------------------------------------------------------


def _literals(df: DataFrame, **aggregates: tuple) -> dict[str, Column] | None:
    """Aggregates of an action as literals of their columns' types, ``None`` if the table is empty.

    ``name=(function, column)``. Times travel as text: a Python datetime would
    pass through the time zone of the Python process.
    """
    kinds = {name: df.schema[column].dataType for name, (_, column) in aggregates.items()}
    timed = (T.TimestampType, T.TimestampNTZType)
    row = df.agg(
        *[
            (f(c).cast("string") if isinstance(kinds[name], timed) else f(c)).alias(name)
            for name, (f, c) in aggregates.items()
        ]
    ).first()
    if any(row[name] is None for name in aggregates):
        return None
    return {name: F.lit(row[name]).cast(kinds[name]) for name in aggregates}


def high_watermark(target: DataFrame | None, column: str) -> Any:
    """Largest value of a column, ``None`` for an absent or empty table."""
    if target is None:
        return None
    return target.agg(F.max(column).alias("m")).first()["m"]


def after_watermark(
    source: DataFrame,
    target: DataFrame | None,
    source_col: str,
    target_col: str | None = None,
    inclusive: bool = False,
) -> DataFrame:
    """Rows of ``source`` past the largest value in ``target``; all when it is empty.

    ``inclusive`` reprocesses from the last value itself.
    """
    mark = _literals(target, top=(F.max, target_col or source_col)) if target is not None else None
    if mark is None:
        return source
    bound = mark["top"].cast(source.schema[source_col].dataType)
    return source.where(F.col(source_col) >= bound if inclusive else F.col(source_col) > bound)


def after_offsets(
    source: DataFrame,
    target: DataFrame | None,
    partition_col: str = "_partition_id",
    offset_col: str = "_partition_offset",
) -> DataFrame:
    """Rows past the last stored offset of their stream partition (-1 when none).

    Rows without a partition id are one partition of their own.
    """
    if target is None:
        return source
    marks = target.groupBy(F.col(partition_col).alias("_of")).agg(F.max(offset_col).alias("_mark"))
    return after_marks(source, marks, partition_col, offset_col)


def after_marks(
    source: DataFrame, marks: DataFrame, partition_col: str = "_partition_id", offset_col: str = "_partition_offset"
) -> DataFrame:
    """Rows past the mark (``_mark``) of their stream partition (``_of``); all rows of a partition without one."""
    joined = source.join(marks, F.col(partition_col).eqNullSafe(F.col("_of")), "left")
    return joined.where(F.col(offset_col) > F.coalesce(F.col("_mark"), F.lit(-1))).select(*source.columns)


def matching(df: DataFrame, keys: DataFrame, columns: list[str], how: str = "left_semi") -> DataFrame:
    """Rows whose key is listed (``left_anti``: is not); nulls match nulls."""
    listed = keys.select(*[F.col(c).alias(f"_k_{c}") for c in columns])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in columns])
    return df.join(listed, same, how)


def within_lookback(df: DataFrame, date_col: str, as_of: date, days: int) -> DataFrame:
    """Rows dated no earlier than ``days`` before ``as_of``."""
    return df.where(F.col(date_col) >= F.lit(as_of - timedelta(days=days)))


def context_rows(
    stored: DataFrame, keys: list[str], date_col: str, before: date, rows: int
) -> DataFrame:
    """The last ``rows`` stored rows per key before a date, as context of a rows-frame window."""
    earlier = stored.where(F.col(date_col) < F.lit(before))
    return top_n_per_key(earlier, keys, [F.col(date_col).desc()], rows)


def rows_after_changes(
    fresh: DataFrame, stored: DataFrame, dirty: DataFrame, keys: list[str], date_col: str, rows: int
) -> DataFrame:
    """What a window over the last rows of a key needs when some of its days have changed.

    ``fresh`` are the recomputed rows of the ``dirty`` keys and days (those that
    have none any more are gone), ``stored`` the rows as they were, one a key
    and day. Returns the rows of the dirty keys from ``rows`` rows before their
    first dirty day on, the stored ones replaced, with a flag ``_affected`` on
    those with a dirty day among themselves and the ``rows`` rows before them.
    """
    place = [*keys, date_col]
    first = dirty.groupBy(*[F.col(c).alias(f"_f_{c}") for c in keys]).agg(F.min(date_col).alias("_first"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_f_{c}")) for c in keys])
    kept = matching(stored.select(*fresh.columns), dirty, place, "left_anti").join(first, same)
    before = top_n_per_key(kept.where(F.col(date_col) < F.col("_first")), keys, [F.col(date_col).desc()], rows)
    kept = kept.where(F.col(date_col) >= F.col("_first")).unionByName(before).select(*fresh.columns)
    gone = matching(dirty.select(*place), fresh, place, "left_anti")
    yes, no = F.lit(True), F.lit(False)
    parts = [
        fresh.withColumns({"_live": yes, "_dirty": yes}),
        kept.withColumns({"_live": yes, "_dirty": no}),
        gone.withColumns({"_live": no, "_dirty": yes}),
    ]
    both = parts[0].unionByName(parts[1]).unionByName(parts[2], allowMissingColumns=True)
    w = W.partitionBy(*keys).orderBy(date_col)
    # Rows in place up to here, and how many there were at the last change.
    count = F.sum(F.col("_live").cast("int")).over(w)
    marked = both.withColumn("_n", count).withColumn("_at", F.max(F.when(F.col("_dirty"), F.col("_n"))).over(w))
    near = F.coalesce(F.col("_n") - F.col("_at") <= rows, no)
    return marked.where("_live").select(*fresh.columns, near.alias("_affected"))


# --- merging ----------------------------------------------------------------------


def sync_all_columns(target: DataFrame, source: DataFrame) -> DataFrame:
    """Target reshaped to the source's columns: new ones null, vanished ones dropped."""
    have = set(target.columns)
    return target.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in source.schema.fields
        ]
    )


def append_new_columns(target: DataFrame, source: DataFrame) -> DataFrame:
    """Target with the source's additional columns (null), its own kept."""
    have = set(target.columns)
    extra = [f for f in source.schema.fields if f.name not in have]
    return target.select(
        "*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in extra]
    )


def _aligned(target: DataFrame, source: DataFrame, on_schema_change: str) -> tuple[DataFrame, DataFrame]:
    if on_schema_change == "sync_all_columns":
        return sync_all_columns(target, source), source
    if on_schema_change == "append_new_columns":
        wide = append_new_columns(target, source)
        return wide, append_new_columns(source, wide).select(*wide.columns)
    if on_schema_change == "fail" and set(target.columns) != set(source.columns):
        raise ValueError("source and target columns differ")
    # "ignore": the target's columns decide
    return target, append_new_columns(source, target).select(*target.columns)


def stacked(target: DataFrame, source: DataFrame) -> DataFrame:
    """Both together, in the source's columns."""
    old, new = _aligned(target, source, "sync_all_columns")
    return old.unionByName(new)


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    on_schema_change: str = "sync_all_columns",
) -> DataFrame:
    """Rows of ``source`` replace rows of ``target`` with equal keys; the rest is kept.

    ``source`` must hold one row per key. A null key never matches.
    """
    kept, new = _aligned(target, source, on_schema_change)
    return kept.join(new.select(*keys), keys, "left_anti").select(*new.columns).unionByName(new)


def merge_latest(
    target: DataFrame, source: DataFrame, keys: list[str], version_cols: list[str]
) -> DataFrame:
    """Per key the newest row of both; on equal versions the source wins.

    Repeating a batch or delivering batches out of order gives the same table.
    """
    kept, new = _aligned(target, source, "sync_all_columns")
    both = kept.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    return latest_per_key(both, keys, [*version_cols, "_new"]).drop("_new")


def merge_keep_last(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    deleted: Column,
    keep_columns: list[str],
) -> DataFrame:
    """Upsert in which delete events keep the last known values of ``keep_columns``.

    For feeds whose delete image carries the key only.
    """
    known = target.select(*keys, *[F.col(c).alias(f"_old_{c}") for c in keep_columns])
    filled = source.join(known, keys, "left")
    for c in keep_columns:
        old = F.col(f"_old_{c}")
        filled = filled.withColumn(c, F.when(deleted & F.col(c).isNull(), old).otherwise(F.col(c)))
    return merge_upsert(target, filled.select(*source.columns), keys)


def append_absent(
    target: DataFrame | None,
    source: DataFrame,
    keys: list[str],
    range_col: str | None = None,
) -> DataFrame:
    """Rows of ``source`` whose keys the target lacks.

    ``range_col`` (a key column) limits the target to the value range of the
    batch before the join, so that old files are never read.
    """
    if target is None:
        return source
    existing = target.select(*keys)
    if range_col:
        bounds = _literals(source, low=(F.min, range_col), high=(F.max, range_col))
        if bounds is not None:
            kind = target.schema[range_col].dataType
            existing = existing.where(F.col(range_col).between(bounds["low"].cast(kind), bounds["high"].cast(kind)))
    return source.join(existing, keys, "left_anti").select(*source.columns)


def insert_if_absent(
    target: DataFrame | None, sources: list[DataFrame], keys: list[str], order_by: list[Column]
) -> DataFrame:
    """Stack the sources, keep the first row per key, drop keys already stored."""
    stacked = sources[0]
    for other in sources[1:]:
        stacked = stacked.unionByName(other)
    return append_absent(target, top_n_per_key(stacked, keys, order_by), keys)


def delete_and_insert(
    target: DataFrame,
    insert_rows: DataFrame | None = None,
    delete_keys: DataFrame | None = None,
    key: str | None = None,
) -> DataFrame:
    """Delete rows whose key is null or listed, then add rows."""
    result = target
    if delete_keys is not None:
        result = result.where(F.col(key).isNotNull()).join(
            delete_keys.select(key), key, "left_anti"
        ).select(*target.columns)
    if insert_rows is not None:
        result = result.unionByName(insert_rows, allowMissingColumns=True).select(*target.columns)
    return result


def row_hash(columns: list[str]) -> Column:
    """md5 of the row as JSON, nulls included."""
    return F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))


def diff_by_hash(
    stored: DataFrame, current: DataFrame, hash_col: str = "metadata_hash"
) -> DataFrame:
    """Which rows to add and which to remove so that ``stored`` becomes ``current``.

    Empty when both hold the same hashes.
    """
    added = current.join(stored.select(hash_col), hash_col, "left_anti")
    removed = stored.join(current.select(hash_col), hash_col, "left_anti")
    return added.select(F.lit("add").alias("action"), *current.columns).unionByName(
        removed.select(F.lit("remove").alias("action"), *stored.columns), allowMissingColumns=True
    )


def apply_hash_diff(stored: DataFrame, current: DataFrame, hash_col: str = "metadata_hash") -> DataFrame:
    """Stored rows still current, plus the new ones."""
    kept = stored.join(current.select(hash_col), hash_col, "left_semi")
    new = current.join(stored.select(hash_col), hash_col, "left_anti")
    return kept.unionByName(new.select(*stored.columns))


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """Keep one of fully equal rows; a row holding a null equals no other row."""
    has_null = F.lit(False)
    for c in df.columns:
        has_null = has_null | F.col(c).isNull()
    flagged = df.withColumn("_null", has_null)
    complete = flagged.where(~F.col("_null")).drop("_null").dropDuplicates()
    return complete.unionByName(flagged.where("_null").drop("_null"))


def delete_where(df: DataFrame, predicate: Column | str) -> DataFrame:
    """Rows for which the predicate is not true (false or unknown)."""
    condition = F.expr(predicate) if isinstance(predicate, str) else predicate
    return df.where(~F.coalesce(condition, F.lit(False)))


def day_ranges(sources: list[DataFrame], ts_col: str, pad_days: int = 7) -> DataFrame:
    """Daily ``[range_start, range_end)`` from the first to the last day plus padding."""
    stacked = sources[0].select(ts_col)
    for other in sources[1:]:
        stacked = stacked.unionByName(other.select(ts_col))
    span = stacked.agg(
        F.min(ts_col).cast("date").alias("low"),
        F.date_add(F.max(ts_col).cast("date"), pad_days).alias("high"),
    )
    days = F.explode(F.sequence("low", "high", F.expr("interval 1 day"))).alias("range_start")
    return span.where(F.col("low").isNotNull()).select(days).withColumn(
        "range_end", F.date_add("range_start", 1)
    )


def empty_like(df: DataFrame) -> DataFrame:
    """No rows, same columns."""
    return df.sparkSession.createDataFrame([], df.schema)


def typed_empty(spark, columns: list[tuple[str, str]]) -> DataFrame:
    """No rows, columns given as (name, type)."""
    ddl = ", ".join(f"`{name}` {data_type}" for name, data_type in columns)
    return spark.createDataFrame([], T.StructType.fromDDL(ddl))
