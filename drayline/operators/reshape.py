"""Column selection, pivot, unpivot, union by name, spines and small lookups."""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from drayline.functions import Period, empty_to_null, moment, slugify

MAX_SPINE_ROWS = 1_000_000


# --- columns -----------------------------------------------------------------


def columns_except(df: DataFrame, exclude: list[str] | None = None) -> list[str]:
    """Column names without the excluded ones, compared without case."""
    dropped = {c.lower() for c in exclude or []}
    return [c for c in df.columns if c.lower() not in dropped]


def star(
    df: DataFrame, exclude: list[str] | None = None, prefix: str = "", suffix: str = ""
) -> DataFrame:
    """All columns but the excluded ones, renamed with a prefix and suffix."""
    kept = columns_except(df, exclude)
    if not kept:
        raise ValueError("star() left no columns")
    return df.select(*[F.col(f"`{c}`").alias(f"{prefix}{c}{suffix}") for c in kept])


def columns_ignoring(
    df: DataFrame, prefix: str | None = None, pattern: str | None = None
) -> list[str]:
    """Columns that neither start with ``prefix`` nor match the regular expression."""
    kept = []
    for name in df.columns:
        if prefix and name.lower().startswith(prefix.lower()):
            continue
        if pattern and re.match(pattern, name, flags=re.IGNORECASE):
            continue
        kept.append(name)
    return kept


def nullcheck(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Replace empty strings by null in the string columns."""
    chosen = set(columns or df.columns)
    return df.select(
        *[
            empty_to_null(f.name).alias(f.name)
            if isinstance(f.dataType, T.StringType) and f.name in chosen
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def group_by_first(df: DataFrame, n: int):
    """Group by the first ``n`` columns."""
    return df.groupBy(*df.columns[:n])


# --- pivot / unpivot -----------------------------------------------------------

_COMPARISONS = {
    "=": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    "<>": lambda c, v: c != v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
}
_AGGREGATES = {
    "sum": F.sum,
    "min": F.min,
    "max": F.max,
    "avg": F.avg,
    "count": F.count,
}


def pivot_columns(
    column: str,
    values: list,
    agg: str = "sum",
    cmp: str = "=",
    then_value: Any = 1,
    else_value: Any = 0,
    prefix: str = "",
    suffix: str = "",
    distinct: bool = False,
    quote_identifiers: bool = True,
) -> list[Column]:
    """One aggregate per value, to be used inside ``groupBy().agg(...)``.

    ``then_value`` and ``else_value`` are columns or constants; a string is
    read as an SQL expression.
    """

    def side(value: Any) -> Column:
        if isinstance(value, Column):
            return value
        return F.expr(value) if isinstance(value, str) else F.lit(value)

    compare = _COMPARISONS[cmp]
    columns = []
    for value in values:
        cell = F.when(compare(F.col(column), F.lit(value)), side(then_value)).otherwise(side(else_value))
        if distinct:
            folded = {"count": F.count_distinct, "sum": F.sum_distinct}.get(agg, _AGGREGATES[agg])(cell)
        else:
            folded = _AGGREGATES[agg](cell)
        name = f"{prefix}{value}{suffix}"
        columns.append(folded.alias(name if quote_identifiers else slugify(name)))
    return columns


def pivot(df: DataFrame, group_by: list[str], column: str, values: list, **options) -> DataFrame:
    """Rows to columns. The values are given, so no extra pass collects them."""
    return df.groupBy(*group_by).agg(*pivot_columns(column, values, **options))


def unpivot(
    df: DataFrame,
    keep: list[str] | None = None,
    remove: list[str] | None = None,
    field_name: str = "field_name",
    value_name: str = "value",
    cast_to: str = "string",
) -> DataFrame:
    """Columns to rows in one pass; all values cast to one type, booleans as text."""
    keep = keep or []
    melted = columns_except(df, [*keep, *(remove or [])])
    if not melted:
        raise ValueError("unpivot() has no columns to turn into rows")
    cast = df.select(*keep, *[F.col(c).cast(cast_to).alias(c) for c in melted])
    return cast.unpivot(keep, melted, field_name, value_name)


# --- union ---------------------------------------------------------------------


def union_relations(
    relations: dict[str, DataFrame],
    include: list[str] | None = None,
    exclude: list[str] | None = None,
    column_override: dict[str, str] | None = None,
    source_column_name: str | None = "_source_relation",
    where: str | None = None,
) -> DataFrame:
    """Union by name over the superset of columns; missing columns become null.

    ``relations`` maps a source name to its DataFrame.
    """
    if include and exclude:
        raise ValueError("give either include or exclude, not both")
    if not relations:
        raise ValueError("union_relations() needs at least one relation")
    included = {c.lower() for c in include or []}
    excluded = {c.lower() for c in exclude or []}
    types: dict[str, str] = {}
    chosen: dict[str, list[str]] = {}
    for source, df in relations.items():
        names = [
            c
            for c in df.columns
            if c.lower() not in excluded and (not included or c.lower() in included)
        ]
        chosen[source] = names
        for name, data_type in df.select(*names).dtypes:
            types.setdefault(name, data_type)
    if not types:
        raise ValueError("the include / exclude lists left no columns")
    types.update(column_override or {})
    parts = []
    for source, df in relations.items():
        rows = df.where(where) if where else df
        fields = [
            (F.col(f"`{c}`") if c in chosen[source] else F.lit(None)).cast(t).alias(c)
            for c, t in types.items()
        ]
        if source_column_name:
            fields.insert(0, F.lit(source).alias(source_column_name))
        parts.append(rows.select(*fields))
    return reduce(DataFrame.unionByName, parts)


def union_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.unionByName(right).distinct()


#: Copies that are made from one array at most.
COPIES_PER_ROW = 1 << 12


def repeat_rows(df: DataFrame, times: Column) -> DataFrame:
    """Each row as often as ``times`` says (none for null or less than one).

    Large numbers are first split into blocks, which are dealt over the tasks,
    so neither a row nor a task grows with how often one value occurs.
    """
    counted = df.withColumn("_times", times.cast("bigint")).where(F.col("_times") > 0)
    few, many = counted.where(F.col("_times") <= COPIES_PER_ROW), counted.where(F.col("_times") > COPIES_PER_ROW)
    last = F.col("_times") - 1
    square = COPIES_PER_ROW * COPIES_PER_ROW
    outer = many.withColumn("_outer", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(last / square))))
    left = F.least(F.col("_times") - F.col("_outer") * square, F.lit(square).cast("bigint"))
    blocks = outer.withColumn("_left", left).withColumn(
        "_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_left") - 1) / COPIES_PER_ROW)))
    )
    blocks = blocks.withColumn("_times", F.least(F.col("_left") - F.col("_block") * COPIES_PER_ROW, F.lit(COPIES_PER_ROW).cast("bigint")))
    dealt = blocks.repartition(F.col("_outer"), F.col("_block")).select(*counted.columns)
    copies = few.unionByName(dealt)
    return copies.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_times")))).select(*df.columns)


def except_both_ways(a: DataFrame, b: DataFrame, keep_duplicates: bool = False) -> DataFrame:
    """Rows of either table that the other lacks, marked by ``which_diff``.

    One aggregation over the stacked tables replaces two set differences: the
    rows are hashed to their group once and counted per side.
    """
    names = a.columns
    stacked = (
        a.select(*names, F.lit(1).alias("_a"), F.lit(0).alias("_b"))
        .unionByName(b.select(*names, F.lit(0).alias("_a"), F.lit(1).alias("_b")))
        .groupBy(*names)
        .agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
    )
    if keep_duplicates:
        extra = F.abs(F.col("_a") - F.col("_b"))
        differing = stacked.where(F.col("_a") != F.col("_b"))
        side = F.when(F.col("_a") > F.col("_b"), "a_minus_b").otherwise("b_minus_a")
        return repeat_rows(differing.select(side.alias("which_diff"), *names, "_a", "_b"), extra).select("which_diff", *names)
    one_sided = stacked.where((F.col("_a") == 0) | (F.col("_b") == 0))
    side = F.when(F.col("_b") == 0, "a_minus_b").otherwise("b_minus_a")
    return one_sided.select(side.alias("which_diff"), *names)


# --- values for the caller ---------------------------------------------------------


def column_values(
    df: DataFrame,
    column: str,
    where: str | None = None,
    max_records: int | None = None,
    order_by: list[Column] | None = None,
) -> DataFrame:
    """Distinct values, most frequent first (ties by value), as a DataFrame."""
    rows = df.where(where) if where else df
    counted = rows.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    ordered = counted.orderBy(*(order_by or [F.col("n").desc(), F.col("value").asc_nulls_last()]))
    return ordered.limit(max_records) if max_records is not None else ordered


def get_column_values(
    df: DataFrame | None,
    column: str,
    where: str | None = None,
    max_records: int | None = None,
    default: list | None = None,
    order_by: list[Column] | None = None,
    fetch_limit: int = 100_000,
) -> list:
    """The values of :func:`column_values` as a list, for building column lists.

    A column with more than ``fetch_limit`` distinct values is refused rather
    than pulled to the driver or cut short.
    """
    if df is None:
        if default is None:
            raise ValueError("the relation does not exist and no default was given")
        return default
    values = column_values(df, column, where, max_records, order_by).select("value")
    rows = values.limit(fetch_limit + 1).collect()
    if len(rows) > fetch_limit:
        raise ValueError(f"{column} has more than {fetch_limit} distinct values")
    return [r["value"] for r in rows] or (default if default is not None else [])


def get_single_value(df: DataFrame, default: Any = None) -> Any:
    """First column of the first row, or the default."""
    row = df.first()
    return default if row is None or row[0] is None else row[0]


def get_query_results_as_dict(df: DataFrame, fetch_limit: int = 100_000) -> dict[str, tuple]:
    """Columns of a small result as tuples; larger results are refused."""
    rows = df.limit(fetch_limit + 1).collect()
    if len(rows) > fetch_limit:
        raise ValueError(f"the result has more than {fetch_limit} rows")
    return {c: tuple(r[i] for r in rows) for i, c in enumerate(df.columns)}


# --- spines ------------------------------------------------------------------------


def generate_series(spark: SparkSession, upper_bound: int) -> DataFrame:
    """The numbers 1..n."""
    if upper_bound <= 0:
        raise ValueError("upper bound must be positive")
    return spark.range(1, upper_bound + 1).select(F.col("id").alias("generated_number"))


def date_spine(
    spark: SparkSession, datepart: str, start: date | datetime | str, end: date | datetime | str
) -> DataFrame:
    """Every period start from ``start`` up to but excluding ``end``, as ``date_<datepart>``."""
    if datepart not in ("minute", "hour", "day", "week", "month", "quarter", "year"):
        raise ValueError(f"unsupported date part {datepart!r}")
    step = {"quarter": "3 months"}.get(datepart, f"1 {datepart}")
    kind = "timestamp" if datepart in ("minute", "hour") else "date"
    name = f"date_{datepart}"
    bounds = spark.range(1).select(
        moment(start).alias("s"), moment(end).alias("e")
    )
    steps = F.sequence(F.col("s"), F.col("e"), F.expr(f"interval {step}"))
    instants = F.explode(F.when(F.col("s") < F.col("e"), steps))
    return (
        bounds.select(instants.alias(name), "e")
        .where(F.col(name) < F.col("e"))
        .select(F.col(name).cast(kind).alias(name))
    )


def bucket_spine(spark: SparkSession, start: datetime, end: datetime, bucket: Period) -> DataFrame:
    """Complete buckets between two instants: ``bucket_start``, ``bucket_end``.

    The number of buckets follows from the parameters alone, never from data,
    and is checked; the result is safe to broadcast.
    """
    if bucket.count < 1:
        raise ValueError("a bucket must span at least one period")
    shortest = {"hour": 1, "day": 24, "week": 168, "month": 28 * 24}[bucket.period] * bucket.count
    if (end - start) / timedelta(hours=shortest) > MAX_SPINE_ROWS:
        raise ValueError("the spine would be too long")
    if end <= start:
        empty = T.StructType(
            [T.StructField("bucket_start", T.TimestampType()), T.StructField("bucket_end", T.TimestampType())]
        )
        return spark.createDataFrame([], empty)
    step = F.expr(f"interval {bucket.interval}")
    starts = F.explode(F.sequence(moment(start), moment(end), step))
    return (
        spark.range(1)
        .select(starts.alias("bucket_start"))
        .withColumn("bucket_end", F.col("bucket_start") + step)
        .where(F.col("bucket_end") <= moment(end))
    )
