"""Splitting of ordered groups that are too large for one task.

A window over ``partitionBy(key)`` sends every row of a key to one task. When
one key holds a large share of all rows, that task becomes the whole job. The
functions here measure the group sizes first (one count with map-side
combining), and only where some key exceeds the limit cut those keys into
consecutive chunks. Every such key gets cuts of its own, as many as its size
asks for: a sample with a fixed number of rows for each chunk is sorted by key
and cut at equal steps. Cuts are values of the order column of whatever type,
or of several order columns together, so that rows which tie in the first are
split too. They are stored once, so the split is the same in every stage and
every retry.

The number of hot keys and of cuts is at most the number of rows over half the
limit, which is what makes their tables small enough to broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from drayline.session import cut_lineage

ROWS_PER_CHUNK = 5_000_000
#: Sampled rows for each chunk, and how many of them lie between two cuts.
SAMPLE_PER_CHUNK = 200
SAMPLES_BETWEEN_CUTS = 160

CHUNK = "_chunk"
_ORDER = "_order_value"


def bisect(values: Column, wanted: Column, steps: int) -> Column:
    """How many values of a sorted array are at most ``wanted``; the array holds fewer than ``2**steps``."""
    widths = F.array(*[F.lit(1 << k) for k in reversed(range(steps))])
    return F.aggregate(
        widths, F.lit(0), lambda at, w: F.when(F.get(values, at + w - 1) <= wanted, at + w).otherwise(at)
    )


def _position(order: str | list[str]) -> Column:
    """The value by which rows are cut; several columns count one after another, nulls first."""
    if isinstance(order, str):
        return F.col(order)
    return F.struct(*[F.col(c) for c in order]) if len(order) > 1 else F.col(order[0])


@dataclass(frozen=True)
class ChunkPlan:
    """Which keys are hot and where each of them is cut."""

    keys: tuple[str, ...]
    cuts: DataFrame  # the keys as _hot_<key>, and their _cuts
    steps: int

    def _match(self) -> Column:
        """Null-safe match of a table's keys with the hot keys; without keys there is one group, always hot."""
        return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in self.keys])

    def hot(self, df: DataFrame) -> DataFrame:
        """Rows of hot keys only."""
        return df.join(F.broadcast(self.cuts), self._match(), "left_semi") if self.keys else df

    def cold(self, df: DataFrame) -> DataFrame:
        """Rows of all other keys."""
        return df.join(F.broadcast(self.cuts), self._match(), "left_anti") if self.keys else df.limit(0)

    def assign(self, df: DataFrame, order: str | list[str]) -> DataFrame:
        """Add the chunk number of each row; a key that is not hot is one chunk."""
        if self.keys:
            marked = df.join(F.broadcast(self.cuts), self._match(), "left")
        else:  # one group: its one row of cuts is known when the job runs
            marked = df.select("*", self.cuts.select("_cuts").scalar().alias("_cuts"))
        chunk = F.coalesce(bisect(F.col("_cuts"), _position(order), self.steps), F.lit(0))
        return marked.withColumn(CHUNK, chunk).drop("_cuts", *[f"_hot_{k}" for k in self.keys])


def plan_chunks(
    rows: DataFrame,
    keys: list[str],
    order: str | list[str],
    rows_per_chunk: int = ROWS_PER_CHUNK,
    weighted: DataFrame | None = None,
) -> ChunkPlan | None:
    """Measure the groups; ``None`` means no group is larger than ``rows_per_chunk``.

    ``weighted`` replaces the rows in the count: key columns and a weight ``_w``.
    """
    size = F.count(F.lit(1)) if weighted is None else F.sum("_w")
    counts = (rows if weighted is None else weighted).groupBy(*keys).agg(size.alias("_n"))
    large = counts.where(F.col("_n") > rows_per_chunk)
    if large.isEmpty():
        return None
    large = cut_lineage(large, "hot-keys")
    named = large.select(*[F.col(k).alias(f"_hot_{k}") for k in keys])
    chosen = rows.select(*keys, _position(order).alias(_ORDER)).where(F.col(_ORDER).isNotNull())
    if keys:
        chosen = chosen.join(F.broadcast(named), ChunkPlan(tuple(keys), named, 0)._match(), "left_semi")
    # A sample decides where to cut. Any cuts give the right result; good ones give even chunks.
    if rows_per_chunk > SAMPLE_PER_CHUNK:
        chosen = chosen.sample(SAMPLE_PER_CHUNK / rows_per_chunk, seed=11)
        between = SAMPLES_BETWEEN_CUTS
    else:
        between = max(1, rows_per_chunk * 4 // 5)
    values = chosen.groupBy(*keys).agg(F.sort_array(F.collect_list(_ORDER)).alias("_sample"))
    cut = F.filter("_sample", lambda _, i: (i > 0) & (i % between == 0))
    cuts = values.select(*[F.col(k).alias(f"_hot_{k}") for k in keys], F.array_distinct(cut).alias("_cuts"))
    if not keys and values.isEmpty():
        return None
    cuts = cut_lineage(cuts, "cuts")
    most = cuts.agg(F.max(F.size("_cuts"))).first()[0] or 0
    return ChunkPlan(tuple(keys), cuts, max(1, most.bit_length()))


def _same(columns: list[str]) -> Column:
    """Null-safe equality of columns between the sides ``l`` and ``r``."""
    return reduce(lambda a, b: a & b, [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in columns])


def number_rows(
    df: DataFrame,
    keys: list[str],
    order_col: str,
    tie_break: list[str],
    name: str,
    descending: bool = True,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """``row_number`` over an order column and its tie-breaks, for keys of any size.

    Rows of one order value are cut by the tie-breaks. Inside a chunk rows are numbered by a window; the number of rows in the
    chunks before it comes from the chunk sizes.
    """
    order = [F.col(c).desc() if descending else F.col(c).asc() for c in [order_col, *tie_break]]
    cut_by = [order_col, *tie_break]
    plan = plan_chunks(df, keys, cut_by, rows_per_chunk)
    if plan is None:
        return df.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    chunked = plan.assign(df, cut_by)
    place = F.row_number().over(W.partitionBy(*keys, CHUNK).orderBy(*order))
    # One row per key and chunk.
    chunk_order = F.col(CHUNK).desc() if descending else F.col(CHUNK).asc()
    before = W.partitionBy(*keys).orderBy(chunk_order).rowsBetween(W.unboundedPreceding, -1)
    sizes = chunked.groupBy(*keys, CHUNK).agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    numbered = chunked.withColumn("_place", place)
    return (
        numbered.alias("l")
        .join(offsets.alias("r"), _same([*keys, CHUNK]), "left")
        .select(*[F.col(f"l.{c}") for c in df.columns], (F.col("_place") + F.col("_before")).cast("int").alias(name))
    )


def expanding_stats(
    df: DataFrame,
    keys: list[str],
    order_by: list[str],
    value: str,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Running mean, sample deviation and count of a value per key.

    Adds ``training_avg``, ``training_stddev`` and ``training_set_size``. For
    keys that are cut into chunks the mean and the squared deviations of a
    chunk so far are joined with those of all chunks before it by the pairwise
    formula, which leaves a constant series a deviation of exactly zero and
    agrees with the plain window otherwise. From a NaN or an infinity on the mean
    is what their sum gives and the deviation NaN, split or not.
    """
    so_far = (W.unboundedPreceding, W.currentRow)
    plan = plan_chunks(df, keys, order_by, rows_per_chunk)
    if plan is None:
        window = W.partitionBy(*keys).orderBy(*order_by).rowsBetween(*so_far)
        return df.select(
            "*",
            F.avg(value).over(window).alias("training_avg"),
            F.stddev_samp(value).over(window).alias("training_stddev"),
            F.count(value).over(window).alias("training_set_size"),
        )
    chunked = plan.assign(df, order_by)
    inside = W.partitionBy(*keys, CHUNK).orderBy(*order_by).rowsBetween(*so_far)
    # What has no moments is counted apart: the smallest and the largest such value, NaN being the largest.
    plain = F.col(value).cast("double")
    odd = F.isnan(plain) | (F.abs(plain) == float("inf"))
    chunked = chunked.withColumns({"_x": F.when(~odd, plain), "_odd": F.when(odd, plain)})
    # Means relative to the chunk's first value: exact where all values are equal.
    chunked = chunked.withColumn("_first", F.first("_x", ignorenulls=True).over(inside))
    chunked = chunked.withColumn("_d", F.col("_x") - F.col("_first"))
    measures = {"_n": F.count("_d"), "_m": F.avg("_d"), "_v": F.var_pop("_d"), "_all": F.count(value)}
    kinds = {"_nan": F.isnan("_odd"), "_up": F.col("_odd") == float("inf"), "_down": F.col("_odd") == -float("inf")}
    flags = {name: F.max(F.coalesce(kind.cast("int"), F.lit(0))) for name, kind in kinds.items()}
    measures |= flags
    sizes = chunked.groupBy(*keys, CHUNK).agg(*[m.alias(name) for name, m in measures.items()], F.min("_first").alias("_f"))
    sizes = sizes.withColumn("_m", F.col("_f") + F.col("_m")).drop("_f")
    odd_names, all_names = list(flags), list(measures)

    def join_up(parts: pd.DataFrame) -> pd.DataFrame:
        """What the chunks before each chunk of one key amount to; one row a chunk."""
        parts = parts.sort_values(CHUNK)
        n, mean, squares, seen, odd, before = 0, 0.0, 0.0, 0, (0, 0, 0), []
        for count, m, v, several, *here in zip(*[parts[c] for c in ("_n", "_m", "_v", "_all", *odd_names)], strict=True):
            before.append((n, mean, squares, seen, *odd))
            seen, odd = seen + several, tuple(max(x, y) for x, y in zip(odd, here, strict=True))
            if count:
                step = m - mean if n else 0.0
                mean = mean + step * count / (n + count) if n else m
                squares += v * count + step * step * n * count / (n + count)
                n += count
        for name, column in zip(["_n0", "_m0", "_q0", "_all0", *[f"{c}0" for c in odd_names]], zip(*before, strict=True), strict=True):
            parts[name] = column
        return parts.drop(columns=all_names)

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in sizes.schema.fields if f.name not in measures]
    shape = ", ".join([*fields, "_n0 bigint", "_m0 double", "_q0 double", "_all0 bigint", *[f"{c}0 int" for c in flags]])
    earlier = sizes.groupBy(*keys).applyInPandas(join_up, shape)
    running = chunked.select("*", *[m.over(inside).alias(name) for name, m in measures.items()])
    running = running.withColumn("_m", F.col("_first") + F.col("_m"))
    joined = running.alias("l").join(earlier.alias("r"), _same([*keys, CHUNK]), "left")
    n = F.col("_n") + F.col("_n0")
    step = F.when((F.col("_n") > 0) & (F.col("_n0") > 0), F.col("_m") - F.col("_m0")).otherwise(0.0)
    mean = F.when(F.col("_n0") == 0, F.col("_m")).otherwise(F.col("_m0") + step * F.col("_n") / n)
    squares = F.coalesce(F.col("_v") * F.col("_n"), F.lit(0.0)) + F.col("_q0") + step * step * F.col("_n0") * F.col("_n") / n
    total = F.col("_all") + F.col("_all0")
    nan, up, down = ((F.col(c) + F.col(f"{c}0")) > 0 for c in flags)
    no_number = F.lit(float("nan"))
    average = F.when(nan | (up & down), no_number).when(up, F.lit(float("inf"))).when(down, F.lit(-float("inf"))).when(n > 0, mean)
    spread = F.when((total > 1) & (nan | up | down), no_number).when(total > 1, F.sqrt(squares / (n - 1)))
    return joined.select(
        *[F.col(f"l.{c}") for c in df.columns],
        average.alias("training_avg"),
        spread.alias("training_stddev"),
        total.alias("training_set_size"),
    )


def ordered_values(
    df: DataFrame,
    group_by: list[str],
    order_by: list[str],
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Distinct ``order_by`` values per group with their neighbours.

    Returns the group and order columns, ``n`` (how many rows carry the value)
    and ``previous`` / ``next``: the neighbouring values of the first order
    column, null at the ends. Nulls in the first order column are left out.
    Repeated values are counted before any row is sorted, so a value that makes
    up a large share of the table costs one row.
    """
    first = order_by[0]
    distinct = (
        df.where(F.col(first).isNotNull())
        .groupBy(*group_by, *order_by)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # Counted, perhaps sampled, and then sorted: store the reduced rows once.
    distinct = cut_lineage(distinct, "values")
    plan = plan_chunks(distinct, group_by, first, rows_per_chunk)
    ascending = [F.col(c).asc_nulls_last() for c in order_by]
    if plan is None:
        window = W.partitionBy(*(group_by or [F.lit(0)])).orderBy(*ascending)
        return distinct.withColumn("previous", F.lag(first).over(window)).withColumn(
            "next", F.lead(first).over(window)
        )

    chunked = plan.assign(distinct, first)
    inside = W.partitionBy(*group_by, CHUNK).orderBy(*ascending)
    # One row per group and chunk.
    edges = chunked.groupBy(*group_by, CHUNK).agg(
        F.min(first).alias("_low"), F.max(first).alias("_high")
    )
    along = W.partitionBy(*(group_by or [F.lit(0)])).orderBy(CHUNK)
    edges = edges.withColumn("_before", F.lag("_high").over(along)).withColumn(
        "_after", F.lead("_low").over(along)
    )
    neighbours = chunked.withColumn("_lag", F.lag(first).over(inside)).withColumn(
        "_lead", F.lead(first).over(inside)
    )
    return (
        neighbours.alias("l")
        .join(edges.alias("r"), _same([*group_by, CHUNK]), "left")
        .select(
            *[F.col(f"l.{c}") for c in [*group_by, *order_by, "n"]],
            F.coalesce(F.col("l._lag"), F.col("r._before")).alias("previous"),
            F.coalesce(F.col("l._lead"), F.col("r._after")).alias("next"),
        )
    )
