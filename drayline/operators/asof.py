"""As-of lookups: the nearest earlier or later row of another table, per key.

The relational form (join on the key, filter on time, keep the first by
``row_number``) pairs every row of a key on one side with every row on the
other. Here both sides are stacked and each probe reads the last row seen in
sort order, so the work is one shuffle and one sort per direction, linear in
the input. Several probe columns of the same table share that single pass.

Keys larger than ``rows_per_chunk`` are cut into chunks (see ``chunking``).
Each chunk is completed by at most two extra rows, the nearest ones outside it,
so a chunk can be answered on its own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from drayline.operators.chunking import CHUNK, ROWS_PER_CHUNK, plan_chunks
from drayline.session import cut_lineage

_KIND = "_kind"
_TS = "_ts"
_ROW = "_row"
_HIT = "_hit"


@dataclass(frozen=True)
class Probe:
    """One lookup: the timestamp column to look from, and which way."""

    name: str
    ts: str
    direction: str = "backward"
    inclusive: bool = True

    def __post_init__(self) -> None:
        if self.direction not in ("backward", "forward"):
            raise ValueError(f"direction must be 'backward' or 'forward', got {self.direction!r}")


def _rank(probes: list[Probe], direction: str) -> Column:
    """Place of a row among rows of the same time: rows looked up sit at 1,
    strict probes come before them and inclusive probes after."""
    rank = F.lit(1)
    for kind, probe in enumerate(probes):
        place = 2 if (probe.inclusive and probe.direction == direction) else 0
        rank = F.when(F.col(_KIND) == kind, F.lit(place)).otherwise(rank)
    return rank


def _scan(stacked: DataFrame, parts: list[str], probes: list[Probe], unique: bool) -> DataFrame:
    """Answer every probe from the rows of its own partition.

    Probes hold no row, so the last non-null row is the last one looked up.
    ``unique`` rows need no tie-break in the sort.
    """
    so_far = (W.unboundedPreceding, W.currentRow)
    tie = [] if unique else [F.col(_ROW)]
    directions = {p.direction for p in probes}
    hit = F.lit(None)
    if "backward" in directions:
        order = W.partitionBy(*parts).orderBy(
            F.col(_TS).asc(), _rank(probes, "backward").asc(), *[c.asc() for c in tie]
        )
        stacked = stacked.withColumn("_back", F.last(_ROW, ignorenulls=True).over(order.rowsBetween(*so_far)))
        hit = F.col("_back")
    if "forward" in directions:
        order = W.partitionBy(*parts).orderBy(
            F.col(_TS).desc(), _rank(probes, "forward").asc(), *[c.desc() for c in tie]
        )
        stacked = stacked.withColumn("_ahead", F.last(_ROW, ignorenulls=True).over(order.rowsBetween(*so_far)))
        forward = [kind for kind, p in enumerate(probes) if p.direction == "forward"]
        hit = F.when(F.col(_KIND).isin(forward), F.col("_ahead")).otherwise(hit)
    return stacked.where(F.col(_KIND).isNotNull()).withColumn(_HIT, hit)


def _with_neighbour_rows(
    rows: DataFrame, points: DataFrame, on: list[str]
) -> DataFrame:
    """For each chunk of a key: the last looked-up row before it and the first after it."""
    edges = rows.groupBy(*on, CHUNK).agg(F.min(_ROW).alias("_first"), F.max(_ROW).alias("_last"))
    wanted = points.select(*on, CHUNK).distinct()
    both = edges.unionByName(wanted, allowMissingColumns=True).groupBy(*on, CHUNK).agg(
        F.max("_first").alias("_first"), F.max("_last").alias("_last")
    )
    # One row per key and chunk, so these windows stay small for any key.
    up = W.partitionBy(*on).orderBy(F.col(CHUNK).asc()).rowsBetween(W.unboundedPreceding, -1)
    down = W.partitionBy(*on).orderBy(F.col(CHUNK).desc()).rowsBetween(W.unboundedPreceding, -1)
    outside = both.select(
        *on,
        CHUNK,
        F.array(
            F.last("_last", ignorenulls=True).over(up),
            F.last("_first", ignorenulls=True).over(down),
        ).alias("_outside"),
    )
    return (
        outside.select(*on, CHUNK, F.explode("_outside").alias(_ROW))
        .where(F.col(_ROW).isNotNull())
        .withColumn(_TS, F.col(f"{_ROW}.{_TS}"))
    )


def asof_lookup(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    right_ts: str,
    values: list[str],
    probes: list[Probe],
    row_id: list[str],
    tie_break: list[str] | None = None,
    right_unique: bool = False,
    rows_per_chunk: int | None = ROWS_PER_CHUNK,
    within: int | None = None,
) -> DataFrame:
    """Add, for each probe, the ``values`` of the nearest row of ``right``.

    ``row_id`` identifies a row of ``left``. Results appear as
    ``<probe>_<value>`` and ``<probe>_<right_ts>``; a probe that finds nothing
    leaves nulls and the row stays. Among rows of equal key and time the
    largest ``tie_break`` wins backward and the smallest forward. ``within``
    drops answers further away than that many seconds. ``rows_per_chunk=None``
    skips the measurement of key sizes (for input known to be even).
    ``right_unique`` promises at most one row of ``right`` per key and time.
    """
    ties = tie_break or []
    payload = F.struct(
        F.col(right_ts).alias(_TS), *[F.col(c).alias(f"_tie{i}") for i, c in enumerate(ties)],
        *[F.col(v).alias(f"_v{i}") for i, v in enumerate(values)],
    )
    rows = right.where(F.col(right_ts).isNotNull()).select(*on, F.col(right_ts).alias(_TS), payload.alias(_ROW))
    for key in on:
        rows = rows.where(F.col(key).isNotNull())

    instants = F.array(
        *[F.struct(F.lit(kind).alias(_KIND), F.col(p.ts).alias(_TS)) for kind, p in enumerate(probes)]
    )
    points = left.select(*on, *row_id, F.explode(instants).alias("_p")).select(
        *on, *row_id, F.col(f"_p.{_KIND}").alias(_KIND), F.col(f"_p.{_TS}").alias(_TS)
    ).where(F.col(_TS).isNotNull())
    for key in on:
        points = points.where(F.col(key).isNotNull())

    plan = None
    if rows_per_chunk is not None:
        sizes = rows.select(*on, _TS).unionByName(points.select(*on, _TS))
        # Counting needs the keys only; each row of the left side stands for its probes.
        weighted = rows.select(*on, F.lit(1).alias("_w")).unionByName(
            left.select(*on, F.lit(len(probes)).alias("_w"))
        )
        plan = plan_chunks(sizes, on, _TS, rows_per_chunk, weighted)

    if plan is None:
        stacked = rows.unionByName(points, allowMissingColumns=True)
        answers = _scan(stacked, on, probes, right_unique).select(*row_id, _KIND, _HIT)
    else:
        parts = []
        if on:
            cold = plan.cold(rows).unionByName(plan.cold(points), allowMissingColumns=True)
            parts.append(_scan(cold, on, probes, right_unique).select(*row_id, _KIND, _HIT))
        hot_rows = plan.hot(rows)
        if not right_unique:
            both = hot_rows.groupBy(*on, _TS).agg(F.min(_ROW).alias("_a"), F.max(_ROW).alias("_b"))
            hot_rows = both.select(
                *on, _TS, F.explode(F.array_distinct(F.array("_a", "_b"))).alias(_ROW)
            )
        # Read twice below: for the edges of the chunks and for the scan.
        hot_rows = cut_lineage(plan.assign(hot_rows, _TS), "asof")
        hot_probes = plan.hot(points)
        # Equal probes have equal answers: look each instant up once, join the
        # answers back. AQE splits that join where one instant is very common.
        instants_once = plan.assign(hot_probes.select(*on, _KIND, _TS).distinct(), _TS)
        stacked = hot_rows.unionByName(
            _with_neighbour_rows(hot_rows, instants_once, on), allowMissingColumns=True
        ).unionByName(instants_once, allowMissingColumns=True)
        found = _scan(stacked, [*on, CHUNK], probes, right_unique).select(*on, _KIND, _TS, _HIT)
        parts.append(hot_probes.join(found, [*on, _KIND, _TS]).select(*row_id, _KIND, _HIT))
        answers = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    # One row per probe kind: the maximum is that row's value, and unlike
    # "first" it aggregates in a hash table without sorting.
    fields = [_TS, *[f"_v{i}" for i in range(len(values))]]
    names = [right_ts, *values]
    wide = answers.groupBy(*row_id).agg(
        *[
            F.max(F.when(F.col(_KIND) == kind, F.col(_HIT)[field])).alias(f"{probe.name}_{name}")
            for kind, probe in enumerate(probes)
            for field, name in zip(fields, names)
        ]
    )
    outputs = []
    for probe in probes:
        at = F.col(f"{probe.name}_{right_ts}")
        for name in names:
            value = F.col(f"{probe.name}_{name}")
            if within is not None:
                gap = F.unix_micros(F.col(probe.ts).cast("timestamp")) - F.unix_micros(at.cast("timestamp"))
                value = F.when(F.abs(gap) <= F.lit(within * 1_000_000), value)
            outputs.append(value.alias(f"{probe.name}_{name}"))
    return left.join(wide, row_id, "left").select(*[left[c] for c in left.columns], *outputs)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    left_ts: str,
    right_ts: str,
    values: list[str],
    row_id: list[str],
    direction: str = "backward",
    inclusive: bool = True,
    prefix: str = "asof",
    **options,
) -> DataFrame:
    """Single-probe form of :func:`asof_lookup`."""
    probe = Probe(prefix, left_ts, direction, inclusive)
    return asof_lookup(left, right, on, right_ts, values, [probe], row_id, **options)


def bounded_by_batch(
    series: DataFrame,
    batch: DataFrame,
    series_ts: str,
    start_ts: str,
    end_ts: str,
    buffer: str = "2 hours",
    lookback: str | None = None,
) -> DataFrame:
    """Keep the rows of ``series`` inside the time window that ``batch`` spans.

    The window is one row of two aggregates, read first so that it reaches the
    scan of ``series`` as a literal and prunes files and row groups.
    """
    span = batch.agg(F.min(start_ts).alias("start"), F.max(end_ts).alias("end"))
    low, high = F.col("start"), F.col("end") + F.expr(f"interval {buffer}")
    if lookback:
        low = low - F.expr(f"interval {lookback}")
    data_type = series.schema[series_ts].dataType
    row = span.select(low.cast("timestamp").alias("low"), high.cast("timestamp").alias("high")).select(
        F.unix_micros("low").alias("low"), F.unix_micros("high").alias("high")
    ).first()
    if row is None or row["low"] is None:
        return series.limit(0)
    low_lit = F.timestamp_micros(F.lit(row["low"])).cast(data_type)
    high_lit = F.timestamp_micros(F.lit(row["high"])).cast(data_type)
    return series.where(F.col(series_ts).between(low_lit, high_lit))
