"""Quantiles of trip durations over any range of days, from one sketch a day and district.

A stored sketch has a bounded size whatever the number of trips, and sketches merge,
so the quantile over a week or a quarter reads one row a day and district instead of
the trips again. Sketches are random within their rank error: two runs over the same
trips may differ inside it. With ``size`` entries at the lowest level the rank error
of a merged sketch is below 2.5 / size with 99 % confidence; a sketch over fewer
different rows than that is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from drayline.sources.tables import PartitionedTable

SKETCH_SIZE = 1024
SKETCH_KEYS = ["trip_date", "district"]


def duration_sketches(trips: DataFrame, size: int = SKETCH_SIZE) -> DataFrame:
    """One sketch of ``total_duration_min`` a day and delivery district, with the number of trips it stands for.

    Deleted trips and those without a duration count nowhere, as in the on-time
    mart. A trip without a district counts under the null district.
    """
    usable = trips.where(~F.col("is_deleted") & F.col("total_duration_min").isNotNull())
    return usable.groupBy("trip_date", F.col("delivery_address").alias("district")).agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.kll_sketch_agg_double("total_duration_min", F.lit(size)).alias("duration_sketch"),
    )


def refresh_sketches(table: PartitionedTable, trips: DataFrame, days: DataFrame | None = None, size: int = SKETCH_SIZE) -> None:
    """Compute the sketches of some days (all, unless ``days`` lists ``trip_date`` values) anew and put them in place.

    A day that has lost all its trips loses its rows.
    """
    if days is None:
        table.overwrite(duration_sketches(trips, size))
        return
    days = days.select("trip_date").distinct()
    fresh = duration_sketches(trips.join(days, "trip_date", "left_semi"), size)
    if table.exists():
        table.replace_keys(fresh, days, ["trip_date"])
    else:
        table.overwrite(fresh)


def with_quantiles(merged: DataFrame, fractions: dict[str, float]) -> DataFrame:
    """Read quantiles from a column ``duration_sketch``, one column each."""
    found = {name: F.kll_sketch_get_quantile_double("duration_sketch", F.lit(float(f))) for name, f in fractions.items()}
    return merged.withColumns(found).drop("duration_sketch")


def duration_quantiles(
    sketches: DataFrame,
    by: list[str | Column],
    fractions: dict[str, float],
    ranges: DataFrame | None = None,
    size: int = SKETCH_SIZE,
) -> DataFrame:
    """Quantiles and numbers of trips per ``by``, over all stored days or over each of some ranges of days.

    ``ranges`` has ``first_day`` and ``last_day``, both included; a day may lie in
    many of them. Days are matched to ranges before anything else is joined, so
    what is repeated is one sketch a day and range.
    """
    keys: list[str | Column] = list(by)
    if ranges is not None:
        spans = ranges.select("first_day", "last_day").distinct()
        days = spans.select("*", F.explode(F.sequence("first_day", "last_day")).alias("trip_date"))
        sketches = sketches.join(days, "trip_date")
        keys = ["first_day", "last_day", *keys]
    merged = sketches.groupBy(*keys).agg(
        F.sum("total_orders").alias("total_orders"),
        F.kll_merge_agg_double("duration_sketch", F.lit(size)).alias("duration_sketch"),
    )
    return with_quantiles(merged, fractions)
