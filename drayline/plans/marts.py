"""Daily marts: on-time delivery, corridors and fleet utilization.

Each mart has a full form and an incremental one. The incremental form reads
only the days being refreshed; what a 7-row window needs from earlier days
comes from the stored mart itself, as the last six rows per key.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from drayline.functions import exact_mean, exact_sum, round_to, safe_divide
from drayline.operators import incremental

# On-time threshold in minutes, refresh range in days, window length in rows.
OTD_THRESHOLD_MIN = 15
LOOKBACK_DAYS = 1
WINDOW_ROWS = 7
FLEET_ROW = "__fleet__"

PERCENTILE_ACCURACY = 10_000


def delivery_tier(minutes: str | Column, threshold: float = OTD_THRESHOLD_MIN) -> Column:
    """``fast``, ``on_time``, ``slightly_late`` or ``late`` against the threshold."""
    value = F.col(minutes) if isinstance(minutes, str) else minutes
    return (
        F.when(value <= threshold * 0.75, "fast")
        .when(value <= threshold, "on_time")
        .when(value <= threshold * 1.25, "slightly_late")
        .otherwise("late")
    )


def _share(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))


def _percentile(column: str, fraction: float) -> Column:
    return F.percentile_approx(column, fraction, PERCENTILE_ACCURACY)


def _usable(trips: DataFrame) -> DataFrame:
    return trips.where(~F.col("is_deleted") & F.col("total_duration_min").isNotNull())


def otd_daily(trips: DataFrame, threshold: float = OTD_THRESHOLD_MIN) -> DataFrame:
    """On-time figures per day and delivery district, without the rolling rate."""
    tier = delivery_tier("total_duration_min", threshold)
    on_time = F.col("total_duration_min") <= threshold
    counted = (
        _usable(trips)
        .withColumn("_tier", tier)
        .groupBy("trip_date", F.col("delivery_address").alias("district"))
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            _share(on_time).alias("on_time_orders"),
            _share(F.col("_tier") == "fast").alias("fast_count"),
            _share(F.col("_tier") == "on_time").alias("on_time_count"),
            _share(F.col("_tier") == "slightly_late").alias("slightly_late_count"),
            _share(F.col("_tier") == "late").alias("late_count"),
            exact_mean("total_duration_min", 1, 1).alias("avg_duration_min"),
            round_to(F.min("total_duration_min"), 1).alias("min_duration_min"),
            round_to(F.max("total_duration_min"), 1).alias("max_duration_min"),
            round_to(_percentile("total_duration_min", 0.9), 1).alias("p90_duration_min"),
        )
    )
    return counted.select(
        "trip_date",
        "district",
        "total_orders",
        "on_time_orders",
        (F.col("total_orders") - F.col("on_time_orders")).alias("late_orders"),
        round_to(safe_divide("on_time_orders", "total_orders"), 4).alias("otd_rate"),
        "fast_count",
        "on_time_count",
        "slightly_late_count",
        "late_count",
        "avg_duration_min",
        "min_duration_min",
        "max_duration_min",
        "p90_duration_min",
    )


def _with_rolling_rate(daily: DataFrame) -> DataFrame:
    window = W.partitionBy("district").orderBy("trip_date").rowsBetween(1 - WINDOW_ROWS, 0)
    rate = safe_divide(F.sum("on_time_orders").over(window), F.sum("total_orders").over(window))
    return daily.withColumn("otd_rate_7d", round_to(rate, 4))


def _refresh_start(as_of: date, lookback_days: int) -> date:
    return as_of - timedelta(days=lookback_days)


def otd(
    trips: DataFrame,
    threshold: float = OTD_THRESHOLD_MIN,
    target: DataFrame | None = None,
    as_of: date | None = None,
    lookback_days: int = LOOKBACK_DAYS,
) -> DataFrame:
    """On-time delivery per day and district with the rate over seven rows.

    With ``target`` and ``as_of`` given, returns only the refreshed days.
    """
    if target is None:
        return _with_rolling_rate(otd_daily(trips, threshold))
    start = _refresh_start(as_of, lookback_days)
    fresh = otd_daily(trips.where(F.col("trip_date") >= F.lit(start)), threshold)
    context = incremental.context_rows(target, ["district"], "trip_date", start, WINDOW_ROWS - 1)
    both = fresh.unionByName(context.select(*fresh.columns))
    return _with_rolling_rate(both).where(F.col("trip_date") >= F.lit(start))


def otd_changed(
    trips: DataFrame, stored: DataFrame, dirty: DataFrame, threshold: float = OTD_THRESHOLD_MIN
) -> DataFrame:
    """The rows of the on-time mart that differ where the trips of some days and districts have changed.

    ``dirty`` lists ``trip_date`` and ``district``; ``trips`` need hold no other
    days. Returned are the rows of the dirty ones and of the six after each.
    """
    place = ["trip_date", "district"]
    found = trips.withColumn("district", F.col("delivery_address"))
    fresh = otd_daily(incremental.matching(found, dirty, place).select(*trips.columns), threshold)
    rows = incremental.rows_after_changes(fresh, stored, dirty, ["district"], "trip_date", WINDOW_ROWS - 1)
    return _with_rolling_rate(rows).where("_affected").drop("_affected")


def district_heatmap(
    trips: DataFrame,
    threshold: float = OTD_THRESHOLD_MIN,
    as_of: date | None = None,
    lookback_days: int = LOOKBACK_DAYS,
    only: DataFrame | None = None,
) -> DataFrame:
    """Volume, distance, duration and on-time rate per day, origin and destination.

    With ``as_of`` given, returns only the refreshed days, with ``only`` the
    listed days and corridors.
    """
    rows = _usable(trips).where(F.col("trip_date").isNotNull())
    if only is not None:
        ends = {"origin_district": F.col("pickup_address"), "destination_district": F.col("delivery_address")}
        rows = incremental.matching(rows.withColumns(ends), only, ["trip_date", *ends]).drop(*ends)
    if as_of is not None:
        rows = rows.where(F.col("trip_date") >= F.lit(_refresh_start(as_of, lookback_days)))
    distance = F.coalesce("total_distance_km", F.lit(0.0))
    return rows.groupBy(
        "trip_date",
        F.col("pickup_address").alias("origin_district"),
        F.col("delivery_address").alias("destination_district"),
    ).agg(
        F.count(F.lit(1)).alias("order_count"),
        exact_mean(distance, 3, 2).alias("avg_distance_km"),
        round_to(F.min(distance), 2).alias("min_distance_km"),
        round_to(F.max(distance), 2).alias("max_distance_km"),
        exact_mean("total_duration_min", 1, 1).alias("avg_duration_min"),
        round_to(_percentile("total_duration_min", 0.5), 1).alias("median_duration_min"),
        exact_mean(F.coalesce("deadhead_ratio", F.lit(0.0)), 4, 4).alias("avg_deadhead_ratio"),
        round_to(
            safe_divide(_share(F.col("total_duration_min") <= threshold), F.count(F.lit(1))), 4
        ).alias("corridor_otd_rate"),
    )


_FLEET_COLUMNS = [
    "metric_date", "truck_id", "model", "capacity_kg", "district", "trips_completed",
    "total_distance_km", "total_duration_min", "avg_deadhead_ratio", "utilization_index",
]


def fleet_daily(activity: DataFrame) -> DataFrame:
    """Trip hours over active hours, per truck-day."""
    index = safe_divide(F.col("total_duration_min") / 60.0, "active_hours")
    return activity.select(
        F.col("activity_date").alias("metric_date"),
        "truck_id",
        "model",
        "capacity_kg",
        F.col("primary_district").alias("district"),
        "trips_completed",
        "total_distance_km",
        "total_duration_min",
        "avg_deadhead_ratio",
        round_to(index, 4).alias("utilization_index"),
    )


def fleet_utilization(
    activity: DataFrame,
    target: DataFrame | None = None,
    as_of: date | None = None,
    lookback_days: int = LOOKBACK_DAYS,
    with_fleet_rows: bool = False,
) -> DataFrame:
    """Utilization per truck-day and its mean over seven rows of the truck.

    ``with_fleet_rows`` adds one row per day for the whole fleet, under truck ``__fleet__``
    (truck ids must be strings).
    """
    start = None
    if target is None:
        daily = fleet_daily(activity)
    else:
        start = _refresh_start(as_of, lookback_days)
        daily = fleet_daily(activity.where(F.col("activity_date") >= F.lit(start)))
        stored = target.where(F.col("truck_id").cast("string") != FLEET_ROW)
        context = incremental.context_rows(stored, ["truck_id"], "metric_date", start, WINDOW_ROWS - 1)
        daily = daily.unionByName(context.select(*_FLEET_COLUMNS))
    rolled = _with_rolling_index(daily)
    if start is not None:
        rolled = rolled.where(F.col("metric_date") >= F.lit(start))
    return rolled.unionByName(_fleet_rows(rolled)) if with_fleet_rows else rolled


def fleet_changed(activity: DataFrame, stored: DataFrame, dirty: DataFrame) -> DataFrame:
    """The rows of the utilization mart that differ where some truck-days have changed.

    ``dirty`` lists ``metric_date`` and ``truck_id``; ``activity`` need hold no
    other days. Returned are the rows of the dirty ones and of the six after each.
    """
    fresh = incremental.matching(fleet_daily(activity), dirty, ["metric_date", "truck_id"])
    rows = incremental.rows_after_changes(fresh, stored, dirty, ["truck_id"], "metric_date", WINDOW_ROWS - 1)
    return _with_rolling_index(rows).where("_affected").drop("_affected")


def _with_rolling_index(daily: DataFrame) -> DataFrame:
    window = W.partitionBy("truck_id").orderBy("metric_date").rowsBetween(1 - WINDOW_ROWS, 0)
    # Mean of whole 1/10000 units: the running sum stays exact as rows enter and leave the frame.
    units = F.round(F.col("utilization_index") * 10_000).cast("bigint")
    mean = safe_divide(F.sum(units).over(window), F.count(units).over(window) * 100)
    return daily.withColumn("utilization_index_7d", round_to(mean, 0) / 100)


def _fleet_rows(rolled: DataFrame) -> DataFrame:
    return rolled.groupBy("metric_date").agg(
        F.lit(FLEET_ROW).alias("truck_id"),
        F.lit(None).cast("string").alias("model"),
        F.sum("capacity_kg").cast(rolled.schema["capacity_kg"].dataType).alias("capacity_kg"),
        F.lit(FLEET_ROW).alias("district"),
        F.sum("trips_completed").alias("trips_completed"),
        exact_sum("total_distance_km", 2).alias("total_distance_km"),
        exact_sum("total_duration_min", 1).alias("total_duration_min"),
        exact_mean("avg_deadhead_ratio", 4, 4).alias("avg_deadhead_ratio"),
        exact_mean("utilization_index", 4, 4).alias("utilization_index"),
        exact_mean("utilization_index_7d", 2, 2).alias("utilization_index_7d"),
    )
