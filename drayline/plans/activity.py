"""Truck-days: what each truck did on each day."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from drayline.functions import exact_mean, time_trunc, to_units, units_mean, units_sum
from drayline.operators import incremental


def hourly_pings(telemetry: DataFrame) -> DataFrame:
    """Ping count and mean speed per truck and hour."""
    return telemetry.groupBy(
        "truck_id",
        F.col("event_ts").cast("date").alias("activity_date"),
        time_trunc("hour", "event_ts").cast(telemetry.schema["event_ts"].dataType).alias("activity_hour"),
    ).agg(F.avg("speed_kmh").alias("avg_speed_kmh"), F.count(F.lit(1)).alias("ping_count"))


def active_hours(telemetry: DataFrame) -> DataFrame:
    """Hours with at least one ping per truck-day; the speed is the mean of hourly means."""
    return (
        hourly_pings(telemetry)
        .groupBy("truck_id", "activity_date")
        .agg(
            F.count("activity_hour").alias("active_hours"),
            exact_mean("avg_speed_kmh", 9, 1).alias("avg_speed_kmh"),
            F.sum("ping_count").alias("total_pings"),
        )
    )


_SUMS = {
    "total_distance_km": ("total_distance_km", 3, 2),
    "total_deadhead_km": ("deadhead_distance_km", 3, 2),
    "total_loaded_km": ("loaded_distance_km", 3, 2),
    "total_duration_min": ("total_duration_min", 1, 1),
}


def daily_trips(trips: DataFrame) -> DataFrame:
    """Totals per truck-day and the pickup district with the most trips.

    Trips are first reduced to one row per truck, day and district; the
    district with the most trips then falls out of the same second aggregation
    that adds the totals up, without another pass over the trips or a join.
    """
    sums = {name: F.sum(to_units(column, scale)) for name, (column, scale, _) in _SUMS.items()}
    ratio = to_units("deadhead_ratio", 4)
    by_district = trips.groupBy("truck_id", F.col("trip_date").alias("activity_date"), "pickup_address").agg(
        F.count(F.lit(1)).alias("_n"),
        *[total.alias(name) for name, total in sums.items()],
        F.sum(ratio).alias("_ratio"),
        F.count(ratio).alias("_ratios"),
    )
    # Most trips first, then the name, nulls last.
    place = F.struct(-F.col("_n"), F.col("pickup_address").isNull(), "pickup_address")
    return by_district.groupBy("truck_id", "activity_date").agg(
        F.min(place).getField("pickup_address").alias("primary_district"),
        F.sum("_n").alias("trips_completed"),
        *[units_sum(F.sum(name), scale, places).alias(name) for name, (_, scale, places) in _SUMS.items()],
        units_mean(F.sum("_ratio"), F.sum("_ratios"), 4, 4).alias("avg_deadhead_ratio"),
    )


def truck_activity(
    trips: DataFrame,
    trucks: DataFrame,
    telemetry: DataFrame,
    target: DataFrame | None = None,
    only: DataFrame | None = None,
) -> DataFrame:
    """One row per truck and day with trips: distance, time, hours seen, main district.

    With ``target`` given, the last stored day and everything after it is
    recomputed; with ``only`` (``truck_id``, ``activity_date``), those truck-days.
    """
    valid = trips.where(~F.col("is_deleted"))
    pings = telemetry
    if only is not None:
        place = ["truck_id", "activity_date"]
        valid = incremental.matching(valid.withColumn("activity_date", F.col("trip_date")), only, place)
        day = F.col("event_ts").cast("date")
        pings = incremental.matching(pings.withColumn("activity_date", day), only, place)
    since = incremental.high_watermark(target, "activity_date")
    if since is not None:
        valid = valid.where(F.col("trip_date") >= F.lit(since))
        # A comparison of the time itself, unlike one of its date, prunes row groups.
        day_start = F.lit(since).cast(telemetry.schema["event_ts"].dataType)
        pings = telemetry.where(F.col("event_ts") >= day_start)
    registry = trucks.where(~F.col("is_deleted")).select("truck_id", "model", "capacity_kg")
    joined = (
        daily_trips(valid)
        .join(active_hours(pings), ["truck_id", "activity_date"], "left")
        .join(registry, "truck_id", "left")
    )
    return joined.select(
        "truck_id",
        "activity_date",
        "model",
        "capacity_kg",
        "primary_district",
        "trips_completed",
        "total_distance_km",
        "total_deadhead_km",
        "total_loaded_km",
        "total_duration_min",
        "avg_deadhead_ratio",
        "active_hours",
        "total_pings",
        "avg_speed_kmh",
    )
