"""Metric layer over the marts: named measures, charts and operational figures."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from drayline.functions import exact_mean, exact_sum, round_to, safe_divide
from drayline.operators.latest import latest_per_key

RATE, MINUTES, KILOMETRES, WHOLE = 4, 1, 2, 0


def _mean(column: str, scale: int):
    return lambda: exact_mean(column, scale)


def _total(column: str, scale: int = WHOLE):
    if scale == WHOLE:
        return lambda: F.sum(column)
    return lambda: exact_sum(column, scale)


@dataclass(frozen=True)
class Dataset:
    """A mart seen through named measures."""

    time_column: str
    measures: dict
    dimensions: tuple[str, ...] = field(default_factory=tuple)


# Means and sums are taken over the rounded mart columns, hence the scales.
DATASETS: dict[str, Dataset] = {
    "otd": Dataset(
        "trip_date",
        {
            "avg_otd_rate": _mean("otd_rate", RATE),
            "avg_otd_rate_7d": _mean("otd_rate_7d", RATE),
            "total_orders": _total("total_orders"),
            "on_time_orders": _total("on_time_orders"),
            "late_orders": _total("late_orders"),
            "fast_count": _total("fast_count"),
            "on_time_count": _total("on_time_count"),
            "slightly_late_count": _total("slightly_late_count"),
            "late_count": _total("late_count"),
            "avg_duration_min": _mean("avg_duration_min", MINUTES),
            "min_duration_min": lambda: F.min("min_duration_min"),
            "max_duration_min": lambda: F.max("max_duration_min"),
            "p90_duration_min": _mean("p90_duration_min", MINUTES),
        },
        ("district",),
    ),
    "otd_tiers": Dataset(
        "trip_date",
        {
            "delivery_count": _total("delivery_count"),
            "total_orders": _total("total_orders"),
            "avg_otd_rate": _mean("otd_rate", RATE),
            "avg_otd_rate_7d": _mean("otd_rate_7d", RATE),
        },
        ("district", "delivery_tier"),
    ),
    "fleet": Dataset(
        "metric_date",
        {
            "avg_utilization": _mean("utilization_index", RATE),
            "avg_utilization_7d": _mean("utilization_index_7d", 2),
            "total_distance": _total("total_distance_km", KILOMETRES),
        },
        ("truck_id", "district"),
    ),
    "heatmap": Dataset(
        "trip_date",
        {
            "avg_duration": _mean("avg_duration_min", MINUTES),
            "order_count": _total("order_count"),
            "avg_corridor_otd": _mean("corridor_otd_rate", RATE),
        },
        ("origin_district", "destination_district"),
    ),
    "truck_activity": Dataset(
        "activity_date",
        {
            "total_distance_km": _total("total_distance_km", KILOMETRES),
            "total_deadhead": _total("total_deadhead_km", KILOMETRES),
            "deadhead_vs_loaded": lambda: safe_divide(
                exact_sum("total_deadhead_km", KILOMETRES), exact_sum("total_distance_km", KILOMETRES)
            ),
        },
        ("truck_id",),
    ),
}

# Label of each tier column.
TIER_LABELS = {
    "fast_count": "Fast",
    "on_time_count": "On Time",
    "slightly_late_count": "Slightly Late",
    "late_count": "Late",
}
TRIP_COLUMNS = [
    "trip_date", "order_id", "truck_id", "pickup_address", "delivery_address", "total_distance_km",
    "deadhead_distance_km", "loaded_distance_km", "deadhead_ratio",
]


def otd_tiers(otd: DataFrame) -> DataFrame:
    """One row per day, district and tier, from one read of the mart."""
    keep = ["district", "trip_date", "otd_rate", "otd_rate_7d", "total_orders"]
    labelled = otd.select(*keep, *[F.col(c).alias(label) for c, label in TIER_LABELS.items()])
    return labelled.unpivot(keep, list(TIER_LABELS.values()), "delivery_tier", "delivery_count")


def trip_dataset(trips: DataFrame) -> DataFrame:
    return trips.select(*TRIP_COLUMNS)


def last_days(df: DataFrame, column: str, as_of: date, days: int = 30) -> DataFrame:
    """Rows of the ``days`` before ``as_of`` (excluded)."""
    value = F.col(column)
    return df.where((value >= F.lit(as_of - timedelta(days=days))) & (value < F.lit(as_of)))


def between_dates(df: DataFrame, column: str, start: date | None, end: date | None) -> DataFrame:
    """A dashboard's date filter: start included, end excluded, either may be open."""
    if start is not None:
        df = df.where(F.col(column) >= F.lit(start))
    if end is not None:
        df = df.where(F.col(column) < F.lit(end))
    return df


def metric_query(
    df: DataFrame,
    dataset: str,
    metrics: list[str],
    group_by: list[str] | None = None,
    as_of: date | None = None,
    days: int = 30,
    by_day: bool = False,
) -> DataFrame:
    """Measures of a dataset by dimensions; ``as_of`` restricts to the days before it."""
    spec = DATASETS[dataset]
    unknown = [m for m in metrics if m not in spec.measures]
    if unknown:
        raise ValueError(f"unknown metrics {unknown}; {dataset} has {sorted(spec.measures)}")
    rows = last_days(df, spec.time_column, as_of, days) if as_of else df
    keys = [*(group_by or []), *([spec.time_column] if by_day else [])]
    # "{}_" keeps a measure apart from the mart column of the same name while aggregating.
    folded = rows.groupBy(*keys).agg(*[spec.measures[m]().alias(f"{m}_") for m in metrics])
    return folded.select(*keys, *[F.col(f"{m}_").alias(m) for m in metrics])


# --- charts ---------------------------------------------------------------------------


def chart_otd_daily_trend(otd: DataFrame, as_of: date) -> DataFrame:
    return metric_query(otd, "otd", ["avg_otd_rate", "avg_otd_rate_7d"], as_of=as_of, by_day=True)


def chart_otd_by_district(otd: DataFrame, as_of: date) -> DataFrame:
    bars = metric_query(otd, "otd", ["avg_otd_rate"], ["district"], as_of)
    return bars.orderBy(F.col("avg_otd_rate").desc(), "district")


def chart_otd_tiers(otd: DataFrame, as_of: date) -> DataFrame:
    """Orders per tier and their share; the total is over four rows."""
    slices = metric_query(otd_tiers(otd), "otd_tiers", ["delivery_count"], ["delivery_tier"], as_of)
    total = F.sum("delivery_count").over(W.partitionBy(F.lit(0)))
    share = safe_divide(F.col("delivery_count") * 100.0, total)
    return slices.withColumn("share_percent", round_to(share, 2))


def chart_daily_orders(otd: DataFrame, as_of: date) -> DataFrame:
    return metric_query(otd, "otd", ["total_orders"], as_of=as_of, by_day=True)


def chart_corridors(heatmap: DataFrame, as_of: date) -> DataFrame:
    return metric_query(
        heatmap, "heatmap", ["order_count", "avg_duration", "avg_corridor_otd"],
        ["origin_district", "destination_district"], as_of,
    )


def chart_duration_heatmap(heatmap: DataFrame) -> DataFrame:
    return metric_query(heatmap, "heatmap", ["avg_duration"], ["origin_district", "destination_district"])


def chart_utilization_trend(fleet: DataFrame, as_of: date) -> DataFrame:
    return metric_query(fleet, "fleet", ["avg_utilization", "avg_utilization_7d"], as_of=as_of, by_day=True)


def chart_daily_distance(fleet: DataFrame, as_of: date) -> DataFrame:
    return metric_query(fleet, "fleet", ["total_distance"], as_of=as_of, by_day=True)


def chart_deadhead_by_truck(activity: DataFrame, as_of: date) -> DataFrame:
    bars = metric_query(activity, "truck_activity", ["total_deadhead", "total_distance_km"], ["truck_id"], as_of)
    return bars.orderBy(F.col("total_deadhead").desc(), "truck_id")


def chart_deadhead_trend(activity: DataFrame, as_of: date) -> DataFrame:
    return metric_query(activity, "truck_activity", ["total_deadhead"], as_of=as_of, by_day=True)


# --- operations --------------------------------------------------------------------------

# States of an order under way.
ACTIVE_STATES = ("collecting", "en_route")


def operations_kpi(orders: DataFrame, delivered_only: bool = False) -> DataFrame:
    """Orders under way, and the mean minutes from dispatch to delivery.

    The two figures use separate filters. ``delivered_only`` counts active
    orders among delivered ones, as the original dashboard does.
    """
    delivered = F.col("delivered_at").isNotNull()
    active = F.col("status").isin(*ACTIVE_STATES)
    micros = F.unix_micros(F.col("delivered_at").cast("timestamp")) - F.unix_micros(
        F.col("dispatched_at").cast("timestamp")
    )
    cycle: Column = F.when(delivered, micros)
    return orders.agg(
        F.count_if(active & delivered if delivered_only else active).alias("active_assets"),
        F.try_divide(F.sum(cycle).cast("double"), F.count(cycle) * 60_000_000).alias("avg_cycle"),
    )


def active_truck_positions(telemetry: DataFrame, orders: DataFrame) -> DataFrame:
    """Last position of every truck that has an order under way."""
    active = orders.where(F.col("status").isin(*ACTIVE_STATES)).select("truck_id")
    moving = telemetry.join(active, "truck_id", "left_semi")
    return latest_per_key(moving, ["truck_id"], ["event_ts"]).select("truck_id", "latitude", "longitude", "speed_kmh")


def active_missions(orders: DataFrame) -> DataFrame:
    """Orders under way, newest first."""
    return (
        orders.where(F.col("status").isin(*ACTIVE_STATES))
        .orderBy(F.col("dispatched_at").desc_nulls_first(), "order_id")
        .select(
            F.col("truck_id").alias("Plate"), F.col("status").alias("Phase"),
            F.col("pickup_address").alias("Pickup"), F.col("delivery_address").alias("Destination"),
        )
    )


def fleet_status(trucks: DataFrame) -> DataFrame:
    return trucks.select(
        F.col("truck_id").alias("Plate"), F.col("model").alias("Model"), F.col("status").alias("Condition")
    )


