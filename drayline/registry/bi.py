"""Charts and operational figures over the marts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from drayline.plans import derived, marts, metrics
from drayline.registry import ctes
from drayline.registry.base import Tables, mean, query, r, total, with_ctes
from drayline.registry.fleet import activity_rows, trip_rows

AS_OF = date(2024, 1, 28)
_IN_RANGE = "{0} >= DATE '2023-12-29' AND {0} < DATE '2024-01-28'"


def _otd(t: Tables) -> DataFrame:
    return marts.otd(trip_rows(t))


def _fleet(t: Tables) -> DataFrame:
    return marts.fleet_utilization(activity_rows(t))


_OTD_METRICS = {
    "avg_otd_rate": mean("otd_rate", 4),
    "avg_otd_rate_7d": mean("otd_rate_7d", 4),
    "avg_duration_min": mean("avg_duration_min", 1),
    "p90_duration_min": mean("p90_duration_min", 1),
    "min_duration_min": "min(min_duration_min)",
    "max_duration_min": "max(max_duration_min)",
    **{
        c: f"CAST(sum({c}) AS BIGINT)"
        for c in ("total_orders", "on_time_orders", "late_orders", "fast_count", "on_time_count", "slightly_late_count", "late_count")
    },
}


def _named(metrics_sql: dict[str, str]) -> str:
    return ", ".join(f"{v} AS {k}" for k, v in metrics_sql.items())


@query("dataset_otd", with_ctes(ctes.OTD, f"SELECT district, {_named(_OTD_METRICS)} FROM otd_mart GROUP BY 1"))
def dataset_otd(t: Tables) -> DataFrame:
    """All thirteen measures by district."""
    return metrics.metric_query(_otd(t), "otd", list(_OTD_METRICS), ["district"])


_TIERS = " UNION ALL ".join(
    f"SELECT district, trip_date, otd_rate, otd_rate_7d, total_orders, '{label}' AS delivery_tier, {column} AS delivery_count FROM otd_mart"
    for column, label in metrics.TIER_LABELS.items()
)


@query("dataset_otd_tiers", with_ctes(ctes.OTD, _TIERS))
def dataset_otd_tiers(t: Tables) -> DataFrame:
    return metrics.otd_tiers(_otd(t))


_FLEET_METRICS = {
    "avg_utilization": mean("utilization_index", 4),
    "avg_utilization_7d": mean("utilization_index_7d", 2),
    "total_distance": total("total_distance_km", 2),
}


@query("dataset_fleet", with_ctes(ctes.FLEET, f"SELECT truck_id, {_named(_FLEET_METRICS)} FROM fleet GROUP BY 1"))
def dataset_fleet(t: Tables) -> DataFrame:
    return metrics.metric_query(_fleet(t), "fleet", list(_FLEET_METRICS), ["truck_id"])


_CORRIDOR = {
    "order_count": "CAST(sum(order_count) AS BIGINT)",
    "avg_duration": mean("avg_duration_min", 1),
    "avg_corridor_otd": mean("corridor_otd_rate", 4),
}


@query("dataset_heatmap", with_ctes(ctes.HEATMAP, f"SELECT trip_date, {_named(_CORRIDOR)} FROM heatmap GROUP BY 1"))
def dataset_heatmap(t: Tables) -> DataFrame:
    return metrics.metric_query(marts.district_heatmap(trip_rows(t)), "heatmap", list(_CORRIDOR), by_day=True)


_RATIO = (
    f"({total('total_deadhead_km', 2)}) / nullif({total('total_distance_km', 2)}, 0)"
)


@query(
    "dataset_truck_activity",
    with_ctes(
        ctes.ACTIVITY,
        f"SELECT truck_id, {total('total_distance_km', 2)} AS total_distance_km, {total('total_deadhead_km', 2)} AS total_deadhead, {_RATIO} AS deadhead_vs_loaded FROM activity GROUP BY 1",
    ),
)
def dataset_truck_activity(t: Tables) -> DataFrame:
    return metrics.metric_query(
        activity_rows(t), "truck_activity", ["total_distance_km", "total_deadhead", "deadhead_vs_loaded"], ["truck_id"]
    )


@query("dataset_trips", with_ctes(ctes.TRIPS, f"SELECT {', '.join(metrics.TRIP_COLUMNS)} FROM trips"))
def dataset_trips(t: Tables) -> DataFrame:
    return metrics.trip_dataset(trip_rows(t))


def _chart(cte_names: list[str], table: str, time: str, keys: str, parts: dict[str, str]) -> str:
    return with_ctes(cte_names, f"SELECT {keys}, {_named(parts)} FROM {table} WHERE {_IN_RANGE.format(time)} GROUP BY {keys}")


@query(
    "chart_otd_daily_trend",
    _chart(ctes.OTD, "otd_mart", "trip_date", "trip_date", {k: _OTD_METRICS[k] for k in ("avg_otd_rate", "avg_otd_rate_7d")}),
)
def chart_otd_daily_trend(t: Tables) -> DataFrame:
    return metrics.chart_otd_daily_trend(_otd(t), AS_OF)


@query("chart_otd_by_district", _chart(ctes.OTD, "otd_mart", "trip_date", "district", {"avg_otd_rate": _OTD_METRICS["avg_otd_rate"]}))
def chart_otd_by_district(t: Tables) -> DataFrame:
    return metrics.chart_otd_by_district(_otd(t), AS_OF)


@query(
    "chart_otd_tiers",
    with_ctes(
        ctes.OTD,
        f"SELECT delivery_tier, CAST(n AS BIGINT) AS delivery_count, {r('n * 100.0 / nullif(sum(n) OVER (), 0)', 2)} AS share_percent FROM "
        f"(SELECT delivery_tier, sum(delivery_count) AS n FROM ({_TIERS}) WHERE {_IN_RANGE.format('trip_date')} GROUP BY 1)",
    ),
)
def chart_otd_tiers(t: Tables) -> DataFrame:
    return metrics.chart_otd_tiers(_otd(t), AS_OF)


@query("chart_daily_orders", _chart(ctes.OTD, "otd_mart", "trip_date", "trip_date", {"total_orders": _OTD_METRICS["total_orders"]}))
def chart_daily_orders(t: Tables) -> DataFrame:
    return metrics.chart_daily_orders(_otd(t), AS_OF)


@query("chart_corridors", _chart(ctes.HEATMAP, "heatmap", "trip_date", "origin_district, destination_district", _CORRIDOR))
def chart_corridors(t: Tables) -> DataFrame:
    return metrics.chart_corridors(marts.district_heatmap(trip_rows(t)), AS_OF)


@query(
    "chart_duration_heatmap",
    with_ctes(ctes.HEATMAP, f"SELECT origin_district, destination_district, {_CORRIDOR['avg_duration']} AS avg_duration FROM heatmap GROUP BY 1, 2"),
)
def chart_duration_heatmap(t: Tables) -> DataFrame:
    return metrics.chart_duration_heatmap(marts.district_heatmap(trip_rows(t)))


@query(
    "chart_utilization_trend",
    _chart(ctes.FLEET, "fleet", "metric_date", "metric_date", {k: _FLEET_METRICS[k] for k in ("avg_utilization", "avg_utilization_7d")}),
)
def chart_utilization_trend(t: Tables) -> DataFrame:
    return metrics.chart_utilization_trend(_fleet(t), AS_OF)


@query("chart_daily_distance", _chart(ctes.FLEET, "fleet", "metric_date", "metric_date", {"total_distance": _FLEET_METRICS["total_distance"]}))
def chart_daily_distance(t: Tables) -> DataFrame:
    return metrics.chart_daily_distance(_fleet(t), AS_OF)


_DEADHEAD = {"total_deadhead": total("total_deadhead_km", 2), "total_distance_km": total("total_distance_km", 2)}


@query("chart_deadhead_by_truck", _chart(ctes.ACTIVITY, "activity", "activity_date", "truck_id", _DEADHEAD))
def chart_deadhead_by_truck(t: Tables) -> DataFrame:
    return metrics.chart_deadhead_by_truck(activity_rows(t), AS_OF)


@query(
    "chart_deadhead_trend",
    _chart(ctes.ACTIVITY, "activity", "activity_date", "activity_date", {"total_deadhead": _DEADHEAD["total_deadhead"]}),
)
def chart_deadhead_trend(t: Tables) -> DataFrame:
    return metrics.chart_deadhead_trend(activity_rows(t), AS_OF)


@query(
    "dashboard_date_filter",
    with_ctes(
        ctes.OTD,
        f"SELECT {_named({'total_orders': _OTD_METRICS['total_orders'], 'avg_otd_rate': _OTD_METRICS['avg_otd_rate']})} FROM otd_mart WHERE trip_date >= DATE '2024-01-05' AND trip_date < DATE '2024-01-12'",
    ),
)
def dashboard_date_filter(t: Tables) -> DataFrame:
    week = metrics.between_dates(_otd(t), "trip_date", date(2024, 1, 5), date(2024, 1, 12))
    return metrics.metric_query(week, "otd", ["total_orders", "avg_otd_rate"])


# --- operations -------------------------------------------------------------------------


def _live_orders(t: Tables) -> DataFrame:
    """Orders of which some are still under way."""
    third = F.col("order_id") % 7
    rows = derived.orders(t.events)
    return rows.withColumn(
        "status", F.when(third == 0, "collecting").when(third == 1, "en_route").otherwise(F.col("status"))
    ).withColumn("delivered_at", F.when(third > 0, F.col("delivered_at")))


_LIVE = (
    "live AS (SELECT order_id, truck_id, pickup_address, delivery_address, dispatched_at, "
    "CASE order_id % 7 WHEN 0 THEN 'collecting' WHEN 1 THEN 'en_route' ELSE status END AS status, "
    "CASE WHEN order_id % 7 > 0 THEN delivered_at END AS delivered_at FROM fleet_orders)"
)


def _live_sql(names: list[str], body: str) -> str:
    return with_ctes(names, "").rstrip() + f", {_LIVE} {body}"


@query(
    "operations_kpi",
    _live_sql(
        ["fleet_orders"],
        "SELECT count(*) FILTER (status IN ('collecting', 'en_route')) AS active_assets, "
        "CAST(sum(epoch_us(delivered_at) - epoch_us(dispatched_at)) AS DOUBLE) / (count(delivered_at) * 60000000) AS avg_cycle FROM live",
    ),
)
def operations_kpi(t: Tables) -> DataFrame:
    return metrics.operations_kpi(_live_orders(t))


@query(
    "operations_kpi_delivered",
    _live_sql(
        ["fleet_orders"],
        "SELECT count(*) FILTER (status IN ('collecting', 'en_route')) AS active_assets, "
        "CAST(sum(epoch_us(delivered_at) - epoch_us(dispatched_at)) AS DOUBLE) / (count(*) * 60000000) AS avg_cycle FROM live WHERE delivered_at IS NOT NULL",
    ),
)
def operations_kpi_delivered(t: Tables) -> DataFrame:
    """Both figures over delivered orders only."""
    return metrics.operations_kpi(_live_orders(t), delivered_only=True)


@query(
    "active_truck_positions",
    _live_sql(
        ["pings", "fleet_orders"],
        "SELECT truck_id, latitude, longitude, speed_kmh FROM (SELECT *, row_number() OVER (PARTITION BY truck_id ORDER BY event_ts DESC) AS rn FROM pings "
        "WHERE truck_id IN (SELECT truck_id FROM live WHERE status IN ('collecting', 'en_route'))) WHERE rn = 1",
    ),
)
def active_truck_positions(t: Tables) -> DataFrame:
    return metrics.active_truck_positions(derived.pings(t.events), _live_orders(t))


@query(
    "active_missions",
    _live_sql(
        ["fleet_orders"],
        "SELECT truck_id AS \"Plate\", status AS \"Phase\", pickup_address AS \"Pickup\", delivery_address AS \"Destination\" FROM live WHERE status IN ('collecting', 'en_route') ORDER BY dispatched_at DESC",
    ),
)
def active_missions(t: Tables) -> DataFrame:
    return metrics.active_missions(_live_orders(t))


@query(
    "fleet_status",
    with_ctes(["registry"], "SELECT truck_id AS \"Plate\", model AS \"Model\", 'available' AS \"Condition\" FROM registry"),
)
def fleet_status(t: Tables) -> DataFrame:
    return metrics.fleet_status(derived.registry(t.events))
