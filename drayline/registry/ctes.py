"""SQL counterparts of the derived feeds and of the fleet models."""

from __future__ import annotations

from drayline.plans.derived import DISTRICTS
from drayline.registry.base import mean, r, total

_LIST = "[" + ", ".join(f"'{d}'" for d in DISTRICTS) + "]"


def _minutes(a: str, b: str) -> str:
    return r(f"date_sub('second', {a}, {b}) / 60.0", 1)


def _distance(a: str, b: str) -> str:
    la, lo = f"radians({a}.latitude)", f"radians({a}.longitude)"
    lb, lp = f"radians({b}.latitude)", f"radians({b}.longitude)"
    d = f"({lo} - {lp})"
    east = f"(cos({lb}) * sin({d}))"
    north = f"(cos({la}) * sin({lb}) - sin({la}) * cos({lb}) * cos({d}))"
    along = f"(sin({la}) * sin({lb}) + cos({la}) * cos({lb}) * cos({d}))"
    return f"atan2(sqrt({east} * {east} + {north} * {north}), {along}) * 6371.01"


def _nearest(alias: str, comparison: str, direction: str) -> str:
    """Pair every order with every ping of its truck and keep the nearest."""
    return (
        "SELECT order_id, event_ts, latitude, longitude FROM ("
        "SELECT o.order_id, p.event_ts, p.latitude, p.longitude, "
        f"row_number() OVER (PARTITION BY o.order_id ORDER BY p.event_ts {direction}) AS rn "
        f"FROM orders_done o JOIN pings p ON p.truck_id = o.truck_id AND p.event_ts {comparison}) WHERE rn = 1"
    )


CTES: dict[str, str] = {
    "pings": (
        "SELECT user_id % 50 AS truck_id, ts AS event_ts, "
        "CAST(-26.0 AS DOUBLE) + CAST(event_id * 7919 % 1000 AS DOUBLE) * CAST(0.0008 AS DOUBLE) AS latitude, "
        "CAST(-49.5 AS DOUBLE) + CAST(event_id * 104729 % 1000 AS DOUBLE) * CAST(0.0004 AS DOUBLE) AS longitude, "
        "value AS speed_kmh FROM events"
    ),
    "fleet_orders": (
        "SELECT event_id AS order_id, user_id % 50 AS truck_id, 'delivered' AS status, "
        f"({_LIST})[CAST(event_id * 13 % 6 AS INT) + 1] AS pickup_address, "
        f"({_LIST})[CAST((event_id * 13 % 6 + 1 + event_id * 17 % 5) % 6 AS INT) + 1] AS delivery_address, "
        "ts AS dispatched_at, ts + CAST(1 + event_id * 37 % 8 AS INT) * INTERVAL 1 MINUTE AS collected_at, "
        "ts + CAST(1 + event_id * 37 % 8 + 1 + event_id * 53 % 17 + "
        "CASE WHEN event_id % 29 = 0 THEN 120 ELSE 0 END AS INT) * INTERVAL 1 MINUTE AS delivered_at, "
        "event_id % 97 = 0 AS is_deleted FROM events WHERE event_type = 'purchase'"
    ),
    "registry": (
        "SELECT DISTINCT user_id % 50 AS truck_id, "
        "(['Volvo FH', 'Scania R', 'Mercedes', 'VW Const', 'Iveco Hi'])[CAST(user_id % 50 % 5 AS INT) + 1] AS model, "
        "([25000, 20000, 22000, 15000, 24000])[CAST(user_id % 50 % 5 AS INT) + 1] AS capacity_kg, "
        "user_id % 50 % 11 = 10 AS is_deleted FROM events"
    ),
    "orders_done": (
        f"SELECT * FROM fleet_orders WHERE {_minutes('dispatched_at', 'delivered_at')} <= 120"
    ),
    "dispatch": _nearest("d", "< o.dispatched_at", "DESC"),
    "pickup": _nearest("c", ">= o.collected_at", "ASC"),
    "delivery": _nearest("e", "<= o.delivered_at", "DESC"),
    "legs": (
        f"SELECT o.*, {_distance('d', 'c')} AS raw_dead, {_distance('c', 'e')} AS raw_load "
        "FROM orders_done o LEFT JOIN dispatch d USING (order_id) LEFT JOIN pickup c USING (order_id) "
        "LEFT JOIN delivery e USING (order_id)"
    ),
    "trips": (
        "SELECT order_id, truck_id, pickup_address, delivery_address, dispatched_at, collected_at, delivered_at, "
        f"{r('raw_dead', 3)} AS deadhead_distance_km, {r('raw_load', 3)} AS loaded_distance_km, "
        f"{r('raw_dead + raw_load', 3)} AS total_distance_km, "
        f"{_minutes('dispatched_at', 'collected_at')} AS deadhead_duration_min, "
        f"{_minutes('collected_at', 'delivered_at')} AS loaded_duration_min, "
        f"{_minutes('dispatched_at', 'delivered_at')} AS total_duration_min, "
        f"CASE WHEN raw_dead + raw_load > 0 THEN {r('raw_dead / (raw_dead + raw_load)', 4)} END AS deadhead_ratio, "
        "CAST(dispatched_at AS DATE) AS trip_date, is_deleted FROM legs"
    ),
    "hourly": (
        "SELECT truck_id, CAST(event_ts AS DATE) AS activity_date, date_trunc('hour', event_ts) AS activity_hour, "
        "avg(speed_kmh) AS avg_speed_kmh, count(*) AS ping_count FROM pings GROUP BY 1, 2, 3"
    ),
    "hours": (
        "SELECT truck_id, activity_date, count(DISTINCT activity_hour) AS active_hours, "
        f"{mean('avg_speed_kmh', 9, 1)} AS avg_speed_kmh, CAST(sum(ping_count) AS BIGINT) AS total_pings "
        "FROM hourly GROUP BY 1, 2"
    ),
    "valid_trips": "SELECT * FROM trips WHERE NOT is_deleted AND total_duration_min IS NOT NULL",
    "truck_days": (
        "SELECT truck_id, trip_date AS activity_date, count(*) AS trips_completed, "
        f"{total('total_distance_km', 3, 2)} AS total_distance_km, "
        f"{total('deadhead_distance_km', 3, 2)} AS total_deadhead_km, "
        f"{total('loaded_distance_km', 3, 2)} AS total_loaded_km, "
        f"{total('total_duration_min', 1)} AS total_duration_min, "
        f"{mean('deadhead_ratio', 4, 4)} AS avg_deadhead_ratio FROM valid_trips GROUP BY 1, 2"
    ),
    "district": (
        "SELECT truck_id, trip_date AS activity_date, pickup_address AS primary_district FROM ("
        "SELECT truck_id, trip_date, pickup_address, row_number() OVER (PARTITION BY truck_id, trip_date "
        "ORDER BY count(*) DESC, pickup_address) AS rn FROM valid_trips GROUP BY 1, 2, 3) WHERE rn = 1"
    ),
    "activity": (
        "SELECT t.truck_id, t.activity_date, g.model, g.capacity_kg, d.primary_district, t.trips_completed, "
        "t.total_distance_km, t.total_deadhead_km, t.total_loaded_km, t.total_duration_min, t.avg_deadhead_ratio, "
        "h.active_hours, h.total_pings, h.avg_speed_kmh FROM truck_days t "
        "LEFT JOIN (SELECT * FROM registry WHERE NOT is_deleted) g USING (truck_id) "
        "LEFT JOIN hours h USING (truck_id, activity_date) LEFT JOIN district d USING (truck_id, activity_date)"
    ),
    "otd_days": (
        "SELECT trip_date, delivery_address AS district, count(*) AS total_orders, "
        "count(*) FILTER (total_duration_min <= 15) AS on_time_orders, "
        "count(*) FILTER (total_duration_min > 15) AS late_orders, "
        f"{r('count(*) FILTER (total_duration_min <= 15) / count(*)', 4)} AS otd_rate, "
        "count(*) FILTER (total_duration_min <= 11.25) AS fast_count, "
        "count(*) FILTER (total_duration_min > 11.25 AND total_duration_min <= 15) AS on_time_count, "
        "count(*) FILTER (total_duration_min > 15 AND total_duration_min <= 18.75) AS slightly_late_count, "
        "count(*) FILTER (total_duration_min > 18.75) AS late_count, "
        f"{mean('total_duration_min', 1, 1)} AS avg_duration_min, "
        "min(total_duration_min) AS min_duration_min, max(total_duration_min) AS max_duration_min, "
        "quantile_disc(total_duration_min, 0.9) AS p90_duration_min FROM valid_trips GROUP BY 1, 2"
    ),
    "otd_mart": (
        "SELECT *, "
        + r(
            "sum(on_time_orders) OVER w / nullif(sum(total_orders) OVER w, 0)", 4
        )
        + " AS otd_rate_7d FROM otd_days WINDOW w AS (PARTITION BY district ORDER BY trip_date "
        "ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"
    ),
    "heatmap": (
        "SELECT trip_date, pickup_address AS origin_district, delivery_address AS destination_district, "
        f"count(*) AS order_count, {mean('coalesce(total_distance_km, 0)', 3, 2)} AS avg_distance_km, "
        f"{r('min(coalesce(total_distance_km, 0))', 2)} AS min_distance_km, "
        f"{r('max(coalesce(total_distance_km, 0))', 2)} AS max_distance_km, "
        f"{mean('total_duration_min', 1, 1)} AS avg_duration_min, "
        "quantile_disc(total_duration_min, 0.5) AS median_duration_min, "
        f"{mean('coalesce(deadhead_ratio, 0)', 4, 4)} AS avg_deadhead_ratio, "
        f"{r('count(*) FILTER (total_duration_min <= 15) / count(*)', 4)} AS corridor_otd_rate "
        "FROM valid_trips GROUP BY 1, 2, 3"
    ),
    "fleet_days": (
        "SELECT activity_date AS metric_date, truck_id, model, capacity_kg, primary_district AS district, "
        "trips_completed, total_distance_km, total_duration_min, avg_deadhead_ratio, "
        f"{r('total_duration_min / 60.0 / nullif(active_hours, 0)', 4)} AS utilization_index FROM activity"
    ),
    "fleet": (
        "SELECT *, floor(CAST(sum(CAST(round(utilization_index * 10000) AS BIGINT)) OVER w AS DOUBLE) / "
        "nullif(count(utilization_index) OVER w * 100, 0) + 0.5) / 100 AS utilization_index_7d FROM fleet_days "
        "WINDOW w AS (PARTITION BY truck_id ORDER BY metric_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"
    ),
}

ORDERS = ["fleet_orders", "orders_done"]
POSITIONS = ["pings", *ORDERS, "dispatch", "pickup", "delivery"]
TRIPS = [*POSITIONS, "legs", "trips"]
VALID = [*TRIPS, "valid_trips"]
ACTIVITY = [*VALID, "registry", "hourly", "hours", "truck_days", "district", "activity"]
OTD = [*VALID, "otd_days", "otd_mart"]
HEATMAP = [*VALID, "heatmap"]
FLEET = [*ACTIVITY, "fleet_days", "fleet"]
