"""Trips, truck-days and marts."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from drayline.operators import incremental
from drayline.operators.asof import Probe, asof_join, asof_lookup, bounded_by_batch
from drayline.operators.latest import most_frequent
from drayline.plans import activity, derived, marts, quantiles, trips
from drayline.plans.lakehouse import Lakehouse
from drayline.registry import ctes
from drayline.registry.base import Tables, query, with_ctes
from drayline.session import cut_lineage, scratch_path
from drayline.sources.tables import PartitionedTable


def trip_rows(t: Tables, **options) -> DataFrame:
    return trips.order_trips(derived.orders(t.events), derived.pings(t.events), **options)


def activity_rows(t: Tables) -> DataFrame:
    return activity.truck_activity(trip_rows(t), derived.registry(t.events), derived.pings(t.events))


_TRIPS_SQL = with_ctes(ctes.TRIPS, "SELECT * FROM trips")


@query("order_trips", _TRIPS_SQL)
def order_trips(t: Tables) -> DataFrame:
    return trip_rows(t)


@query("order_trips_split_keys", _TRIPS_SQL)
def order_trips_split_keys(t: Tables) -> DataFrame:
    """The same with every truck treated as too large for one task."""
    return trip_rows(t, rows_per_chunk=50)


_CUT = "2024-01-20 12:00:00"


@query(
    "order_trips_incremental",
    with_ctes(
        ctes.TRIPS,
        "SELECT * FROM trips WHERE delivered_at > "
        f"(SELECT max(delivered_at) FROM trips WHERE delivered_at <= TIMESTAMP '{_CUT}')",
    ),
)
def order_trips_incremental(t: Tables) -> DataFrame:
    """Only orders delivered after the newest stored trip."""
    cut = F.lit(_CUT).cast("timestamp_ntz")
    stored = derived.orders(t.events).where(F.col("delivered_at") <= cut)
    return trip_rows(t, target=trips.order_trips(stored, derived.pings(t.events)), lookback="5 days")


@query("order_trips_batches", _TRIPS_SQL)
def order_trips_batches(t: Tables) -> DataFrame:
    """Three batches of orders in no order of time, then positions that came late, equal one run over all."""
    orders, pings = derived.orders(t.events), derived.pings(t.events)
    late = F.hour("event_ts") % 5 == 2
    stored = None
    for k in range(3):
        arrived = orders.where(F.col("order_id") % 3 <= k)
        new = trips.order_trips(arrived, pings.where(~late), stored, lookback="2 hours")
        stored = cut_lineage(new if stored is None else stored.unionByName(new), "trips")
    revised = trips.revised_trips(orders, pings, stored, trips.late_trucks(pings.where(late), stored, pings.where(~late)))
    return incremental.merge_upsert(stored, revised, ["order_id"])


def _lookup(t: Tables, direction: str, inclusive: bool, ts: str) -> DataFrame:
    found = asof_join(
        derived.orders(t.events).select("order_id", "truck_id", ts),
        derived.pings(t.events),
        on=["truck_id"], left_ts=ts, right_ts="event_ts", values=["latitude", "longitude"],
        row_id=["order_id"], direction=direction, inclusive=inclusive, prefix="near",
    )
    return found.select("order_id", "near_event_ts", "near_latitude", "near_longitude")


def _lookup_sql(cte: str) -> str:
    named = [*(n for n in ctes.POSITIONS if n != "orders_done")]
    text = with_ctes(
        named[:2] + ["orders_done"] + named[2:],
        "SELECT o.order_id, n.event_ts AS near_event_ts, n.latitude AS near_latitude, "
        f"n.longitude AS near_longitude FROM fleet_orders o LEFT JOIN {cte} n USING (order_id)",
    )
    # The lookup covers every order, also those over the duration cap.
    return text.replace(f"orders_done AS ({ctes.CTES['orders_done']})", "orders_done AS (SELECT * FROM fleet_orders)")


@query("asof_backward_strict", _lookup_sql("dispatch"))
def asof_backward_strict(t: Tables) -> DataFrame:
    return _lookup(t, "backward", False, "dispatched_at")


@query("asof_forward_inclusive", _lookup_sql("pickup"))
def asof_forward_inclusive(t: Tables) -> DataFrame:
    return _lookup(t, "forward", True, "collected_at")


@query("asof_backward_inclusive", _lookup_sql("delivery"))
def asof_backward_inclusive(t: Tables) -> DataFrame:
    return _lookup(t, "backward", True, "delivered_at")


@query(
    "asof_with_tolerance",
    with_ctes(
        ["pings", "fleet_orders"],
        "SELECT order_id, CASE WHEN near >= dispatched_at - INTERVAL 2 HOUR THEN near END AS near_event_ts FROM ("
        "SELECT o.order_id, o.dispatched_at, (SELECT max(p.event_ts) FROM pings p "
        "WHERE p.truck_id = o.truck_id AND p.event_ts < o.dispatched_at) AS near FROM fleet_orders o)",
    ),
)
def asof_with_tolerance(t: Tables) -> DataFrame:
    """Positions more than two hours old do not count."""
    found = asof_lookup(
        derived.orders(t.events), derived.pings(t.events), ["truck_id"], "event_ts", [],
        [Probe("near", "dispatched_at", "backward", False)], ["order_id"], within=7200,
    )
    return found.select("order_id", "near_event_ts")


@query(
    "telemetry_in_batch_window",
    with_ctes(
        ["pings", "fleet_orders"],
        "SELECT p.* FROM pings p JOIN (SELECT min(dispatched_at) AS a, max(delivered_at) + INTERVAL 2 HOUR AS b "
        f"FROM fleet_orders WHERE dispatched_at >= TIMESTAMP '{_CUT}') w ON p.event_ts BETWEEN w.a AND w.b",
    ),
)
def telemetry_in_batch_window(t: Tables) -> DataFrame:
    batch = derived.orders(t.events).where(F.col("dispatched_at") >= F.lit(_CUT).cast("timestamp_ntz"))
    return bounded_by_batch(derived.pings(t.events), batch, "event_ts", "dispatched_at", "delivered_at")


@query("hourly_pings", with_ctes(["pings", "hourly"], "SELECT truck_id, activity_date, activity_hour, ping_count, round(avg_speed_kmh, 6) AS avg_speed_kmh FROM hourly"))
def hourly_pings(t: Tables) -> DataFrame:
    return activity.hourly_pings(derived.pings(t.events)).withColumn("avg_speed_kmh", F.round("avg_speed_kmh", 6))


@query("active_hours", with_ctes(["pings", "hourly", "hours"], "SELECT * FROM hours"))
def active_hours(t: Tables) -> DataFrame:
    return activity.active_hours(derived.pings(t.events))


@query("truck_activity", with_ctes(ctes.ACTIVITY, "SELECT * FROM activity"))
def truck_activity(t: Tables) -> DataFrame:
    return activity_rows(t)


@query(
    "truck_activity_incremental",
    with_ctes(ctes.ACTIVITY, "SELECT * FROM activity WHERE activity_date >= DATE '2024-01-20'"),
)
def truck_activity_incremental(t: Tables) -> DataFrame:
    """The last stored day and everything after it."""
    stored = activity_rows(t).where(F.col("activity_date") <= F.lit(date(2024, 1, 20)))
    return activity.truck_activity(trip_rows(t), derived.registry(t.events), derived.pings(t.events), stored)


@query(
    "primary_district",
    with_ctes([*ctes.VALID, "district"], "SELECT * FROM district"),
)
def primary_district(t: Tables) -> DataFrame:
    rows = trip_rows(t).where(~F.col("is_deleted")).withColumnRenamed("trip_date", "activity_date")
    common = most_frequent(rows, ["truck_id", "activity_date"], "pickup_address")
    return common.withColumnRenamed("pickup_address", "primary_district")


@query("otd", with_ctes(ctes.OTD, "SELECT * FROM otd_mart"))
def otd(t: Tables) -> DataFrame:
    return marts.otd(trip_rows(t))


@query(
    "otd_incremental",
    with_ctes(ctes.OTD, "SELECT * FROM otd_mart WHERE trip_date >= DATE '2024-01-19'"),
)
def otd_incremental(t: Tables) -> DataFrame:
    """Refresh of the days from the 19th on; earlier days come from the stored mart."""
    stored = marts.otd(trip_rows(t).where(F.col("trip_date") <= F.lit(date(2024, 1, 20))))
    return marts.otd(trip_rows(t), target=stored, as_of=date(2024, 1, 20), lookback_days=1)


@query("district_heatmap", with_ctes(ctes.HEATMAP, "SELECT * FROM heatmap"))
def district_heatmap(t: Tables) -> DataFrame:
    return marts.district_heatmap(trip_rows(t))


@query(
    "district_heatmap_incremental",
    with_ctes(ctes.HEATMAP, "SELECT * FROM heatmap WHERE trip_date >= DATE '2024-01-18'"),
)
def district_heatmap_incremental(t: Tables) -> DataFrame:
    return marts.district_heatmap(trip_rows(t), as_of=date(2024, 1, 20), lookback_days=2)


@query("fleet_utilization", with_ctes(ctes.FLEET, "SELECT * FROM fleet"))
def fleet_utilization(t: Tables) -> DataFrame:
    return marts.fleet_utilization(activity_rows(t))


@query(
    "fleet_utilization_incremental",
    with_ctes(ctes.FLEET, "SELECT * FROM fleet WHERE metric_date >= DATE '2024-01-19'"),
)
def fleet_utilization_incremental(t: Tables) -> DataFrame:
    rows = activity_rows(t)
    stored = marts.fleet_utilization(rows.where(F.col("activity_date") <= F.lit(date(2024, 1, 20))))
    return marts.fleet_utilization(rows, stored, date(2024, 1, 20), 1)


@query(
    "delivery_tiers",
    with_ctes(
        ctes.VALID,
        "SELECT order_id, CASE WHEN total_duration_min <= 11.25 THEN 'fast' WHEN total_duration_min <= 15 THEN 'on_time' "
        "WHEN total_duration_min <= 18.75 THEN 'slightly_late' ELSE 'late' END AS delivery_tier FROM valid_trips",
    ),
)
def delivery_tiers(t: Tables) -> DataFrame:
    rows = trip_rows(t).where(~F.col("is_deleted"))
    return rows.select("order_id", marts.delivery_tier("total_duration_min").alias("delivery_tier"))


# One row of each table in common columns: name, day, two keys, a count and two figures.
_TABLES = {
    "order_trips": ("trips", "trip_date", "order_id", "truck_id", "NULL", "total_distance_km", "total_duration_min"),
    "truck_activity": ("activity", "activity_date", "truck_id", "primary_district", "trips_completed", "total_distance_km", "active_hours"),
    "otd": ("otd_mart", "trip_date", "district", "NULL", "total_orders", "otd_rate_7d", "p90_duration_min"),
    "district_heatmap": ("heatmap", "trip_date", "origin_district", "destination_district", "order_count", "avg_distance_km", "median_duration_min"),
    "fleet_utilization": ("fleet", "metric_date", "truck_id", "model", "trips_completed", "utilization_index", "utilization_index_7d"),
}
_COMMON = {"day": "DATE", "k1": "{text}", "k2": "{text}", "n": "BIGINT", "a": "DOUBLE", "b": "DOUBLE"}


def _common(name: str, text: str) -> list[str]:
    kinds = [(c, k.format(text=text)) for c, k in _COMMON.items()]
    return [f"'{name}' AS mart"] + [f"CAST({e} AS {k}) AS {c}" for e, (c, k) in zip(_TABLES[name][1:], kinds)]


@query(
    "incremental_equals_full",
    with_ctes(
        [*ctes.FLEET, "otd_days", "otd_mart", "heatmap"],
        " UNION ALL ".join(f"SELECT {', '.join(_common(n, 'VARCHAR'))} FROM {_TABLES[n][0]}" for n in _TABLES),
    ),
)
def incremental_equals_full(t: Tables) -> DataFrame:
    """Trips and marts after a second run equal those built at once.

    Between the runs, on days long stored: orders arrive late, orders come again
    with other times and districts, delivered ones turn out to be cancelled,
    positions are filled in and registry entries change.
    """
    key = F.col("order_id")
    final = derived.orders(t.events).withColumns({"ts_ms": F.lit(2).cast("long"), "_partition_offset": F.col("order_id")})
    earlier = {c: F.col(c) - F.expr("interval 26 hours") for c in ("dispatched_at", "collected_at", "delivered_at")}
    first = final.where(key % 5 != 1).withColumn("ts_ms", F.lit(1).cast("long"))
    moved = first.withColumns({**earlier, "delivery_address": F.col("pickup_address")})
    cancelled = first.where(key % 7 == 0).withColumn("order_id", -key - 1)
    first = first.where(key % 4 != 0).unionByName(moved.where(key % 4 == 0))
    second = final.where((key % 5 == 1) | (key % 4 == 0))
    withdrawn = cancelled.withColumns({"status": F.lit("cancelled"), "is_deleted": F.lit(False), "ts_ms": F.lit(2).cast("long")})

    pings, late = derived.pings(t.events), F.hour("event_ts") % 6 == 2
    trucks = derived.registry(t.events).withColumns({"ts_ms": F.lit(2).cast("long"), "_partition_offset": F.col("truck_id")})
    renamed = F.col("truck_id") % 3 == 0
    old = trucks.withColumns({"model": F.when(renamed, "unknown").otherwise(F.col("model")), "ts_ms": F.lit(1).cast("long")})

    lake = Lakehouse(t.spark, scratch_path(t.spark, "incremental_equals_full"), key_buckets=8)
    lake.land_orders(first.unionByName(cancelled))
    lake.land_trucks(old)
    lake.land_positions(pings.where(~late))
    lake.build()
    lake.land_orders(second.unionByName(withdrawn))
    lake.land_trucks(trucks.where(renamed))
    lake.land_positions(pings.where(late))
    lake.build()
    rows = [getattr(lake, n).read().selectExpr(*_common(n, "STRING")) for n in _TABLES]
    return reduce(DataFrame.unionByName, rows)


_RANGES = (
    "ranges AS (SELECT DISTINCT CAST(d - INTERVAL (k) DAY AS DATE) AS first_day, d AS last_day FROM "
    "(SELECT DISTINCT trip_date AS d FROM valid_trips), (SELECT unnest([6, 27]) AS k))"
)


@query(
    "otd_p90_any_range",
    with_ctes(ctes.VALID, "SELECT 1").removesuffix(" SELECT 1")
    + f", {_RANGES} SELECT first_day, last_day, delivery_address AS district, count(*) AS total_orders, true AS p90_within, true AS median_within "
    "FROM valid_trips JOIN ranges ON trip_date BETWEEN first_day AND last_day GROUP BY 1, 2, 3",
)
def otd_p90_any_range(t: Tables) -> DataFrame:
    """Quantiles over 7 and 28 days up to every day from one stored sketch a day and district, held against exact ranks."""
    stored = cut_lineage(trip_rows(t), "trips")
    table = PartitionedTable(t.spark, scratch_path(t.spark, "sketches"), ["trip_date"])
    late = F.dayofmonth("trip_date") % 5 == 0
    quantiles.refresh_sketches(table, stored.where(~late | (F.col("order_id") % 2 == 0)))
    quantiles.refresh_sketches(table, stored, stored.where(late).select("trip_date"))
    days = stored.where(~F.col("is_deleted") & F.col("total_duration_min").isNotNull())
    last = days.select(F.col("trip_date").alias("last_day")).distinct()
    ranges = last.select(F.explode(F.array(F.lit(6), F.lit(27))).alias("_k"), "last_day")
    ranges = ranges.select(F.date_sub("last_day", F.col("_k")).alias("first_day"), "last_day")
    fractions = {"p90": 0.9, "median": 0.5}
    merged = quantiles.duration_quantiles(table.read(), ["district"], fractions, ranges)
    # Exact ranks from counts of equal durations, of which there are at most 1,201 a day and district.
    counts = days.groupBy("trip_date", F.col("delivery_address").alias("district"), "total_duration_min").agg(F.count(F.lit(1)).alias("_n"))
    spans = ranges.select("*", F.explode(F.sequence("first_day", "last_day")).alias("trip_date"))
    ranked = counts.join(spans, "trip_date").join(merged, ["first_day", "last_day", "district"])
    slack, value = 2.5 / quantiles.SKETCH_SIZE, F.col("total_duration_min")
    within = []
    for name, fraction in fractions.items():
        below = F.sum(F.when(value < F.col(name), F.col("_n")).otherwise(0)) / F.first("total_orders")
        up_to = F.sum(F.when(value <= F.col(name), F.col("_n")).otherwise(0)) / F.first("total_orders")
        within.append(((below <= fraction + slack) & (up_to >= fraction - slack)).alias(f"{name}_within"))
    return ranked.groupBy("first_day", "last_day", "district").agg(F.first("total_orders").alias("total_orders"), *within)
