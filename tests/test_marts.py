"""Trips and marts: edge cases, invariants, and incremental runs against a full one."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from drayline.plans import activity, marts, metrics, trips

DAY = datetime(2024, 1, 1)

ORDERS = (
    "order_id int, truck_id string, status string, pickup_address string, delivery_address string, "
    "dispatched_at timestamp, collected_at timestamp, delivered_at timestamp, ts_ms bigint, is_deleted boolean"
)
PINGS = "truck_id string, latitude double, longitude double, speed_kmh double, fuel_level string, event_ts timestamp, ts_ms bigint"


def order(i, start=DAY, collect=5, deliver=15, truck="a", status="delivered", deleted=False, pickup="P", delivery="D"):
    def at(minutes):
        return None if minutes is None else start + timedelta(minutes=minutes)

    return (i, truck, status, pickup, delivery, start, at(collect), at(deliver), 0, deleted)


def ping(minutes, lat, truck="a", speed=30.0, start=DAY):
    return (truck, lat, -49.3, speed, None, start + timedelta(minutes=minutes), 0)


@pytest.fixture
def pings(spark):
    return spark.createDataFrame([ping(m, -25.5 + 0.001 * m) for m in range(-10, 30)], PINGS)


def test_completed_orders(spark, rows):
    df = spark.createDataFrame(
        [order(1), order(2, status="en_route"), order(3, status="en_route", deleted=True), order(4, collect=None), order(5, deliver=None)],
        ORDERS,
    )
    assert rows(trips.completed_orders(df), "order_id") == [(1,), (3,)]


def test_positions_at_equal_times(spark, pings):
    row = trips.order_trips(spark.createDataFrame([order(1)], ORDERS), pings).first()
    # dispatch: the ping a minute before; pickup and delivery: the pings at those very times
    assert row["deadhead_distance_km"] == pytest.approx(6 * 0.1112, abs=0.002)
    assert row["loaded_distance_km"] == pytest.approx(10 * 0.1112, abs=0.002)
    assert row["total_distance_km"] == pytest.approx(row["deadhead_distance_km"] + row["loaded_distance_km"], abs=0.0011)
    assert row["deadhead_ratio"] == pytest.approx(0.375, abs=0.001)
    assert (row["deadhead_duration_min"], row["loaded_duration_min"], row["total_duration_min"]) == (5.0, 10.0, 15.0)
    assert row["trip_date"] == date(2024, 1, 1)


def test_duration_cap_and_missing_positions(spark, pings, rows):
    orders = spark.createDataFrame(
        [order(1, deliver=120), order(2, deliver=121), order(3, truck="none"), order(4, truck=None)], ORDERS
    )
    found = trips.order_trips(orders, pings)
    assert rows(found, "order_id") == [(1,), (3,), (4,)]
    assert rows(found.where("order_id > 1"), "total_distance_km", "deadhead_ratio") == [(None, None)] * 2


def test_standing_truck_has_no_ratio(spark):
    still = spark.createDataFrame([ping(m, -25.5) for m in range(-2, 20)], PINGS)
    row = trips.order_trips(spark.createDataFrame([order(1)], ORDERS), still).first()
    assert row["total_distance_km"] == 0.0 and row["deadhead_ratio"] is None


@pytest.fixture
def month(spark):
    """Thirty days of trips of three trucks, one of which makes most of them."""
    data = []
    for day in range(30):
        if day % 9 == 4:
            continue  # days without trips: seven rows are not seven days
        for n in range(2 + day % 4):
            start = DAY + timedelta(days=day, hours=n)
            data.append(
                order(
                    len(data), start, 3 + n, 8 + (day * 7 + n * 5) % 30, "abc"[0 if n < 2 else n % 3],
                    deleted=len(data) % 17 == 3, pickup="XYZ"[n % 3], delivery="XYZ"[(n + 1 + day) % 3],
                )
            )
    orders = spark.createDataFrame(data, ORDERS)
    positions = [
        ping(m, -25.5 + 0.0001 * m + 0.01 * d, truck, 20.0 + m % 7, DAY + timedelta(days=d))
        for truck in "abc" for d in range(30) for m in range(0, 300, 17)
    ]
    trucks = spark.createDataFrame(
        [("a", "M1", 10, False), ("b", "M2", 20, True), ("c", "M3", 30, False)],
        "truck_id string, model string, capacity_kg int, is_deleted boolean",
    )
    return orders, spark.createDataFrame(positions, PINGS), trucks


def test_invariants(month):
    found = trips.order_trips(*month[:2])
    mart = marts.otd(found)
    assert mart.where(
        "total_orders <> fast_count + on_time_count + slightly_late_count + late_count "
        "or total_orders <> on_time_orders + late_orders or on_time_orders <> fast_count + on_time_count "
        "or not min_duration_min <= p90_duration_min or not p90_duration_min <= max_duration_min "
        "or otd_rate_7d < 0 or otd_rate_7d > 1"
    ).isEmpty()
    valid = found.where("not is_deleted").count()
    assert mart.agg(F.sum("total_orders")).first()[0] == valid
    assert marts.district_heatmap(found).agg(F.sum("order_count")).first()[0] == valid
    days = activity.truck_activity(found, month[2], month[1])
    assert days.agg(F.sum("trips_completed")).first()[0] == valid
    assert days.groupBy("truck_id", "activity_date").count().where("count > 1").isEmpty()
    assert days.where("truck_id = 'b' and model is not null").isEmpty()  # not registered any more
    tiers = metrics.otd_tiers(mart)
    assert tiers.count() == 4 * mart.count()
    assert tiers.agg(F.sum("delivery_count")).first()[0] == valid


def test_threshold_is_a_parameter(month):
    found = trips.order_trips(*month[:2])
    strict, loose = (marts.otd(found, threshold=x).agg(F.sum("on_time_orders")).first()[0] for x in (10, 120))
    assert strict < loose == found.where("not is_deleted").count()


def test_incremental_equals_full(month, rows):
    orders, positions, trucks = month
    full = trips.order_trips(orders, positions)
    cut = DAY + timedelta(days=20)
    stored = trips.order_trips(orders.where(F.col("delivered_at") <= F.lit(cut)), positions)
    fresh = trips.order_trips(orders, positions, target=stored)
    assert fresh.count() and rows(stored.unionByName(fresh)) == rows(full)

    days = activity.truck_activity(full, trucks, positions)
    early = days.where(F.col("activity_date") <= F.lit(date(2024, 1, 20)))
    assert rows(activity.truck_activity(full, trucks, positions, early)) == rows(
        days.where(F.col("activity_date") >= F.lit(date(2024, 1, 20)))
    )

    as_of, since = date(2024, 1, 20), F.lit(date(2024, 1, 18))
    mart = marts.otd(full)
    got = marts.otd(full, target=mart.where(F.col("trip_date") < F.lit(as_of)), as_of=as_of, lookback_days=2)
    assert rows(got) == rows(mart.where(F.col("trip_date") >= since))

    fleet = marts.fleet_utilization(days)
    got = marts.fleet_utilization(days, fleet.where(F.col("metric_date") < F.lit(as_of)), as_of, 2)
    assert rows(got) == rows(fleet.where(F.col("metric_date") >= since))

    assert rows(marts.district_heatmap(full, as_of=as_of, lookback_days=2)) == rows(
        marts.district_heatmap(full).where(F.col("trip_date") >= since)
    )


def test_fleet_rows_are_optional(month):
    orders, positions, trucks = month
    days = activity.truck_activity(trips.order_trips(orders, positions), trucks, positions)
    fleet = marts.fleet_utilization(days, with_fleet_rows=True)
    extra = fleet.where("truck_id = '__fleet__'")
    assert extra.count() == days.select("activity_date").distinct().count()
    assert fleet.count() == days.count() + extra.count()


def test_metric_queries(month):
    mart = marts.otd(trips.order_trips(*month[:2]))
    with pytest.raises(ValueError):
        metrics.metric_query(mart, "otd", ["nothing"])
    week = metrics.metric_query(mart, "otd", ["total_orders"], as_of=date(2024, 1, 10), days=7, by_day=True)
    assert week.where("trip_date < '2024-01-03' or trip_date >= '2024-01-10'").isEmpty() and not week.isEmpty()
    shares = metrics.chart_otd_tiers(mart, date(2024, 1, 31)).agg(F.sum("share_percent")).first()[0]
    assert shares == pytest.approx(100, abs=0.05)


def test_operations(spark, rows):
    orders = spark.createDataFrame(
        [order(1), order(2, status="en_route", deliver=None), order(3, status="collecting", truck="b", deliver=25)], ORDERS
    )
    kpi = metrics.operations_kpi(orders).first()
    assert kpi["active_assets"] == 2 and kpi["avg_cycle"] == 20.0
    assert metrics.operations_kpi(orders, delivered_only=True).first()["active_assets"] == 1
    positions = spark.createDataFrame([ping(1, -25.5), ping(2, -25.6), ping(1, -25.1, "z")], PINGS)
    assert rows(metrics.active_truck_positions(positions, orders), "truck_id", "latitude") == [("a", -25.6)]
    assert metrics.active_missions(orders).columns == ["Plate", "Phase", "Pickup", "Destination"]
