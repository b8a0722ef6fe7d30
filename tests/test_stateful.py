"""Trips from state against the batch model."""

import os
from datetime import datetime, timedelta

import pytest

from drayline.plans import trips
from drayline.sources.tables import PartitionedTable
from drayline.streaming import stateful

START = datetime(2024, 1, 1)
POSITION = "truck_id string, event_ts timestamp, latitude double, longitude double"
ORDER = (
    "order_id bigint, truck_id string, status string, pickup_address string, delivery_address string, "
    "dispatched_at timestamp, collected_at timestamp, delivered_at timestamp, is_deleted boolean"
)


def at(minutes):
    return START + timedelta(minutes=minutes)


def ping(truck, minutes):
    return (truck, at(minutes), -25.0 - minutes % 97 / 100, -49.0 - minutes % 89 / 100)


def order(key, truck, dispatched, collected, delivered, deleted=False):
    return (key, truck, "delivered", "A", "B", at(dispatched), at(collected), at(delivered), deleted)


def land(spark, folder, parts, schema, known):
    """One file a part; a stream reads files by their time."""
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(folder))
        for path in folder.glob("*.parquet"):
            if path.name not in known:
                known[path.name] = 1_700_000_000 + len(known)
                os.utime(path, (known[path.name],) * 2)


def run(spark, folder, table, lateness):
    streams = [
        spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder / name))
        for name, schema in (("orders", ORDER), ("positions", POSITION))
    ]
    stateful.start_trips_stateful(*streams, table, str(folder / "cp"), lateness, True, state_partitions=2).awaitTermination()


def test_wrong_order_silence_restart_and_corrections(spark, tmp_path, rows):
    steady = [ping("T1", m) for m in range(0, 900, 7)]
    # Truck T2 falls silent for days: the pickup of order 2 is the first position after that.
    sparse = [ping("T2", 3), ping("T2", 5000)]
    positions = [
        [p for i, p in enumerate(steady) if i < 60 and i % 3] + sparse[:1],
        [p for i, p in enumerate(steady) if i < 60 and i % 3 == 0],  # late, within the bound
        steady[60:],
        [ping("T3", 4000)],
        sparse[1:] + [ping("T3", 5200)],
    ]
    orders = [
        [order(1, "T1", 100, 110, 130), order(2, "T2", 10, 20, 30), order(3, None, 50, 60, 70)],
        [order(4, "T1", 300, 301, 421), order(5, "T1", 300, 301, 300 + 121), order(1, "T1", 100, 110, 131)],
        [order(6, "T1", 0, 1, 2, True), order(7, "T9", 700, 705, 710), order(8, "T1", 800, 890, 899)],
        [order(9, "T3", 4001, 4002, 4003)],
        [order(10, "T3", 5000, 5100, 5101)],
    ]
    table = PartitionedTable(spark, str(tmp_path / "trips"), ["trip_date"], str(tmp_path / "staging"))
    before = {k: spark.conf.get(k, None) for k in (*stateful.STATE_STORE, "spark.sql.shuffle.partitions")}
    names = ({}, {})
    for upto in (slice(0, 3), slice(3, 5)):  # the second run goes on from the first one's checkpoint
        land(spark, tmp_path / "orders", orders[upto], ORDER, names[0])
        land(spark, tmp_path / "positions", positions[upto], POSITION, names[1])
        run(spark, tmp_path, table, "14 hours")
    assert before == {k: spark.conf.get(k, None) for k in before}
    newest = {o[0]: o for part in orders for o in part}
    expected = trips.order_trips(
        spark.createDataFrame(list(newest.values()), ORDER), spark.createDataFrame([p for part in positions for p in part], POSITION)
    )
    assert rows(table.read(), *expected.columns) == rows(expected)
    kept = {r["order_id"]: r for r in table.read().collect()}
    assert 5 not in kept and kept[2]["total_distance_km"] is not None
    assert kept[3]["truck_id"] is None and kept[7]["total_distance_km"] is None


@pytest.mark.parametrize("open_order", [False, True])
def test_state_is_bounded_by_the_watermark(open_order):
    """Positions go once the watermark has passed them by the longest trip; an unanswered order keeps its own."""

    class Handle:
        def listTimers(self):
            return []

        def registerTimer(self, at_ms):
            self.timer = at_ms

    class State:
        def __init__(self):
            self.rows = []

        def put(self, rows):
            self.rows = rows

        def clear(self):
            self.rows = []

    class Clock:
        def getCurrentWatermarkInMs(self):
            return 10_000

    matcher = stateful.TripMatcher("long", 1_000_000)
    matcher.handle, matcher.positions, matcher.orders = Handle(), State(), State()
    # All positions lie before the order's collection; the watermark is at ten seconds, the longest trip takes one.
    places = {second * 1_000_000: (0.0, 0.0) for second in range(5)}
    waiting = {1: (("A", "B", 3_000_000, 4_500_000, 5_000_000, False), None)} if open_order else {}
    told = list(matcher._advance(("=T",), places, waiting, Clock()))
    assert [p[0] for p in matcher.positions.rows] == ([2_000_000, 3_000_000, 4_000_000] if open_order else [4_000_000])
    assert bool(told) == bool(matcher.orders.rows) == open_order
    if open_order:
        # Told once; without a change nothing is told again, and an answer closes it.
        again = {o[0]: (tuple(o[1:7]), tuple(o[7:])) for o in matcher.orders.rows}
        assert not list(matcher._advance(("=T",), places, again, Clock()))
        found = list(matcher._advance(("=T",), {**places, 6_000_000: (1.0, 2.0)}, again, Clock()))[0]
        assert found[["dispatch_latitude", "pickup_latitude", "pickup_longitude"]].values.tolist() == [[0.0, 1.0, 2.0]]
        assert not matcher.orders.rows and len(matcher.positions.rows) == 1


def test_empty_streams(spark, tmp_path):
    land(spark, tmp_path / "orders", [[]], ORDER, {})
    land(spark, tmp_path / "positions", [[]], POSITION, {})
    table = PartitionedTable(spark, str(tmp_path / "trips"), ["trip_date"], str(tmp_path / "staging"))
    run(spark, tmp_path, table, "1 hour")
    assert table.read() is None or table.read().isEmpty()



def test_state_rows_are_stored_in_batches(monkeypatch):
    """A row of the state is a batch of positions or orders, not one of them."""

    class State:
        def put(self, rows):
            self.rows = rows

        def get(self):
            return iter(self.rows)

    monkeypatch.setattr(stateful, "STORED_ROWS", 400)
    nan = float("nan")
    places = [(instant, -25.0, None if instant % 2 else nan) for instant in range(1000)]
    orders = [(key, None if key % 3 else "Á", "B", 1, 2, 3, key % 2 == 0, stateful._NONE, 5, 6) for key in range(1000)]
    for rows, types in ((places, stateful._POSITION_TYPES), (orders, stateful._ORDER_TYPES)):
        stored = stateful.PackedRows(State(), types)
        stored.put(rows)
        assert len(stored.state.rows) == 3
        assert str(list(stored.get())) == str(rows)
