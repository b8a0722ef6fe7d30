"""Change logs, replacement by key, and what follows a changed day."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from drayline.operators import incremental
from drayline.plans import trips
from drayline.plans.lakehouse import Lakehouse
from drayline.sources.change_log import ChangeLog
from drayline.sources.tables import PartitionedTable


def test_readers_see_each_entry_until_they_are_done(spark, tmp_path, rows):
    log = ChangeLog(spark, str(tmp_path / "log"))
    assert log.pending("a").everything  # never ran
    log.advance("a", log.pending("a").upto)
    assert log.pending("a").rows is None and not log.pending("a").everything
    for k in (1, 2):
        log.append(spark.createDataFrame([(k,)], "k int"))
    seen = log.pending("a")
    assert rows(seen.rows, "k") == [(1,), (2,)] and log.pending("b").everything
    log.append(spark.createDataFrame([(3,)], "k int"))
    log.advance("a", seen.upto)
    assert rows(log.pending("a").rows, "k") == [(3,)]
    (tmp_path / "log" / f"{log.newest() + 1:012d}").mkdir()  # a writer at work, or one that died
    assert log.pending("a").upto == log.newest() - 1
    log.append(spark.createDataFrame([(4,)], "k int"))
    assert rows(log.pending("a").rows, "k") == [(3,), (4,)]
    log.append_all()
    assert log.pending("a").everything
    log.advance("a", log.pending("a").upto)
    assert not log.pending("a").everything
    assert log.append(spark.createDataFrame([(5,)], "k int")) > seen.upto and rows(log.pending("a").rows, "k") == [(5,)]


def test_replace_keys(spark, tmp_path, rows):
    make = lambda data: spark.createDataFrame(data, "id int, p string, v int")
    table, log = PartitionedTable(spark, str(tmp_path / "t"), ["p"]), ChangeLog(spark, str(tmp_path / "log"))
    table.replace_keys(make([(1, "a", 1), (2, "a", 2), (3, "b", 3), (None, "c", 4)]), make([]), ["id"], log)
    assert log.pending("r").everything
    log.advance("r", log.pending("r").upto)
    dirty = spark.createDataFrame([(1,), (3,), (9,), (None,)], "id int")
    # 1 moves to another partition, 3 comes as it was, the null key goes with its partition, 9 is not there
    table.replace_keys(make([(1, "b", 1), (3, "b", 3)]), dirty, ["id"], log, ["id", "p"])
    assert rows(table.read(), "id", "p", "v") == [(1, "b", 1), (2, "a", 2), (3, "b", 3)]
    assert rows(log.pending("r").rows, "id", "p") == [(None, "c"), (1, "a"), (1, "b")]
    before = sorted(str(f) for f in (tmp_path / "t").rglob("*.parquet"))
    table.replace_keys(make([(1, "b", 1), (3, "b", 3)]), dirty, ["id"], log)
    assert sorted(str(f) for f in (tmp_path / "t").rglob("*.parquet")) == before  # nothing differs, nothing is written
    wide = make([(2, "a", 5)]).withColumn("w", F.lit(7))
    table.replace_keys(wide, wide.select("id"), ["id"], log)
    assert rows(table.read(), "id", "v", "w") == [(1, 1, None), (2, 5, 7), (3, 3, None)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rows_after_changes_against_recomputing(spark, rows, seed):
    import random

    rng = random.Random(seed)
    day = lambda d: date(2024, 1, 1) + timedelta(days=d)
    kept = lambda: {(k, d): rng.randint(0, 9) for k in ("x", "y", None) for d in range(25) if rng.random() < 0.6}
    old, new = kept(), kept()
    dirty = {place for place in {*old, *new} if rng.random() < 0.15}
    now = {p: v for p, v in old.items() if p not in dirty} | {p: new[p] for p in dirty if p in new}

    def window(cells, k, d):
        return [cells[p] for p in sorted((p for p in cells if p[0] == k and p[1] <= d), key=lambda p: p[1])][-4:]

    frame = lambda cells: spark.createDataFrame([(k, day(d), v) for (k, d), v in cells.items()], "k string, day date, v int")
    fresh = frame({p: v for p, v in now.items() if p in dirty})
    places = spark.createDataFrame([(k, day(d)) for k, d in dirty], "k string, day date")
    got = incremental.rows_after_changes(fresh, frame(old), places, ["k"], "day", 3).collect()
    flagged = {(r["k"], (r["day"] - day(0)).days) for r in got if r["_affected"]}
    assert flagged >= {p for p in now if p in dirty or window(now, *p) != window(old, *p)}
    have = {(r["k"], (r["day"] - day(0)).days): r["v"] for r in got}
    assert all(window(have, *p) == window(now, *p) for p in flagged)


ORDER = "order_id int, truck_id string, status string, pickup_address string, delivery_address string, " \
    "dispatched_at timestamp, collected_at timestamp, delivered_at timestamp, is_deleted boolean, ts_ms bigint, _partition_offset bigint"
PING = "truck_id string, latitude double, longitude double, speed_kmh double, event_ts timestamp"


def test_one_new_order_reads_one_entry(spark, tmp_path, rows, monkeypatch):
    start = datetime(2024, 1, 1)

    def order(i, day):
        at = [start + timedelta(days=day, minutes=m) for m in (0, 5, 12)]
        return (i, "a", "delivered", "P", "D", *at, False, 1, i)

    pings = [("a", -25.5 + m / 1e4, -49.3, 9.0, start + timedelta(days=d, minutes=m)) for d in range(9) for m in range(-3, 30, 3)]
    lake = Lakehouse(spark, str(tmp_path / "lake"), key_buckets=2)
    lake.land_orders(spark.createDataFrame([order(d, d) for d in range(8)], ORDER))
    trucks = "truck_id string, model string, capacity_kg int, status string, is_deleted boolean, ts_ms bigint, _partition_offset bigint"
    lake.land_trucks(spark.createDataFrame([("a", "M", 1, "available", False, 1, 1)], trucks))
    lake.land_positions(spark.createDataFrame(pings, PING))
    lake.build()
    written = {n: sorted(str(f) for f in (tmp_path / "lake" / n).rglob("*.parquet")) for n in ("silver", "gold")}
    lake.build()  # nothing new: no step computes or writes anything
    assert written == {n: sorted(str(f) for f in (tmp_path / "lake" / n).rglob("*.parquet")) for n in written}

    lake.land_orders(spark.createDataFrame([order(100, 3)], ORDER))
    matched, plans = [], []
    original = trips.order_trips

    def spy(orders, telemetry, *args, **options):
        plans.append(orders._jdf.queryExecution().optimizedPlan().toString())
        matched.extend(r[0] for r in orders.select("order_id").collect())
        return original(orders, telemetry, *args, **options)

    monkeypatch.setattr(trips, "order_trips", spy)
    lake.build()
    assert matched == [100] and set(orders_files(spark, plans)) == {"_changes"}
    after = sorted(str(f) for f in (tmp_path / "lake" / "silver" / "order_trips").rglob("*.parquet"))
    gone = [f for f in written["silver"] if "/order_trips/" in f and f not in after]
    assert len(gone) == 1 and "trip_date=2024-01-04" in gone[0]
    assert rows(lake.otd.read().where("trip_date = '2024-01-04'"), "total_orders") == [(2,)]

    # A position in order of time matches nothing again; one in the midst of a stored trip does.
    newer = [("a", -25.4, -49.3, 9.0, start + timedelta(days=20))]
    lake.land_positions(spark.createDataFrame(newer, PING))
    matched.clear()
    lake.build()
    assert matched == []
    lake.land_positions(spark.createDataFrame([("a", -25.4, -49.3, 9.0, start + timedelta(days=2, minutes=5))], PING))
    lake.build()
    assert sorted(matched) == [*range(8), 100]
    final = lake.order_trips.read()
    whole = original(lake.stg_orders.read(), lake.stg_telemetry.read())
    assert rows(final, *whole.columns) == rows(whole)


def orders_files(spark, plans):
    """The first folder below the base of what the relations of some plans read: here told by their columns."""
    for plan in plans:
        relations = [line for line in plan.splitlines() if "Relation [" in line]
        assert relations
        for line in relations:
            yield "_changes" if "_entry#" in line else line
