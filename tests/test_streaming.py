"""Replays of the feeds in several batches against batch processing."""

import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from drayline import schemas
from drayline.operators import checks
from drayline.plans import derived, staging, trips
from drayline.plans.lakehouse import Lakehouse
from drayline.sources import cdc
from drayline.sources.tables import PartitionedTable
from drayline.streaming import ingest

T0 = 1_704_067_200_000  # 2024-01-01 UTC
MINUTE = 60_000


def write_batches(folder, events, size):
    """Envelopes as JSON lines, one file per batch."""
    folder.mkdir(parents=True, exist_ok=True)
    for n, i in enumerate(range(0, len(events), size)):
        path = folder / f"batch-{n:03}.json"
        with open(path, "w") as f:
            f.writelines(json.dumps(e) + "\n" for e in events[i : i + size])
        os.utime(path, (1_700_000_000 + n, 1_700_000_000 + n))  # a stream reads files by their time


def envelope(op, ts, image, offset, partition=0, with_before=True):
    row = {"op": op, "ts_ms": ts, "_partition_id": partition, "_partition_offset": offset}
    if not with_before:
        return {**row, "after": json.dumps(image)}
    return {**row, "before": json.dumps(image) if op == "d" else None, "after": None if op == "d" else json.dumps(image)}


def order(key, status="delivered", **fields):
    base = {"id": key, "truck_id": "T1", "status": status, "pickup_address": "A", "delivery_address": "B"}
    times = {"dispatched_at": T0 + key * 10 * MINUTE, "collected_at": T0 + (key * 10 + 4) * MINUTE, "delivered_at": T0 + (key * 10 + 12) * MINUTE}
    return {**base, **times, **fields}


def order_events():
    """Each order is created, updated and now and then deleted; offsets run per partition."""
    events, offsets = [], {0: 0, 1: 0}
    for step, status in enumerate(("pending", "en_route", "delivered")):
        for key in range(12):
            p = key % 2
            events.append(envelope("c" if step == 0 else "u", T0 + step * 100 + key, order(key, status), offsets[p], p))
            offsets[p] += 1
    for key in (3, 8):
        events.append(envelope("d", T0 + 500 + key, order(key), offsets[key % 2], key % 2))
        offsets[key % 2] += 1
    return events


def ping_events():
    events = []
    for i in range(140):
        body = {"truck_id": "T1", "latitude": -25.9 + i * 0.001, "longitude": -49.3, "speed_kmh": i % 50, "timestamp": T0 + (i - 5) * MINUTE}
        events.append(envelope("c", T0 + i, body, len(events), with_before=False))
        if i % 20 == 0:
            events.append(envelope("c", T0 + i, body, len(events), with_before=False))  # sent twice
    return events


def truck_events():
    return [envelope("r", T0, {"id": "T1", "model": "M", "capacity_kg": 9, "status": " Available "}, 0)]


@pytest.fixture
def folder(tmp_path):
    write_batches(tmp_path / "orders", order_events(), 9)
    write_batches(tmp_path / "pings", ping_events(), 37)
    return tmp_path


def test_raw_lands_each_event_once(spark, folder):
    path, checkpoint = str(folder / "raw"), str(folder / "raw-cp")
    for _ in range(2):  # the second run finds nothing new
        feed = cdc.replay_files(spark, str(folder / "orders"), max_files_per_trigger=1)
        ingest.start_raw(feed, path, checkpoint, available_now=True).awaitTermination()
    assert spark.read.parquet(path).count() == len(order_events())


def test_state_equals_batch(spark, folder, rows):
    table = PartitionedTable(spark, str(folder / "state"), ["truck_id"], str(folder / "staging"))
    feed = cdc.replay_files(spark, str(folder / "orders"), max_files_per_trigger=1)
    ingest.start_state(feed, staging.stg_orders, table, ["order_id"], str(folder / "cp"), None, True).awaitTermination()
    batch = staging.stg_orders(cdc.replay_files(spark, str(folder / "orders"), streaming=False))
    assert rows(table.read(), *batch.columns) == rows(batch)


@pytest.mark.parametrize("reverse", [False, True])
def test_positions_equal_the_batch_model_in_any_file_order(spark, tmp_path, rows, reverse):
    """Late, repeated and corrected positions; an instant whose newest event is invalid is dropped."""
    events = ping_events()
    body = json.loads(events[30]["after"])
    events.append(envelope("c", T0 + 900, {**body, "speed_kmh": -1}, len(events), with_before=False))
    body = json.loads(events[50]["after"])
    events.append(envelope("c", T0 + 901, {**body, "latitude": -25.5}, len(events), with_before=False))
    write_batches(tmp_path / "pings", events, 37)
    if reverse:
        for n, path in enumerate(sorted((tmp_path / "pings").iterdir(), reverse=True)):
            os.utime(path, (1_600_000_000 + n, 1_600_000_000 + n))
    table = PartitionedTable(spark, str(tmp_path / "t"), ["event_date"], str(tmp_path / "staging"))
    feed = cdc.replay_files(spark, str(tmp_path / "pings"), append_only=True, max_files_per_trigger=1)
    ingest.start_positions(feed, table, str(tmp_path / "cp"), True).awaitTermination()
    batch = staging.stg_telemetry(cdc.replay_files(spark, str(tmp_path / "pings"), append_only=True, streaming=False))
    assert rows(ingest.stored_positions(table), *batch.columns) == rows(batch) and batch.count() == 139


def test_late_rows_are_stored(spark, tmp_path, rows):
    events = [envelope("c", T0, {"truck_id": "T1", "latitude": -25.5, "longitude": -49.3, "speed_kmh": 1, "timestamp": T0 + m * MINUTE}, i, with_before=False) for i, m in enumerate((0, 100, 95, 10, 300, 285, 20))]
    write_batches(tmp_path / "pings", events, 2)
    feed = cdc.replay_files(spark, str(tmp_path / "pings"), append_only=True, max_files_per_trigger=1)
    timed = staging.cdc.decode(feed, schemas.TELEMETRY_PAYLOAD, has_before=False).select("_partition_offset", F.timestamp_millis("row.timestamp").alias("t"))
    ingest.start_late_log(timed, "t", "10 minutes", str(tmp_path / "late"), str(tmp_path / "cp"), True).awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "late" / "rows")), "_partition_offset") == [(3,), (6,)]


def test_telemetry_dedup(spark, folder):
    feed = cdc.replay_files(spark, str(folder / "pings"), append_only=True, max_files_per_trigger=1)
    out = ingest.telemetry(feed).writeStream.format("parquet").option("path", str(folder / "out"))
    out.option("checkpointLocation", str(folder / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(str(folder / "out")).count() == 140


def test_hourly_pings_append_after_the_watermark(spark, folder, rows):
    feed = cdc.replay_files(spark, str(folder / "pings"), append_only=True, max_files_per_trigger=1)
    hours = ingest.hourly_pings(ingest.telemetry(feed, "10 minutes"), lateness=None)
    out = hours.writeStream.format("parquet").outputMode("append").option("path", str(folder / "out"))
    out.option("checkpointLocation", str(folder / "cp")).trigger(availableNow=True).start().awaitTermination()
    closed = spark.read.parquet(str(folder / "out"))
    # 23:55 to 02:14: two hours are closed, the last is still open
    assert rows(closed, "activity_hour", "ping_count") == [(datetime(2023, 12, 31, 23), 5), (datetime(2024, 1, 1), 60), (datetime(2024, 1, 1, 1), 60)]


def test_upserted_windows(spark, folder, rows):
    feed = cdc.replay_files(spark, str(folder / "orders"), max_files_per_trigger=1)
    timed = feed.withColumn("t", F.timestamp_millis("ts_ms"))
    counts = ingest.bucket_counts(timed, "t", "1 hour", "1 day", group_by=["op"])
    counts = counts.withColumn("day", F.to_date("bucket_start"))
    table = PartitionedTable(spark, str(folder / "counts"), ["day"], str(folder / "staging"))
    ingest.start_upserts(counts, table, ["bucket_start", "op"], str(folder / "cp"), available_now=True).awaitTermination()
    assert rows(table.read(), "op", "row_count") == [("c", 12), ("d", 2), ("u", 24)]


def test_registry_join(spark, folder):
    feed = cdc.replay_files(spark, str(folder / "pings"), append_only=True)
    trucks = spark.createDataFrame([("T1", "M", 9, False)], "truck_id string, model string, capacity_kg int, is_deleted boolean")
    out = ingest.with_registry(ingest.telemetry(feed), trucks).writeStream.format("parquet").option("path", str(folder / "out"))
    out.option("checkpointLocation", str(folder / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(str(folder / "out")).where("model = 'M'").count() == 140


def test_late_rows_refresh_their_days(spark, tmp_path, rows):
    write_batches(tmp_path / "late", [envelope("c", T0 + d * 86_400_000, order(1), d) for d in (0, 5, 5)], 1)
    table = PartitionedTable(spark, str(tmp_path / "out"), ["day"], str(tmp_path / "staging"))
    asked = []

    def recompute(days):
        asked.append(days.count())
        return days.withColumn("n", F.lit(1))

    feed = cdc.replay_files(spark, str(tmp_path / "late"), max_files_per_trigger=1)
    day = F.to_date(F.timestamp_millis("ts_ms")).alias("day")
    ingest.start_refresh(feed, lambda b: b.select(day), recompute, table, str(tmp_path / "cp"), True).awaitTermination()
    assert len(asked) == 3 and table.read().count() == 2


def feeds(spark, tmp_path, orders, pings, trucks):
    spec = {"orders": (orders, False), "truck_telemetry": (pings, True), "trucks": (trucks, False)}
    out = {}
    for name, (events, append_only) in spec.items():
        out[name] = spark.createDataFrame([(json.dumps(e),) for e in events], "value string").select(
            F.from_json("value", cdc.envelope_schema(append_only)).alias("e")
        ).select("e.*")
    return out


def test_lakehouse_in_steps_equals_at_once(spark, tmp_path, rows):
    orders, pings, trucks = order_events(), ping_events(), truck_events()
    at_once = Lakehouse(spark, str(tmp_path / "a"), key_buckets=2)
    at_once.ingest(feeds(spark, tmp_path, orders, pings, trucks))
    at_once.build(full_refresh=True)

    stepwise = Lakehouse(spark, str(tmp_path / "b"), key_buckets=2)
    as_of = datetime(2024, 1, 2).date()
    for share in (0.5, 0.8, 1.0):  # every feed always starts at its beginning, as a topic does
        cut = [events[: int(len(events) * share) or 1] for events in (orders, pings, trucks)]
        stepwise.ingest(feeds(spark, tmp_path, *cut))
        if share > 0.5:
            stepwise.build(as_of=as_of)
    for name in ("stg_orders", "stg_trucks", "stg_telemetry"):
        a, b = getattr(at_once, name).read(), getattr(stepwise, name).read()
        assert rows(a) == rows(b.select(*a.columns)), name
    assert at_once.order_trips.read().count() == 12
    # Trips are matched once, when they complete; the positions known then decide.
    assert stepwise.order_trips.read().select("order_id").distinct().count() == stepwise.order_trips.read().count()

    results = at_once.check(datetime(2024, 1, 3))
    assert {r["status"] for r in results.collect()} <= {"pass", "warn"}
    log = spark.read.schema(schemas.RUN_RESULTS).parquet(stepwise.run_results)
    assert log.where("status = 'success'").count() == 10 and checks.unique(log, "model_execution_id").isEmpty()


def test_rebuild_is_idempotent(spark, tmp_path, rows):
    lake = Lakehouse(spark, str(tmp_path / "a"), key_buckets=2)
    source = feeds(spark, tmp_path, order_events(), ping_events(), truck_events())
    lake.ingest(source)
    lake.build(full_refresh=True)
    first = {n: rows(getattr(lake, n).read()) for n in ("order_trips", "truck_activity", "otd", "district_heatmap", "fleet_utilization")}
    lake.ingest(source)  # nothing new
    lake.build(as_of=datetime(2024, 1, 2).date())
    for name, before in first.items():
        assert rows(getattr(lake, name).read()) == before, name


def test_stream_trips(spark, folder, rows):
    positions = staging.stg_telemetry(cdc.replay_files(spark, str(folder / "pings"), append_only=True, streaming=False))
    table = PartitionedTable(spark, str(folder / "trips"), ["trip_date"], str(folder / "staging"))
    staged = staging.stg_orders(cdc.replay_files(spark, str(folder / "orders"), streaming=False))
    staged.write.parquet(str(folder / "staged"))
    stream = spark.readStream.schema(staged.schema).parquet(str(folder / "staged"))
    ingest.start_trips(stream, lambda: positions, table, str(folder / "cp"), available_now=True).awaitTermination()
    expected = trips.order_trips(staged, positions)
    assert rows(table.read(), *expected.columns) == rows(expected)




def test_positions_after_the_trip_correct_it(spark, folder, rows):
    all_positions = staging.stg_telemetry(cdc.replay_files(spark, str(folder / "pings"), append_only=True, streaming=False))
    orders = staging.stg_orders(cdc.replay_files(spark, str(folder / "orders"), streaming=False))
    all_positions.write.parquet(str(folder / "positions"))
    stored = spark.read.parquet(str(folder / "positions"))
    table = PartitionedTable(spark, str(folder / "trips"), ["trip_date"], str(folder / "staging"))
    table.overwrite(trips.order_trips(orders, stored.where(F.minute("event_ts") % 3 == 0)))
    stream = spark.readStream.schema(stored.schema).parquet(str(folder / "positions"))
    ingest.start_trip_revision(stream, lambda: orders, lambda: stored, table, str(folder / "cp"), True).awaitTermination()
    full = trips.order_trips(orders, stored)
    assert rows(table.read(), *full.columns) == rows(full)


@pytest.mark.parametrize("step", ["_stage_orders", "_stage_truck_telemetry"])
def test_a_failed_ingest_is_completed(spark, tmp_path, rows, monkeypatch, step):
    source = feeds(spark, tmp_path, order_events(), ping_events(), truck_events())
    broken = spark.createDataFrame(
        [("u", T0 + 9000, None, '{"id": 4, "tru', 0, 99)], "op string, ts_ms bigint, before string, after string, _partition_id int, _partition_offset bigint"
    )
    source["orders"] = source["orders"].unionByName(broken, allowMissingColumns=True)
    whole = Lakehouse(spark, str(tmp_path / "a"), key_buckets=2)
    whole.ingest({name: df.limit(0) for name, df in source.items()})  # an empty first batch
    whole.ingest(source)
    lake = Lakehouse(spark, str(tmp_path / "b"), key_buckets=2)
    original = getattr(Lakehouse, step)
    monkeypatch.setattr(Lakehouse, step, lambda self, batch: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        lake.ingest(source)
    monkeypatch.setattr(Lakehouse, step, original)
    Lakehouse(spark, str(tmp_path / "b"), key_buckets=2).ingest(source)
    for name in ("stg_orders", "stg_trucks", "stg_telemetry", "dead_letters"):
        a, b = getattr(whole, name).read(), getattr(lake, name).read()
        assert rows(a) == rows(b.select(*a.columns)), name
    for name in source:
        assert whole.raw[name].read().count() == lake.raw[name].read().count() == source[name].count()
    assert rows(lake.dead_letters.read(), "feed", "_partition_offset") == [("orders", 99)]


def test_an_older_truck_event_never_wins(spark, tmp_path, rows):
    lake = Lakehouse(spark, str(tmp_path / "a"), key_buckets=2)
    event = lambda ts, status, offset: envelope("u", ts, {"id": "T1", "model": "M", "capacity_kg": 9, "status": status}, offset)
    for events in ([event(2000, "maintenance", 0)], [event(1000, "available", 1)], [event(2000, "in_transit", 2)]):
        lake.ingest({"trucks": feeds(spark, tmp_path, [], [], events)["trucks"]})
    assert rows(lake.stg_trucks.read(), "status", "ts_ms") == [("in_transit", 2000)]


def test_pieces_of_events_are_several_files(spark, tmp_path, monkeypatch, rows):
    """A task writes a bounded number of events, however many there are, and the batches stay as many."""
    from drayline.registry import streams
    from drayline.registry.base import Tables

    spark.range(1000).selectExpr(
        "id AS event_id", "timestamp_ntz '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, CAST(id AS INT)) AS ts",
        "id % 7 AS user_id", "if(id % 5 = 0, 'purchase', 'view') AS event_type", "0.5D AS value", "CAST(null AS STRING) AS props",
    ).write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(streams, "FILE_EVENTS", 60)
    t = Tables(spark, str(tmp_path))
    stream = streams._pieces(t, str(tmp_path))
    stored = spark.read.parquet(str(tmp_path / "pieces"))
    sizes = [r["count"] for r in stored.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 20 and max(sizes) <= 100
    assert sorted(r[0] for r in stored.select("event_id").collect()) == list(range(1000))
    seen = []
    writer = stream.writeStream.foreachBatch(lambda batch, _: seen.append(batch.count()))
    writer.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert len(seen) == 4 and sum(seen) == 1000
    # Trips from several files a piece are those of the batch model.
    expected = trips.order_trips(derived.orders(t.events), derived.pings(t.events))
    found = streams.stream_trips_stateful(t)
    assert rows(found, *expected.columns) == rows(expected)
