import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from drayline import schemas
from drayline.operators import incremental
from drayline.plans import staging
from drayline.sources import cdc, sinks

T0 = 1_700_000_000_000


def order(key, **fields):
    base = {
        "id": key, "truck_id": "TRK-001", "status": "delivered", "pickup_address": "A", "delivery_address": "B",
        "dispatched_at": T0, "collected_at": T0 + 60_000, "delivered_at": T0 + 600_000, "weight_kg": 5,
    }
    return json.dumps({**base, **fields})


def envelopes(spark, events):
    """(op, ts_ms, image, partition, offset) with the image on the side the operation uses."""
    data = [(op, ts, image if op == "d" else None, None if op == "d" else image, p, o) for op, ts, image, p, o in events]
    return spark.createDataFrame(data, cdc.envelope_schema())


def test_orders_latest_state(spark):
    feed = envelopes(
        spark,
        [
            ("c", T0, order(1, status="pending", delivered_at=None), 0, 0),
            ("u", T0 + 5, order(1, status="en_route"), 0, 1),
            ("u", T0 + 5, order(1), 0, 2),  # same millisecond: the later offset wins
            ("r", T0, order(2, status=" Delivered"), 1, 7),
            ("d", T0 + 9, json.dumps({"id": 3}), 2, 1),  # the delete image holds the key only
            ("c", T0 + 1, order(3), 2, 0),
        ],
    )
    got = {r["order_id"]: r for r in staging.stg_orders(feed).collect()}
    assert set(got) == {1, 2, 3}
    assert got[1]["status"] == "delivered" and not got[1]["is_deleted"]
    assert got[1]["dispatched_at"] == datetime.fromtimestamp(T0 / 1000, timezone.utc).replace(tzinfo=None)
    assert got[3]["is_deleted"] and got[3]["status"] is None and got[3]["ts_ms"] == T0 + 9
    assert "weight_kg" not in got[1].asDict()


def test_delete_keeps_last_values_on_demand(spark):
    stored = staging.stg_orders(envelopes(spark, [("c", T0, order(3), 0, 0)]))
    deletes = staging.stg_orders(envelopes(spark, [("d", T0 + 9, json.dumps({"id": 3}), 0, 1)]))
    merged = incremental.merge_keep_last(stored, deletes, ["order_id"], F.col("is_deleted"), ["status", "truck_id"]).first()
    assert merged["is_deleted"] and merged["status"] == "delivered" and merged["truck_id"] == "TRK-001"


def test_trucks(spark, rows):
    def truck(key, status):
        return json.dumps({"id": key, "model": "M", "capacity_kg": 9, "status": status})

    feed = envelopes(
        spark, [("c", T0, truck("a", " In_Transit "), 0, 0), ("c", T0, truck("b", "lost"), 0, 1), ("c", T0, truck("c", None), 0, 2)]
    )
    assert rows(staging.stg_trucks(feed), "truck_id", "status", "is_valid_status") == [
        ("a", "in_transit", True), ("b", "lost", False), ("c", None, False),
    ]


def positions(spark, events):
    schema = cdc.envelope_schema(append_only=True)
    return spark.createDataFrame([(op, ts, json.dumps(body), 0, o) for op, ts, body, o in events], schema)


def ping(truck="a", lat=-25.4, lon=-49.3, speed=40, ts=T0):
    return {"truck_id": truck, "latitude": lat, "longitude": lon, "speed_kmh": speed, "timestamp": ts}


def test_telemetry(spark, rows):
    feed = positions(
        spark,
        [
            ("c", T0, ping(speed=10), 0),
            ("c", T0, ping(speed=20), 1),  # repeated instant: the later offset counts
            ("c", T0, ping("b"), 2),
            ("c", T0, ping("b", lat=10.0), 3),  # the later one is invalid: the instant is dropped
            ("c", T0, ping("c", speed=-1), 4),
            ("c", T0, ping("d", lon=None), 5),
            ("u", T0, ping("e"), 6),  # updates are not positions
            ("r", T0, ping("f", lat=-26.0, lon=-49.1, speed=0), 7),  # limits included
        ],
    )
    assert rows(staging.stg_telemetry(feed), "truck_id", "speed_kmh", "fuel_level") == [("a", 20.0, None), ("f", 0.0, None)]


def test_telemetry_already_stored_is_skipped(spark, rows):
    stored = staging.stg_telemetry(positions(spark, [("c", T0, ping(), 0)]))
    later = positions(spark, [("c", T0 + 1, ping(), 1), ("c", T0 + 1, ping(ts=T0 + 1000), 2)])
    assert len(rows(staging.stg_telemetry(later, stored))) == 1


def test_offsets_per_partition(spark, rows):
    stored = envelopes(spark, [("c", T0, order(1), 0, 5), ("c", T0, order(1), 1, 2)])
    feed = envelopes(spark, [("c", T0, order(1), p, o) for p, o in [(0, 5), (0, 6), (1, 2), (1, 3), (2, 0)]])
    new = staging.raw_changes(feed, stored)
    assert rows(new, "_partition_id", "_partition_offset") == [(0, 6), (1, 3), (2, 0)]
    assert staging.raw_changes(feed, stored.limit(0)).count() == 5
    assert staging.raw_changes(feed).count() == 5


def test_watermark_of_an_empty_target_means_everything(spark):
    df = spark.createDataFrame([(1,), (2,)], "x int")
    assert incremental.after_watermark(df, df.limit(0), "x").count() == 2
    assert incremental.after_watermark(df, df.limit(1), "x").count() == 1
    assert incremental.after_watermark(df, df.limit(1), "x", inclusive=True).count() == 2


def test_malformed_images_are_set_aside(spark, rows):
    feed = envelopes(spark, [("c", T0, order(1), 0, 0), ("c", T0, '{"id": ', 0, 1), ("d", T0, order(2), 0, 2)])
    good, bad = sinks.split_dead_letters(feed, schemas.ORDER_PAYLOAD)
    assert rows(good, "_partition_offset") == [(0,), (2,)]
    assert rows(bad, "_partition_offset", "bad_record") == [(1, '{"id": ')]


def test_messages_of_a_topic(spark):
    body = json.dumps({"op": "c", "ts_ms": T0, "before": None, "after": order(4)})
    raw = spark.createDataFrame([(bytearray(body, "utf8"), 2, 77)], "value binary, partition int, offset bigint")
    row = cdc.parse_messages(raw).first()
    assert (row["op"], row["ts_ms"], row["_partition_id"], row["_partition_offset"]) == ("c", T0, 2, 77)
    assert json.loads(row["after"])["id"] == 4


def test_snapshot_feed_round_trip(spark, rows):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, s string")
    new = spark.createDataFrame([(1, "a"), (2, "B"), (4, "d")], "id int, s string")
    feed = cdc.snapshot_diff(old, new, ["id"], 5)
    assert rows(feed, "op") == [("c",), ("d",), ("u",)]
    assert rows(cdc.snapshot_diff(None, new, ["id"], 5), "op") == [("r",)] * 3
    image = F.from_json(cdc.row_image(), "id int, s string")
    applied = feed.select("op", image.alias("r"))
    upserts = applied.where("op <> 'd'").select("r.*")
    kept = incremental.delete_and_insert(old, None, applied.where("op = 'd'").select("r.id"), "id")
    assert rows(incremental.merge_upsert(kept, upserts, ["id"])) == rows(new)


def test_json_roll(spark, tmp_path):
    feed = envelopes(spark, [("c", T0 + i, order(i), 0, i) for i in range(250)]).coalesce(1)
    sinks.write_json(feed, str(tmp_path / "out"))
    files = list((tmp_path / "out").rglob("*.json"))
    assert len(files) == 3 and all(sum(1 for _ in f.open()) <= 100 for f in files)
    assert cdc.replay_files(spark, str(tmp_path / "out"), streaming=False).count() == 250


@pytest.mark.parametrize("mode", ["sync_all_columns", "append_new_columns", "ignore"])
def test_merge_schema_modes(spark, mode):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "id int, s string, old int")
    source = spark.createDataFrame([(2, "B", 9.5)], "id int, s string, fresh double")
    merged = incremental.merge_upsert(target, source, ["id"], mode)
    expected = {
        "sync_all_columns": ["id", "s", "fresh"], "append_new_columns": ["id", "s", "old", "fresh"], "ignore": ["id", "s", "old"],
    }
    assert merged.columns == expected[mode]
    assert {r["id"]: r["s"] for r in merged.collect()} == {1: "a", 2: "B"}
    with pytest.raises(ValueError):
        incremental.merge_upsert(target, source, ["id"], "fail")


def test_null_keys_never_match(spark, rows):
    target = spark.createDataFrame([(None, "a"), (1, "b")], "id int, s string")
    source = spark.createDataFrame([(None, "A"), (1, "B")], "id int, s string")
    assert rows(incremental.merge_upsert(target, source, ["id"])) == [(None, "A"), (None, "a"), (1, "B")]


def test_exact_duplicates(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (1, None)], "x int, y string")
    assert rows(incremental.drop_exact_duplicates(df)) == [(1, None), (1, None), (1, "a")]


def test_day_ranges(spark, rows):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 5),), (datetime(2024, 1, 2, 1),)], "ts timestamp")
    assert incremental.day_ranges([df, df], "ts", pad_days=1).count() == 3
    assert incremental.day_ranges([df.limit(0)], "ts").count() == 0


def test_typed_empty(spark):
    empty = incremental.typed_empty(spark, [("a b", "string"), ("n", "decimal(10,2)")])
    assert empty.dtypes == [("a b", "string"), ("n", "decimal(10,2)")] and empty.isEmpty()
