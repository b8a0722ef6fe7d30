"""Change feeds: landing, decoding, staging, snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from drayline.operators import incremental
from drayline.plans import derived, staging
from drayline.registry.base import Tables, query
from drayline.plans.derived import DISTRICTS
from drayline import schemas
from drayline.session import scratch_path
from drayline.sources import cdc
from drayline.sources.ledger import OffsetLedger

_LIST = "[" + ", ".join(f"'{d}'" for d in DISTRICTS) + "]"
_OP = (
    "CASE event_type WHEN 'signup' THEN 'c' WHEN 'view' THEN 'r' WHEN 'click' THEN 'u' "
    "WHEN 'purchase' THEN 'u' WHEN 'error' THEN 'd' END"
)
# What the decoded change events amount to, straight from the event table.
_ORDERS = f"""
changes AS (
  SELECT CAST(user_id AS INT) AS order_id, 'TRK-' || (user_id % 50) AS truck_id,
    CASE WHEN event_id % 3 = 0 THEN 'delivered' ELSE 'en_route' END AS status,
    ({_LIST})[CAST(event_id * 13 % 6 AS INT) + 1] AS pickup_address,
    ({_LIST})[CAST((event_id * 13 % 6 + 1 + event_id * 17 % 5) % 6 AS INT) + 1] AS delivery_address,
    date_trunc('millisecond', ts) AS dispatched_at,
    date_trunc('millisecond', ts) + CAST(1 + event_id * 37 % 8 AS INT) * INTERVAL 1 MINUTE AS collected_at,
    CASE WHEN event_id % 3 = 0 THEN date_trunc('millisecond', ts) + INTERVAL 15 MINUTE END AS delivered_at,
    epoch_us(ts) // 1000 AS ts_ms, {_OP} = 'd' AS is_deleted, event_id, user_id % 3 AS part
  FROM events)"""
_ORDER_COLUMNS = (
    "order_id, truck_id, status, pickup_address, delivery_address, dispatched_at, collected_at, delivered_at, ts_ms, is_deleted"
)
_STG_ORDERS = (
    f"WITH {_ORDERS} SELECT {_ORDER_COLUMNS} FROM (SELECT *, row_number() OVER "
    "(PARTITION BY order_id ORDER BY ts_ms DESC, event_id DESC) AS rn FROM changes) WHERE rn = 1"
)


def _naive(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the SQL side has them."""
    return df.select(
        *[
            F.col(n).cast("timestamp_ntz").alias(n) if kind == "timestamp" else F.col(n)
            for n, kind in df.dtypes
        ]
    )


_NEW_OFFSETS = (
    f"SELECT {_OP} AS op, epoch_us(ts) // 1000 AS ts_ms, CAST(user_id % 3 AS INT) AS part, event_id AS _partition_offset FROM events e "
    "WHERE event_id > (SELECT coalesce(max(event_id), -1) FROM events s WHERE s.event_id % 10 < 7 "
    "AND s.ts < TIMESTAMP '2024-01-16' AND s.user_id % 3 = e.user_id % 3 AND s.user_id % 3 <> 2)"
)


@query("raw_new_offsets", _NEW_OFFSETS)
def raw_new_offsets(t: Tables) -> DataFrame:
    """Events past the stored offset of their partition; one partition has never been stored."""
    feed = derived.order_changes(t.events)
    seen = t.events.where(
        (F.col("event_id") % 10 < 7)
        & (F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"))
        & (F.col("user_id") % 3 != 2)
    )
    new = staging.raw_changes(feed, derived.order_changes(seen))
    return new.select("op", "ts_ms", F.col("_partition_id").alias("part"), "_partition_offset")


@query("ledger_new_offsets", _NEW_OFFSETS)
def ledger_new_offsets(t: Tables) -> DataFrame:
    """The same from a ledger of three batches with gaps, one of them committed twice: no landed event is read."""
    feed = derived.order_changes(t.events)
    seen = derived.order_changes(t.events.where("event_id % 10 < 7 AND ts < TIMESTAMP_NTZ '2024-01-16' AND user_id % 3 <> 2"))
    ledger = OffsetLedger(t.spark, scratch_path(t.spark, "ledger_new_offsets"))
    for k in (0, 1, 1, 2):
        ledger.commit(k + 1, seen.where(F.col("_partition_offset") % 3 == k))
    new = incremental.after_marks(staging.raw_changes(feed), ledger.marks())
    return new.select("op", "ts_ms", F.col("_partition_id").alias("part"), "_partition_offset")


@query("stg_orders", _STG_ORDERS)
def stg_orders(t: Tables) -> DataFrame:
    return _naive(staging.stg_orders(derived.order_changes(t.events)))


@query("stg_orders_incremental", _STG_ORDERS)
def stg_orders_incremental(t: Tables) -> DataFrame:
    """Staging in two runs, the second reading only newer events, equals staging at once."""
    raw = derived.order_changes(t.events)
    early = t.events.where(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"))
    stored = staging.stg_orders(derived.order_changes(early))
    return _naive(incremental.merge_upsert(stored, staging.stg_orders(raw, stored), ["order_id"]))


@query("stg_orders_any_order", _STG_ORDERS)
def stg_orders_any_order(t: Tables) -> DataFrame:
    """Batches delivered newest first, merged by version, give the same state."""
    cut = F.lit("2024-01-16").cast("timestamp_ntz")
    late = staging.stg_orders(derived.order_changes(t.events.where(F.col("ts") >= cut)))
    early = staging.stg_orders(derived.order_changes(t.events.where(F.col("ts") < cut)))
    return _naive(incremental.merge_latest(late, early, ["order_id"], ["ts_ms"]))


@query(
    "stg_trucks",
    f"""WITH changes AS (SELECT 'TRK-' || user_id AS truck_id, 'M' || (event_id % 5) AS model,
    CAST(10000 + event_id % 7 * 1000 AS INT) AS capacity_kg,
    (['available', 'in_transit', 'maintenance', 'broken'])[CAST(event_id % 4 AS INT) + 1] AS status,
    event_id % 4 <> 3 AS is_valid_status, epoch_us(ts) // 1000 AS ts_ms, {_OP} = 'd' AS is_deleted, event_id FROM events)
    SELECT truck_id, model, capacity_kg, status, is_valid_status, ts_ms, is_deleted FROM (SELECT *, row_number() OVER
    (PARTITION BY truck_id ORDER BY ts_ms DESC, event_id DESC) AS rn FROM changes) WHERE rn = 1""",
)
def stg_trucks(t: Tables) -> DataFrame:
    return staging.stg_trucks(derived.truck_changes(t.events))


_TELEMETRY = f"""WITH changes AS (SELECT 'TRK-' || (user_id % 50) AS truck_id,
    CAST(CASE WHEN event_id % 31 = 0 THEN 10.0 ELSE round(-26.0 + (event_id * 7919 % 1000) * 0.0008, 4) END AS DOUBLE) AS latitude,
    CAST(round(-49.5 + (event_id * 104729 % 1000) * 0.0004, 4) AS DOUBLE) AS longitude,
    CAST(CASE WHEN event_id % 37 = 0 THEN -(event_id % 80) ELSE event_id % 80 END AS DOUBLE) AS speed_kmh,
    CAST(NULL AS VARCHAR) AS fuel_level, date_trunc('hour', ts) AS event_ts, epoch_us(ts) // 1000 AS ts_ms,
    event_id, {_OP} AS op FROM events)
    SELECT truck_id, latitude, longitude, speed_kmh, fuel_level, event_ts, ts_ms FROM (SELECT *, row_number() OVER
    (PARTITION BY truck_id, event_ts ORDER BY event_id DESC) AS rn FROM changes WHERE op IN ('c', 'r')) WHERE rn = 1
    AND latitude BETWEEN -26.0 AND -25.2 AND longitude BETWEEN -49.5 AND -49.1 AND speed_kmh >= 0"""


@query("stg_telemetry", _TELEMETRY)
def stg_telemetry(t: Tables) -> DataFrame:
    return _naive(staging.stg_telemetry(derived.telemetry_changes(t.events)))


@query(
    "change_image",
    f"SELECT event_id AS _partition_offset, {_OP} AS op, {_OP} = 'd' AS is_deleted, "
    "CAST(user_id AS INT) AS id, 'TRK-' || (user_id % 50) AS truck_id FROM events",
)
def change_image(t: Tables) -> DataFrame:
    """The image before a delete, the one after anything else, parsed once."""
    decoded = cdc.decode(derived.order_changes(t.events), schemas.ORDER_PAYLOAD)
    return decoded.select("_partition_offset", "op", "is_deleted", "row.id", "row.truck_id")


@query(
    "dead_letters",
    "SELECT event_id AS _partition_offset, '{\"id\":' || event_id AS bad_record FROM events WHERE event_id % 50 = 3",
)
def dead_letters(t: Tables) -> DataFrame:
    """Envelopes with a truncated image are set aside with their text."""
    feed = derived.order_changes(t.events)
    broken = F.concat(F.lit('{"id":'), F.col("_partition_offset").cast("string"))
    damaged = F.col("_partition_offset") % 50 == 3
    feed = feed.withColumn("before", F.when(damaged, broken).otherwise(F.col("before"))).withColumn(
        "after", F.when(damaged, broken).otherwise(F.col("after"))
    )
    return cdc.dead_letters(cdc.decode(feed, schemas.ORDER_PAYLOAD)).select("_partition_offset", "bad_record")


@query(
    "snapshot_diff",
    """WITH old AS (SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey % 7 <> 0),
    new AS (SELECT c_custkey, c_name, CASE WHEN c_custkey % 5 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal
      FROM customer WHERE c_custkey % 11 <> 0)
    SELECT coalesce(o.c_custkey, n.c_custkey) AS c_custkey, CASE WHEN o.c_custkey IS NULL THEN 'c'
      WHEN n.c_custkey IS NULL THEN 'd' ELSE 'u' END AS op, 1700000000000 AS ts_ms
    FROM old o FULL JOIN new n USING (c_custkey)
    WHERE o.c_custkey IS NULL OR n.c_custkey IS NULL OR o.c_acctbal <> n.c_acctbal""",
)
def snapshot_diff(t: Tables) -> DataFrame:
    columns = ["c_custkey", "c_name", "c_acctbal"]
    key = F.col("c_custkey")
    old = t.customer.where(key % 7 != 0).select(*columns)
    new = t.customer.where(key % 11 != 0).select(
        "c_custkey", "c_name", F.when(key % 5 == 0, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")).alias("c_acctbal")
    )
    feed = cdc.snapshot_diff(old, new, ["c_custkey"], 1700000000000)
    image = F.coalesce("after", "before")
    return feed.select(F.get_json_object(image, "$.c_custkey").cast("bigint").alias("c_custkey"), "op", "ts_ms")


@query("snapshot_first_load", "SELECT 'r' AS op, CAST(5 AS BIGINT) AS ts_ms, n_nationkey, n_name FROM nation")
def snapshot_first_load(t: Tables) -> DataFrame:
    feed = cdc.snapshot_diff(None, t.nation, ["n_nationkey"], 5)
    return feed.select(
        "op", "ts_ms",
        F.get_json_object("after", "$.n_nationkey").cast("int").alias("n_nationkey"),
        F.get_json_object("after", "$.n_name").alias("n_name"),
    )
