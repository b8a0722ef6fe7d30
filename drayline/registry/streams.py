"""Structured Streaming queries, run over the event table until it is exhausted.

The table's files are read as a stream; results are written below the shared
folder and read back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from drayline import schemas
from drayline.plans import derived, staging, trips
from drayline.plans.lakehouse import Lakehouse
from drayline.registry import ctes, feeds
from drayline.registry.base import Tables, query, with_ctes
from drayline.session import shared_dir
from drayline.sources.tables import PartitionedTable, with_key_bucket
from drayline.streaming import ingest, stateful
from drayline.sources import sinks


def _stream(t: Tables) -> DataFrame:
    return t.spark.readStream.schema(t.events.schema).parquet(f"{t.folder}/events.parquet*")


#: Events that one task writes into a file; a micro-batch takes as many files as its share of the events needs.
FILE_EVENTS = 500_000


def _files_a_piece(t: Tables, pieces: int) -> int:
    return max(1, -(-t.events.count() // (pieces * FILE_EVENTS)))


def _pieces(t: Tables, folder: str, pieces: int = 4) -> DataFrame:
    """The same events as several files, dealt by a hash, in so many micro-batches."""
    source, files = f"{folder}/pieces", _files_a_piece(t, pieces)
    t.events.repartition(pieces * files, F.xxhash64("event_id")).write.option("maxRecordsPerFile", 0).parquet(source)
    return t.spark.readStream.schema(t.events.schema).option("maxFilesPerTrigger", files).parquet(source)


def _folder(t: Tables, name: str) -> str:
    return f"{shared_dir(t.spark)}/{name}-{uuid.uuid4().hex}"


@query(
    "stream_raw",
    "SELECT event_id AS _partition_offset, CAST(ts AS DATE) AS event_date FROM events",
)
def stream_raw(t: Tables) -> DataFrame:
    """Events landed once each, by date."""
    folder = _folder(t, "stream_raw")
    ingest.start_raw(derived.order_changes(_stream(t)), f"{folder}/out", f"{folder}/checkpoint", True).awaitTermination()
    return t.spark.read.parquet(f"{folder}/out").select("_partition_offset", "event_date")


@query("stream_json_sink", "SELECT event_id AS _partition_offset, CAST(ts AS DATE) AS event_date FROM events")
def stream_json_sink(t: Tables) -> DataFrame:
    """The same as rolled JSON objects of at most a hundred records."""
    folder = _folder(t, "stream_json")
    query_ = sinks.start_json_sink(derived.order_changes(_stream(t)), f"{folder}/out", f"{folder}/checkpoint", available_now=True)
    query_.awaitTermination()
    stored = t.spark.read.schema("_partition_offset bigint, event_date date").json(f"{folder}/out")
    return stored.select("_partition_offset", "event_date")


@query("stream_state", feeds._STG_ORDERS)
def stream_state(t: Tables) -> DataFrame:
    """Current state per order, maintained by key and version in a partitioned table."""
    folder = _folder(t, "stream_state")
    table = PartitionedTable(t.spark, f"{folder}/out", ["_key_bucket"], folder)
    ingest.start_state(
        derived.order_changes(_pieces(t, folder)), staging.stg_orders, table, ["order_id"], f"{folder}/checkpoint",
        prepare=lambda df: with_key_bucket(df, ["order_id"], 4), available_now=True,
    ).awaitTermination()
    return feeds._naive(table.read().drop("_key_bucket"))


@query("stream_dedup", f"SELECT truck_id, event_ts FROM ({feeds._TELEMETRY})")
def stream_dedup(t: Tables) -> DataFrame:
    """Valid positions, the newest per truck and instant, from files in no order of time."""
    folder = _folder(t, "stream_dedup")
    table = PartitionedTable(t.spark, f"{folder}/out", ["event_date"], folder)
    changes = derived.telemetry_changes(_pieces(t, folder))
    ingest.start_positions(changes, table, f"{folder}/checkpoint", True).awaitTermination()
    return feeds._naive(ingest.stored_positions(table).select("truck_id", "event_ts"))


@query(
    "stream_hourly_pings",
    with_ctes(["pings", "hourly"], "SELECT truck_id, activity_hour, ping_count, round(avg_speed_kmh, 6) AS avg_speed_kmh FROM hourly"),
)
def stream_hourly_pings(t: Tables) -> DataFrame:
    """Tumbling hours, upserted into a table as they change."""
    folder = _folder(t, "stream_hourly")
    positions = derived.pings(_stream(t)).withColumn("event_ts", F.col("event_ts").cast("timestamp"))
    table = PartitionedTable(t.spark, f"{folder}/out", ["activity_date"], folder)
    ingest.start_upserts(
        ingest.hourly_pings(positions), table, ["truck_id", "activity_hour", "activity_date"], f"{folder}/checkpoint",
        prepare=lambda df: df.withColumn("activity_date", F.to_date("activity_hour")), available_now=True,
    ).awaitTermination()
    found = table.read().drop("activity_date").withColumn("avg_speed_kmh", F.round("avg_speed_kmh", 6))
    return feeds._naive(found)


@query(
    "stream_sliding_counts",
    "SELECT b AS bucket_start, b + INTERVAL 6 HOUR AS bucket_end, event_type, count(*) AS row_count FROM events, "
    "(SELECT unnest([0, 1]) AS k) JOIN LATERAL (SELECT date_trunc('day', ts) + CAST(hour(ts) // 3 AS INT) * INTERVAL 3 HOUR - k * INTERVAL 3 HOUR AS b) ON true GROUP BY 1, 2, 3",
)
def stream_sliding_counts(t: Tables) -> DataFrame:
    """Six-hour windows every three hours."""
    folder = _folder(t, "stream_sliding")
    events = _pieces(t, folder).withColumn("ts", F.col("ts").cast("timestamp"))
    counts = ingest.bucket_counts(events, "ts", "6 hours", "3660 days", "3 hours", ["event_type"])
    table = PartitionedTable(t.spark, f"{folder}/out", ["day"], folder)
    ingest.start_upserts(
        counts, table, ["bucket_start", "event_type", "day"], f"{folder}/checkpoint",
        prepare=lambda df: df.withColumn("day", F.to_date("bucket_start")), available_now=True,
    ).awaitTermination()
    return feeds._naive(table.read().drop("day"))


@query(
    "stream_with_registry",
    with_ctes(
        ["pings", "registry"],
        "SELECT p.truck_id, p.event_ts, g.model, g.capacity_kg FROM pings p LEFT JOIN (SELECT * FROM registry WHERE NOT is_deleted) g USING (truck_id)",
    ),
)
def stream_with_registry(t: Tables) -> DataFrame:
    folder = _folder(t, "stream_registry")
    joined = ingest.with_registry(derived.pings(_stream(t)), derived.registry(t.events))
    writer = joined.select("truck_id", "event_ts", "model", "capacity_kg").writeStream.format("parquet")
    writer = writer.option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    return t.spark.read.parquet(f"{folder}/out")


@query("stream_trips", with_ctes(ctes.TRIPS, "SELECT * FROM trips"))
def stream_trips(t: Tables) -> DataFrame:
    """Completed orders matched to stored positions batch by batch."""
    folder = _folder(t, "stream_trips")
    table = PartitionedTable(t.spark, f"{folder}/out", ["trip_date"], folder)
    ingest.start_trips(
        derived.orders(_pieces(t, folder)), lambda: derived.pings(t.events), table, f"{folder}/checkpoint", available_now=True
    ).awaitTermination()
    return table.read().select(*trip_columns(t))


def trip_columns(t: Tables) -> list[str]:
    return trips.order_trips(derived.orders(t.events).limit(0), derived.pings(t.events).limit(0)).columns


@query(
    "stream_late_refresh",
    "SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1",
)
def stream_late_refresh(t: Tables) -> DataFrame:
    """Events in files of no order of time: each batch recomputes the days it touches."""
    folder = _folder(t, "stream_late")
    table = PartitionedTable(t.spark, f"{folder}/out", ["day"], folder)
    day = F.col("ts").cast("date").alias("day")

    def recompute(days: DataFrame) -> DataFrame:
        return t.events.select(day).join(days, "day", "left_semi").groupBy("day").agg(F.count(F.lit(1)).alias("n"))

    ingest.start_refresh(_pieces(t, folder), lambda b: b.select(day), recompute, table, f"{folder}/checkpoint", True).awaitTermination()
    return table.read().select("day", "n")


def _damaged(feed: DataFrame) -> DataFrame:
    """The feed with every fiftieth row image cut off."""
    broken = F.concat(F.lit('{"id":'), F.col("_partition_offset").cast("string"))
    damaged = F.col("_partition_offset") % 50 == 3
    return feed.withColumn("before", F.when(damaged, broken).otherwise(F.col("before"))).withColumn(
        "after", F.when(damaged, broken).otherwise(F.col("after"))
    )


class _Failing(Lakehouse):
    """Dies once after the raw table is written and once after the dead letters."""

    def _stage_orders(self, batch: DataFrame) -> None:
        if not getattr(self, "_died", False):
            self._died = True
            raise RuntimeError("lost")
        super()._stage_orders(batch)


@query(
    "ingest_retry",
    f"WITH {feeds._ORDERS}, good AS (SELECT * FROM changes WHERE event_id % 50 <> 3) "
    "SELECT 'raw' AS layer, event_id AS key, ts_ms FROM changes "
    "UNION ALL SELECT 'dead', event_id, ts_ms FROM changes WHERE event_id % 50 = 3 "
    "UNION ALL SELECT 'staged', CAST(order_id AS BIGINT), max(ts_ms) FROM good GROUP BY order_id",
)
def ingest_retry(t: Tables) -> DataFrame:
    """Feeds ingested in two parts, the first staging step failing: raw, staged and dead letters are whole."""
    feed = _damaged(derived.order_changes(t.events))
    lake = _Failing(t.spark, _folder(t, "ingest_retry"), key_buckets=4)
    lake.ingest({"orders": feed.limit(0)})
    try:
        lake.ingest({"orders": feed.where(F.col("_partition_id") == 0)})
    except RuntimeError:
        pass
    for _ in range(2):
        lake.ingest({"orders": feed})
    layers = [("raw", lake.raw["orders"], "_partition_offset"), ("dead", lake.dead_letters, "_partition_offset"), ("staged", lake.stg_orders, "order_id")]
    rows = [table.read().select(F.lit(name).alias("layer"), F.col(key).cast("long").alias("key"), "ts_ms") for name, table, key in layers]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query(
    "stream_dead_letters",
    "SELECT event_id AS _partition_offset, event_id % 50 <> 3 AS good FROM events",
)
def stream_dead_letters(t: Tables) -> DataFrame:
    """Unparseable envelopes go to a side table, the stream carries on."""
    folder = _folder(t, "stream_dead")
    feed = _damaged(derived.order_changes(_pieces(t, folder)))
    sinks.start_tolerant_sink(
        feed, schemas.ORDER_PAYLOAD, f"{folder}/good", f"{folder}/bad", f"{folder}/checkpoint"
    ).awaitTermination()
    good = t.spark.read.parquet(f"{folder}/good").select("_partition_offset", F.lit(True).alias("good"))
    bad = t.spark.read.parquet(f"{folder}/bad").select("_partition_offset", F.lit(False).alias("good"))
    return good.unionByName(bad)


def _delayed_pieces(t: Tables, folder: str, pieces: int = 5) -> tuple[str, int, float]:
    """The events as one folder read in pieces: slices of time, half of each delayed to the next piece.

    Also gives the files of a piece and a slice's length in hours. Pieces with fewer files than that are read
    together with the next one's, which the bound of two slices allows.
    """
    source = f"{folder}/delayed"
    ends = t.events.agg(F.min("ts").cast("timestamp").cast("double").alias("a"), F.max("ts").cast("timestamp").cast("double").alias("b")).first()
    start, length = ends["a"] or 0.0, max(((ends["b"] or 0.0) - (ends["a"] or 0.0)) / (pieces - 1), 1.0)
    slice_ = F.floor((F.col("ts").cast("timestamp").cast("double") - start) / length)
    piece = slice_ + F.pmod(F.xxhash64("event_id"), F.lit(2))
    files = _files_a_piece(t, pieces)
    for n in range(pieces + 1):
        # A stream reads files by their time.
        t.events.where(piece == n).repartition(files, "event_id").write.mode("append").parquet(source)
    return source, files, length / 3600


@query("stream_trips_stateful", with_ctes(ctes.TRIPS, "SELECT * FROM trips"))
def stream_trips_stateful(t: Tables) -> DataFrame:
    """Orders and positions from files in wrong order, matched from the state of each truck alone."""
    folder = _folder(t, "stream_stateful")
    table = PartitionedTable(t.spark, f"{folder}/out", ["trip_date"], folder)
    source, files, hours = _delayed_pieces(t, folder)
    stream = t.spark.readStream.schema(t.events.schema).option("maxFilesPerTrigger", files).parquet(source)
    stateful.start_trips_stateful(
        derived.orders(stream), derived.pings(stream), table, f"{folder}/checkpoint",
        f"{int(2 * hours) + 3} hours", available_now=True, state_partitions=4,
    ).awaitTermination()
    return table.read().select(*trip_columns(t))
