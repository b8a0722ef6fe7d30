"""Change feeds as streams.

Positions are kept by the query's checkpoint, which has to live in a folder
all executors share. State tables are updated in ``foreachBatch``; every
update is a merge by key and version, so a batch that is run again changes
nothing.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from drayline import schemas
from drayline.functions import epoch_ms_to_timestamp
from drayline.plans import staging, trips
from drayline.session import RunFolder
from drayline.sources import cdc
from drayline.sources.sinks import dated
from drayline.sources.tables import PartitionedTable

# Fixed value: how often the feeds are polled.
INGEST_INTERVAL = "5 minutes"


def _trigger(writer, available_now: bool, interval: str = INGEST_INTERVAL):
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)


def start_raw(changes: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Land a feed as Parquet by event date, each event once."""
    writer = (
        dated(changes)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy("event_date")
    )
    return _trigger(writer, available_now).start()


def start_state(
    changes: DataFrame,
    model: Callable[[DataFrame], DataFrame],
    table: PartitionedTable,
    keys: list[str],
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    available_now: bool = False,
    versions: tuple[str, ...] = ("ts_ms",),
) -> StreamingQuery:
    """Maintain the current state per key of a feed.

    ``model`` reduces a batch to its latest row per key (e.g. ``stg_orders``);
    ``prepare`` adds partition columns. A batch rewrites only the partitions it
    touches, and is computed once.
    """

    def update(batch: DataFrame, _batch_id: int) -> None:
        latest = model(batch)
        table.merge(prepare(latest) if prepare else latest, keys, versions=list(versions))

    writer = changes.writeStream.foreachBatch(update).option("checkpointLocation", checkpoint)
    return _trigger(writer, available_now).start()


def start_positions(changes: DataFrame, table: PartitionedTable, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Keep the newest event of each truck and instant, however late it comes.

    ``table`` is partitioned by ``event_date``. It holds invalid positions too,
    because a newer valid one may follow or an older valid one precede;
    :func:`stored_positions` gives the rows of the batch model.
    """

    def prepare(latest: DataFrame) -> DataFrame:
        return latest.withColumn("event_date", F.to_date("event_ts"))

    return start_state(
        changes, staging.latest_positions, table, ["truck_id", "event_ts", "event_date"], checkpoint, prepare,
        available_now, ("_partition_offset",),
    )


def stored_positions(table: PartitionedTable) -> DataFrame:
    """Valid positions of a table kept by :func:`start_positions`."""
    return staging.valid_positions(table.read()).drop("_partition_offset", "event_date")


def start_late_log(stream: DataFrame, event_time: str, lateness: str, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Store the rows that a watermark of ``lateness`` on this stream leaves behind, by batch.

    A row is late if its time lies more than ``lateness`` before the latest
    time of all earlier batches. Each batch owns two folders below ``path`` and
    replaces them when it is run again.
    """

    def log(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            mark = None
            if batch_id:
                marks = spark.read.schema("top timestamp, batch_id bigint").parquet(f"{path}/marks")
                mark = marks.where(F.col("batch_id") < batch_id).agg(F.unix_micros(F.max("top") - F.expr(f"interval {lateness}"))).first()[0]
            at = F.col(event_time).cast("timestamp")
            late = batch.where(at < F.timestamp_micros(F.lit(mark))) if mark is not None else batch.limit(0)
            late.write.mode("overwrite").parquet(f"{path}/rows/batch_id={batch_id}")
            batch.agg(F.max(at).alias("top")).write.mode("overwrite").parquet(f"{path}/marks/batch_id={batch_id}")
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(log).option("checkpointLocation", checkpoint)
    return _trigger(writer, available_now).start()


def telemetry(changes: DataFrame, lateness: str = "2 hours") -> DataFrame:
    """Valid positions as a stream, the first valid one per truck and instant within the lateness bound.

    For windows that are emitted once. Rows behind the watermark are left out
    (:func:`start_late_log` stores them), and a later event of an instant does
    not replace an earlier one; :func:`start_positions` has neither limit.
    """
    inserts = cdc.keep_operations(changes)
    decoded = cdc.decode(inserts, schemas.TELEMETRY_PAYLOAD, has_before=False)
    typed = decoded.select(
        "row.truck_id", "row.latitude", "row.longitude", "row.speed_kmh", "row.fuel_level",
        epoch_ms_to_timestamp("row.timestamp").alias("event_ts"), "ts_ms",
    )
    return dedup(
        typed.where(
            F.col("latitude").between(*staging.LATITUDE_RANGE)
            & F.col("longitude").between(*staging.LONGITUDE_RANGE)
            & (F.col("speed_kmh") >= 0)
        ),
        "event_ts",
        ["truck_id", "event_ts"],
        lateness,
    )


def dedup(stream: DataFrame, event_time: str, keys: list[str], lateness: str) -> DataFrame:
    """First event per key; state is dropped once the watermark passes."""
    return stream.withWatermark(event_time, lateness).dropDuplicatesWithinWatermark(keys)


def hourly_pings(positions: DataFrame, lateness: str | None = "2 hours") -> DataFrame:
    """Pings and mean speed per truck and hour, emitted when the hour can no longer change.

    Pass ``lateness=None`` if the stream already carries a watermark.
    """
    if lateness is not None:
        positions = positions.withWatermark("event_ts", lateness)
    return (
        positions.groupBy(F.window("event_ts", "1 hour").alias("hour"), "truck_id")
        .agg(F.count(F.lit(1)).alias("ping_count"), F.avg("speed_kmh").alias("avg_speed_kmh"))
        .select("truck_id", F.col("hour.start").alias("activity_hour"), "ping_count", "avg_speed_kmh")
    )


def bucket_counts(
    stream: DataFrame, event_time: str, width: str, lateness: str, slide: str | None = None,
    group_by: list[str] | None = None,
) -> DataFrame:
    """Rows per tumbling (or, with ``slide``, sliding) time bucket."""
    window = F.window(event_time, width, slide) if slide else F.window(event_time, width)
    return (
        stream.withWatermark(event_time, lateness)
        .groupBy(window.alias("w"), *(group_by or []))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.col("w.start").alias("bucket_start"), F.col("w.end").alias("bucket_end"), *(group_by or []), "row_count")
    )


def start_upserts(
    aggregate: DataFrame,
    table: PartitionedTable,
    keys: list[str],
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Keep a table of a windowed aggregate up to date: rows that changed replace those of equal key."""

    def upsert(batch: DataFrame, _batch_id: int) -> None:
        table.merge(prepare(batch) if prepare else batch, keys)

    writer = aggregate.writeStream.outputMode("update").foreachBatch(upsert).option("checkpointLocation", checkpoint)
    return _trigger(writer, available_now).start()


def with_registry(positions: DataFrame, trucks: DataFrame) -> DataFrame:
    """Positions joined to the truck registry as it stands when a batch runs."""
    registry = trucks.where(~F.col("is_deleted")).select("truck_id", "model", "capacity_kg")
    return positions.join(registry, "truck_id", "left")


def start_refresh(
    stream: DataFrame,
    date_of: Callable[[DataFrame], DataFrame],
    recompute: Callable[[DataFrame], DataFrame],
    table: PartitionedTable,
    checkpoint: str,
    available_now: bool = False,
) -> StreamingQuery:
    """Recompute the days a batch touches, however late its rows are.

    ``date_of`` maps a batch to one column of dates, ``recompute`` builds the
    table's rows for a DataFrame of dates (in that column). Serves data later
    than any watermark.
    """

    def refresh(batch: DataFrame, _batch_id: int) -> None:
        run = RunFolder(batch.sparkSession, "days", table.staging_fallback or f"{table.path}.staging")
        try:
            found = date_of(batch)
            days = run.keep(found.where(F.col(found.columns[0]).isNotNull()).distinct(), "days")
            if not days.isEmpty():
                rows = recompute(days)
                if table.read() is not None:
                    table.replace_partitions(rows)
                else:
                    table.overwrite(rows)
        finally:
            run.close()

    writer = stream.writeStream.foreachBatch(refresh).option("checkpointLocation", checkpoint)
    return _trigger(writer, available_now).start()


def start_trips(
    staged_orders: DataFrame,
    positions: Callable[[], DataFrame],
    table: PartitionedTable,
    checkpoint: str,
    available_now: bool = False,
) -> StreamingQuery:
    """Match newly completed orders to stored positions, batch by batch.

    An order is matched when it completes; :func:`start_trip_revision` corrects
    trips for which positions arrive later.
    """

    def match(batch: DataFrame, _batch_id: int) -> None:
        batch.persist()
        try:
            near = trips.positions_for(
                trips.completed_orders(batch), positions().select("truck_id", "event_ts", "latitude", "longitude")
            )
            table.merge(trips.order_trips(batch, near), ["order_id"], keys_may_move=True)
        finally:
            batch.unpersist()

    writer = staged_orders.writeStream.foreachBatch(match).option("checkpointLocation", checkpoint)
    return _trigger(writer, available_now).start()


def start_trip_revision(
    positions_stream: DataFrame,
    orders: Callable[[], DataFrame],
    positions: Callable[[], DataFrame],
    table: PartitionedTable,
    checkpoint: str,
    available_now: bool = False,
) -> StreamingQuery:
    """Correct stored trips for positions that arrive after them.

    ``positions`` gives the stored positions, the batch's own included. Only
    trucks whose new positions reach back to a stored trip or an earlier position
    are matched again (none where positions come in order of time), and only trips that change are written.
    """

    def revise(batch: DataFrame, _batch_id: int) -> None:
        stored = table.read()
        if stored is None:
            return
        here = ["truck_id", "event_ts"]
        late = trips.late_trucks(batch, stored, positions().join(batch.select(*here), here, "left_anti"))
        if not late.isEmpty():
            table.merge(trips.revised_trips(orders(), positions(), stored, late), ["order_id"], keys_may_move=True)

    writer = positions_stream.writeStream.foreachBatch(revise).option("checkpointLocation", checkpoint)
    return _trigger(writer, available_now).start()
