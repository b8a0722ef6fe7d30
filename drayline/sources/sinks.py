"""Sinks for change feeds: rolled JSON objects and dead letters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from drayline.sources import cdc


@dataclass(frozen=True)
class Roll:
    """When a sink closes its current object."""

    records: int
    interval: str


# Roll sizes of the two feeds.
CDC_ROLL = Roll(100, "5 minutes")
TELEMETRY_ROLL = Roll(500, "1 minute")


def dated(changes: DataFrame) -> DataFrame:
    """Add the date of the event time carried in ``ts_ms``."""
    return changes.withColumn("event_date", F.to_date(F.timestamp_millis("ts_ms")))


def start_json_sink(
    changes: DataFrame,
    path: str,
    checkpoint: str,
    roll: Roll = CDC_ROLL,
    partition_by: tuple[str, ...] = ("event_date", "_partition_id"),
    available_now: bool = False,
) -> StreamingQuery:
    """Stream a feed into JSON files of at most ``roll.records`` rows."""
    writer = (
        dated(changes)
        .writeStream.format("json")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .option("maxRecordsPerFile", roll.records)
        .partitionBy(*partition_by)
    )
    trigger = {"availableNow": True} if available_now else {"processingTime": roll.interval}
    return writer.trigger(**trigger).start()


def write_json(changes: DataFrame, path: str, roll: Roll = CDC_ROLL, mode: str = "append") -> None:
    """Batch form of the rolled JSON sink."""
    (
        dated(changes)
        .write.mode(mode)
        .option("maxRecordsPerFile", roll.records)
        .partitionBy("event_date", "_partition_id")
        .json(path)
    )


def split_dead_letters(changes: DataFrame, payload, has_before: bool = True) -> tuple[DataFrame, DataFrame]:
    """(good, bad): decoded rows and the envelopes that could not be parsed."""
    decoded = cdc.decode(changes, payload, has_before)
    return cdc.well_formed(decoded), cdc.dead_letters(decoded)


def start_tolerant_sink(
    changes: DataFrame, payload, good_path: str, bad_path: str, checkpoint: str, has_before: bool = True
) -> StreamingQuery:
    """Stream parsed rows to one table and unparseable ones to another; never fails on bad input."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # read once for both outputs
        try:
            good, bad = split_dead_letters(batch, payload, has_before)
            # Overwriting the batch's own folder makes a repeated batch harmless.
            good.write.mode("overwrite").parquet(f"{good_path}/batch_id={batch_id}")
            bad.write.mode("overwrite").parquet(f"{bad_path}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return (
        changes.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
