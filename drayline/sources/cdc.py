"""Change feeds: reading envelopes, decoding row images, deriving a feed from snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from drayline import schemas
from drayline.operators.latest import latest_per_key

CORRUPT = "_corrupt_record"


def envelope_schema(append_only: bool = False) -> T.StructType:
    base = schemas.ENVELOPE_APPEND_ONLY if append_only else schemas.ENVELOPE
    return T.StructType([*base.fields, *schemas.POSITION.fields])


def read_topic(
    spark: SparkSession,
    topic: str,
    servers: str,
    append_only: bool = False,
    streaming: bool = True,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """A change topic as typed envelope rows with their stream position.

    Needs the Kafka connector package on the session's classpath.
    """
    reader = spark.readStream if streaming else spark.read
    raw = (
        reader.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .options(**(options or {}))
        .load()
    )
    return parse_messages(raw, append_only)


def parse_messages(raw: DataFrame, append_only: bool = False) -> DataFrame:
    """Envelope columns from message rows (``value``, ``partition``, ``offset``)."""
    payload = schemas.ENVELOPE_APPEND_ONLY if append_only else schemas.ENVELOPE
    value = F.from_json(F.col("value").cast("string"), payload).alias("e")
    return raw.select(
        value,
        F.col("partition").cast("int").alias("_partition_id"),
        F.col("offset").cast("bigint").alias("_partition_offset"),
    ).select("e.*", "_partition_id", "_partition_offset")


def replay_files(
    spark: SparkSession, path: str, append_only: bool = False, streaming: bool = True,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """The same rows from JSON files, one envelope per line."""
    schema = envelope_schema(append_only)
    if not streaming:
        return spark.read.schema(schema).json(path)
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path)


def row_image(has_before: bool = True) -> Column:
    """JSON of the row: the image before a delete, the one after anything else."""
    if not has_before:
        return F.col("after")
    return F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))


def decode(changes: DataFrame, payload: T.StructType, has_before: bool = True) -> DataFrame:
    """Parse the row image once into a typed struct ``row`` and flag deletions.

    ``is_malformed`` marks images that are not valid JSON for the payload.
    """
    fields = T.StructType([*payload.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(
        row_image(has_before), fields, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )
    return (
        changes.withColumn("row", parsed)
        .withColumn("is_deleted", F.col("op").eqNullSafe("d"))
        .withColumn("is_malformed", F.col(f"row.{CORRUPT}").isNotNull())
    )


def dead_letters(decoded: DataFrame) -> DataFrame:
    """Envelopes whose image could not be parsed, with the offending text."""
    return decoded.where("is_malformed").select(
        "op", "ts_ms", F.col(f"row.{CORRUPT}").alias("bad_record"), "_partition_id", "_partition_offset"
    )


def well_formed(decoded: DataFrame) -> DataFrame:
    return decoded.where(~F.col("is_malformed")).drop("is_malformed")


def keep_operations(changes: DataFrame, operations: tuple[str, ...] = ("c", "r")) -> DataFrame:
    return changes.where(F.col("op").isin(*operations))


def latest_change(decoded: DataFrame, key: str) -> DataFrame:
    """Last event per key, by time and then by position in the stream."""
    return latest_per_key(decoded, [key], ["ts_ms", "_partition_offset"])


def snapshot_diff(
    old: DataFrame | None, new: DataFrame, keys: list[str], ts_ms: Column | int
) -> DataFrame:
    """Change rows that lead from one snapshot of a table to the next.

    Without an earlier snapshot every row is a read (``r``); otherwise rows are
    created, updated or deleted (``c``, ``u``, ``d``) and unchanged rows give
    no event.
    """
    stamp = ts_ms if isinstance(ts_ms, Column) else F.lit(ts_ms).cast("bigint")
    image = F.to_json(F.struct(*new.columns))
    none = F.lit(None).cast("string")
    if old is None:
        return new.select(F.lit("r").alias("op"), stamp.alias("ts_ms"), none.alias("before"), image.alias("after"))
    before = old.select(*keys, F.struct(*new.columns).alias("_before"))
    after = new.select(*keys, F.struct(*new.columns).alias("_after"))
    both = before.join(after, keys, "full_outer")
    op = (
        F.when(F.col("_before").isNull(), "c")
        .when(F.col("_after").isNull(), "d")
        .when(~F.col("_before").eqNullSafe(F.col("_after")), "u")
    )
    return (
        both.withColumn("op", op)
        .where(F.col("op").isNotNull())
        .select(
            "op",
            stamp.alias("ts_ms"),
            F.to_json("_before").alias("before"),
            F.to_json("_after").alias("after"),
        )
    )
