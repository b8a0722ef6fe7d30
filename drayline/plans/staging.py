"""Raw landing and staging models of the change feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from drayline import schemas
from drayline.functions import epoch_ms_to_timestamp
from drayline.operators import incremental
from drayline.operators.latest import latest_per_key
from drayline.sources import cdc

# Valid truck states and the bounding box of the service area.
TRUCK_STATES = ("available", "in_transit", "maintenance")
LATITUDE_RANGE = (-26.0, -25.2)
LONGITUDE_RANGE = (-49.5, -49.1)

_VERSION = ["ts_ms", "_partition_offset"]

# Only the fields a model uses are parsed out of the row images.
_ORDER_FIELDS = schemas.pick(
    schemas.ORDER_PAYLOAD,
    ["id", "truck_id", "status", "pickup_address", "delivery_address", "dispatched_at", "collected_at", "delivered_at"],
)
_TELEMETRY_FIELDS = schemas.pick(
    schemas.TELEMETRY_PAYLOAD, ["truck_id", "latitude", "longitude", "speed_kmh", "fuel_level", "timestamp"]
)


def raw_changes(source: DataFrame, stored: DataFrame | None = None, append_only: bool = False) -> DataFrame:
    """New events of a feed: those past the stored offset of their partition."""
    columns = [f.name for f in cdc.envelope_schema(append_only).fields]
    return incremental.after_offsets(source.select(*columns), stored)


def _fresh(raw: DataFrame, target: DataFrame | None) -> DataFrame:
    return incremental.after_watermark(raw, target, "ts_ms")


def malformed(raw: DataFrame, feed: str) -> DataFrame:
    """Events of a feed whose row image cannot be read, with the offending text."""
    payload = {"orders": _ORDER_FIELDS, "trucks": schemas.TRUCK_PAYLOAD, "truck_telemetry": _TELEMETRY_FIELDS}[feed]
    append_only = feed == "truck_telemetry"
    rows = cdc.keep_operations(raw) if append_only else raw
    letters = cdc.dead_letters(cdc.decode(rows, payload, has_before=not append_only))
    return letters.select(F.lit(feed).alias("feed"), "*")


def stg_orders(raw: DataFrame, target: DataFrame | None = None, keep_offset: bool = False) -> DataFrame:
    """Latest state per order; deleted orders stay, flagged.

    With ``target`` given, only events newer than it are read. Events whose
    image cannot be read are left out (see :func:`malformed`). ``keep_offset``
    keeps the stream offset, which orders events of one millisecond.
    """
    decoded = cdc.well_formed(cdc.decode(_fresh(raw, target), _ORDER_FIELDS))
    typed = decoded.select(
        F.col("row.id").alias("order_id"),
        "row.truck_id",
        "row.status",
        "row.pickup_address",
        "row.delivery_address",
        epoch_ms_to_timestamp("row.dispatched_at").alias("dispatched_at"),
        epoch_ms_to_timestamp("row.collected_at").alias("collected_at"),
        epoch_ms_to_timestamp("row.delivered_at").alias("delivered_at"),
        "ts_ms",
        "is_deleted",
        "_partition_offset",
    )
    latest = latest_per_key(typed, ["order_id"], _VERSION)
    return latest if keep_offset else latest.drop("_partition_offset")


def stg_trucks(raw: DataFrame, target: DataFrame | None = None, keep_offset: bool = False) -> DataFrame:
    """Latest state per truck with a normalized status and a validity flag; the rest as for orders."""
    decoded = cdc.well_formed(cdc.decode(_fresh(raw, target), schemas.TRUCK_PAYLOAD))
    typed = decoded.select(
        F.col("row.id").alias("truck_id"),
        "row.model",
        "row.capacity_kg",
        F.lower(F.trim("row.status")).alias("status"),
        "ts_ms",
        "is_deleted",
        "_partition_offset",
    )
    latest = latest_per_key(typed, ["truck_id"], _VERSION)
    return latest.select(
        "truck_id",
        "model",
        "capacity_kg",
        "status",
        F.coalesce(F.col("status").isin(*TRUCK_STATES), F.lit(False)).alias("is_valid_status"),
        "ts_ms",
        "is_deleted",
        *(["_partition_offset"] if keep_offset else []),
    )


def latest_positions(raw: DataFrame) -> DataFrame:
    """The newest event of each truck and instant, valid or not, with its stream offset."""
    inserts = cdc.keep_operations(raw)
    decoded = cdc.well_formed(cdc.decode(inserts, _TELEMETRY_FIELDS, has_before=False))
    typed = decoded.select(
        "row.truck_id",
        "row.latitude",
        "row.longitude",
        "row.speed_kmh",
        "row.fuel_level",
        epoch_ms_to_timestamp("row.timestamp").alias("event_ts"),
        "ts_ms",
        "_partition_offset",
    )
    return latest_per_key(typed, ["truck_id", "event_ts"], ["_partition_offset"])


def valid_positions(positions: DataFrame) -> DataFrame:
    """Positions inside the service area with a sensible speed."""
    return positions.where(
        F.col("latitude").between(*LATITUDE_RANGE)
        & F.col("longitude").between(*LONGITUDE_RANGE)
        & (F.col("speed_kmh") >= 0)
    )


def stg_telemetry(raw: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """Valid positions, one per truck and instant.

    The newest event of an instant decides; if it is invalid the instant is
    dropped. With ``target`` given, instants already stored are left out too.
    """
    valid = valid_positions(latest_positions(_fresh(raw, target))).drop("_partition_offset")
    return incremental.append_absent(target, valid, ["truck_id", "event_ts"], range_col="event_ts")
