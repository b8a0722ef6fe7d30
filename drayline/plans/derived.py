"""Fleet feeds derived from an event table.

The engine needs orders, positions and change events. Where only a generic
event table (``event_id, ts, user_id, event_type, value``) is at hand, these
views turn every one of its rows into a position and every purchase into an
order, by arithmetic on the id. All of it is column expressions over the whole
table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The service districts and the fleet.
DISTRICTS = [
    "Central Warehouse (CIC)",
    "Batel District",
    "Santa Felicidade",
    "Botanical Garden",
    "Portao Area",
    "Civic Center",
]
FLEET_SIZE = 50


def _minutes(amount: Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), amount.cast("int"), F.lit(0).cast("decimal(18,6)"))


def _district(index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(d) for d in DISTRICTS]), index.cast("int") + 1)


def _position(ids: Column) -> tuple[Column, Column]:
    latitude = F.lit(-26.0) + (ids * 7919 % 1000).cast("double") * F.lit(0.0008)
    longitude = F.lit(-49.5) + (ids * 104729 % 1000).cast("double") * F.lit(0.0004)
    return latitude, longitude


def pings(events: DataFrame) -> DataFrame:
    """One position per event."""
    latitude, longitude = _position(F.col("event_id"))
    return events.select(
        (F.col("user_id") % FLEET_SIZE).alias("truck_id"),
        F.col("ts").alias("event_ts"),
        latitude.alias("latitude"),
        longitude.alias("longitude"),
        F.col("value").alias("speed_kmh"),
    )


def orders(events: DataFrame) -> DataFrame:
    """One delivered order per purchase."""
    ids = F.col("event_id")
    collected = F.col("ts") + _minutes(1 + ids * 37 % 8)
    loaded = 1 + ids * 53 % 17 + F.when(ids % 29 == 0, 120).otherwise(0)
    pickup = ids * 13 % 6
    return events.where(F.col("event_type") == "purchase").select(
        ids.alias("order_id"),
        (F.col("user_id") % FLEET_SIZE).alias("truck_id"),
        F.lit("delivered").alias("status"),
        _district(pickup).alias("pickup_address"),
        _district((pickup + 1 + ids * 17 % 5) % 6).alias("delivery_address"),
        F.col("ts").alias("dispatched_at"),
        collected.alias("collected_at"),
        (collected + _minutes(loaded)).alias("delivered_at"),
        (ids % 97 == 0).alias("is_deleted"),
    )


def trucks() -> list[tuple[int, str, int]]:
    """Registry rows: (truck, model, capacity)."""
    # The models and capacities of the fleet.
    models = [("Volvo FH", 25000), ("Scania R", 20000), ("Mercedes", 22000), ("VW Const", 15000), ("Iveco Hi", 24000)]
    return [(i, *models[i % 5]) for i in range(FLEET_SIZE)]


def registry(events: DataFrame) -> DataFrame:
    """Trucks seen in the events; every eleventh is deleted."""
    seen = events.select((F.col("user_id") % FLEET_SIZE).alias("truck_id")).distinct()
    names = F.array(*[F.lit(m) for _, m, _ in trucks()[:5]])
    loads = F.array(*[F.lit(c) for _, _, c in trucks()[:5]])
    slot = (F.col("truck_id") % 5).cast("int") + 1
    return seen.select(
        "truck_id",
        F.element_at(names, slot).alias("model"),
        F.element_at(loads, slot).alias("capacity_kg"),
        F.lit("available").alias("status"),
        (F.col("truck_id") % 11 == 10).alias("is_deleted"),
    )


# --- change feeds --------------------------------------------------------------------

_OPS = {"signup": "c", "view": "r", "click": "u", "purchase": "u", "error": "d"}


def _op() -> Column:
    op = F.lit(None).cast("string")
    for kind, code in _OPS.items():
        op = F.when(F.col("event_type") == kind, code).otherwise(op)
    return op


def _millis(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def _envelope(events: DataFrame, image: Column, with_before: bool = True) -> DataFrame:
    op = _op()
    columns = [op.alias("op"), _millis(F.col("ts")).alias("ts_ms")]
    if with_before:
        columns += [F.when(op == "d", image).alias("before"), F.when(op != "d", image).alias("after")]
    else:
        columns.append(image.alias("after"))
    return events.select(
        *columns,
        (F.col("user_id") % 3).cast("int").alias("_partition_id"),
        F.col("event_id").alias("_partition_offset"),
    )


def order_changes(events: DataFrame) -> DataFrame:
    """Order events, key ``user_id``: errors delete, everything else writes."""
    ids = F.col("event_id")
    created = _millis(F.col("ts"))
    image = F.format_string(
        '{"id":%d,"truck_id":"TRK-%d","status":"%s","pickup_address":"%s","delivery_address":"%s",'
        '"dispatched_at":%d,"collected_at":%d,"delivered_at":%s}',
        F.col("user_id"),
        F.col("user_id") % FLEET_SIZE,
        F.when(ids % 3 == 0, "delivered").otherwise("en_route"),
        _district(ids * 13 % 6),
        _district((ids * 13 % 6 + 1 + ids * 17 % 5) % 6),
        created,
        created + (1 + ids * 37 % 8) * 60000,
        F.when(ids % 3 == 0, (created + 900000).cast("string")).otherwise("null"),
    )
    return _envelope(events, image)


def truck_changes(events: DataFrame) -> DataFrame:
    """Truck events, key ``user_id``, with untidy status texts."""
    ids = F.col("event_id")
    status = F.element_at(
        F.array(F.lit("available"), F.lit(" In_Transit "), F.lit("MAINTENANCE"), F.lit("broken")),
        (ids % 4).cast("int") + 1,
    )
    image = F.format_string(
        '{"id":"TRK-%d","model":"M%d","capacity_kg":%d,"status":"%s"}',
        F.col("user_id"), ids % 5, 10000 + ids % 7 * 1000, status,
    )
    return _envelope(events, image)


def telemetry_changes(events: DataFrame) -> DataFrame:
    """Position events, some outside the service area or with a negative speed."""
    ids = F.col("event_id")
    latitude, longitude = _position(ids)
    # Positions as decimal text, the way a feed carries them.
    lat_text = F.format_string("%.4f", F.when(ids % 31 == 0, F.lit(10.0)).otherwise(latitude))
    lon_text = F.format_string("%.4f", longitude)
    speed = F.when(ids % 37 == 0, -(ids % 80)).otherwise(ids % 80)
    # Whole hours make several events of a truck share an instant.
    hour = F.floor(_millis(F.col("ts")) / 3600000) * 3600000
    image = F.format_string(
        '{"id":%d,"truck_id":"TRK-%d","latitude":%s,"longitude":%s,"speed_kmh":%d,"timestamp":%d}',
        ids, F.col("user_id") % FLEET_SIZE, lat_text, lon_text, speed, hour,
    )
    return _envelope(events, image, with_before=False)
