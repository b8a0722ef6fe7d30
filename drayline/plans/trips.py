"""Trips: orders matched to vehicle positions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from drayline.functions import great_circle_distance, minutes_between, round_to
from drayline.operators.asof import Probe, asof_lookup, bounded_by_batch
from drayline.operators.chunking import ROWS_PER_CHUNK

# Longest trip kept (minutes), and the slack after the last delivery.
MAX_TRIP_MINUTES = 120
LATE_PING_BUFFER = "2 hours"

PROBES = [
    Probe("dispatch", "dispatched_at", "backward", inclusive=False),
    Probe("pickup", "collected_at", "forward", inclusive=True),
    Probe("delivery", "delivered_at", "backward", inclusive=True),
]


def completed_orders(orders: DataFrame) -> DataFrame:
    """Orders with all three times that were delivered or have since been deleted."""
    return orders.where(
        F.col("dispatched_at").isNotNull()
        & F.col("collected_at").isNotNull()
        & F.col("delivered_at").isNotNull()
        & ((F.col("status") == "delivered") | F.col("is_deleted"))
    )


def unmatched(done: DataFrame, target: DataFrame) -> DataFrame:
    """Completed orders that the stored trips lack or hold in another version, whenever they were delivered."""
    version = ["order_id", "truck_id", "dispatched_at", "collected_at", "delivered_at", "is_deleted"]
    stored = target.select(*[F.col(c).alias(f"_s_{c}") for c in version])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in version])
    return done.join(stored, (F.col("order_id") == F.col("_s_order_id")) & same, "left_anti")


def positions_for(done: DataFrame, pings: DataFrame, lookback: str = "1 day") -> DataFrame:
    """The positions that can answer the probes of some orders: the same answers as all positions give.

    These are the positions of the orders' time window, widened by ``lookback``,
    and for trucks that are silent in it the last position before the window and
    the first one after it. Only where such trucks exist is anything else read,
    and of that one row a truck.
    """
    inside = bounded_by_batch(pings, done, "event_ts", "dispatched_at", "delivered_at", LATE_PING_BUFFER, lookback)
    needs = done.groupBy("truck_id").agg(F.min("dispatched_at").alias("_from"), F.max("collected_at").alias("_to"))
    seen = inside.join(needs.select("truck_id"), "truck_id", "left_semi").groupBy("truck_id").agg(
        F.min("event_ts").alias("_lo"), F.max("event_ts").alias("_hi")
    )
    cover = needs.join(seen, "truck_id", "left")
    span = done.agg(F.min("dispatched_at").alias("low"), F.max("delivered_at").alias("high"))
    low, high = F.col("low") - F.expr(f"interval {lookback}"), F.col("high") + F.expr(f"interval {LATE_PING_BUFFER}")
    edges = span.select(*[F.unix_micros(c.cast("timestamp")).alias(n) for n, c in (("low", low), ("high", high))]).first()
    if edges is None or edges["low"] is None:
        return inside
    kind = pings.schema["event_ts"].dataType
    bound = {n: F.timestamp_micros(F.lit(edges[n])).cast(kind) for n in ("low", "high")}
    sides = [
        (F.col("_lo").isNull() | (F.col("_lo") >= F.col("_from")), F.col("event_ts") < bound["low"], F.max_by),
        (F.col("_hi").isNull() | (F.col("_hi") < F.col("_to")), F.col("event_ts") > bound["high"], F.min_by),
    ]
    row = F.struct(*[c for c in pings.columns if c != "truck_id"])
    for silent, beyond, nearest in sides:
        trucks = cover.where(silent).select("truck_id")
        if not trucks.isEmpty():
            rest = pings.where(beyond).join(trucks, "truck_id", "left_semi")
            found = rest.groupBy("truck_id").agg(nearest(row, F.col("event_ts")).alias("_r")).select("truck_id", "_r.*")
            inside = inside.unionByName(found.select(*pings.columns))
    return inside


def order_trips(
    orders: DataFrame,
    telemetry: DataFrame,
    target: DataFrame | None = None,
    max_minutes: float = MAX_TRIP_MINUTES,
    lookback: str = "1 day",
    rows_per_chunk: int | None = ROWS_PER_CHUNK,
) -> DataFrame:
    """One row per completed trip: where it started, its two legs and their durations.

    With ``target`` given, only orders that it lacks or holds in another version
    are computed, from the positions that can matter to them (see
    :func:`positions_for`); the rows are those of a full run.
    """
    # The cap depends on the order alone: apply it before anything is matched.
    total_minutes = minutes_between("dispatched_at", "delivered_at")
    done = completed_orders(orders).where(total_minutes <= max_minutes)
    pings = telemetry.select("truck_id", "event_ts", "latitude", "longitude")
    if target is not None:
        done = unmatched(done, target)
        pings = positions_for(done, pings, lookback)
    placed = asof_lookup(
        done.select(
            "order_id", "truck_id", "pickup_address", "delivery_address",
            "dispatched_at", "collected_at", "delivered_at", "is_deleted",
        ),
        pings,
        on=["truck_id"],
        right_ts="event_ts",
        values=["latitude", "longitude"],
        probes=PROBES,
        row_id=["order_id"],
        right_unique=True,
        rows_per_chunk=rows_per_chunk,
    )
    return trip_rows(placed)


def trip_rows(placed: DataFrame) -> DataFrame:
    """Distances and durations of orders whose three positions are known."""
    total_minutes = minutes_between("dispatched_at", "delivered_at")
    legs = placed.withColumn(
        "_deadhead",
        great_circle_distance(
            "dispatch_latitude", "dispatch_longitude", "pickup_latitude", "pickup_longitude"
        ),
    ).withColumn(
        "_loaded",
        great_circle_distance(
            "pickup_latitude", "pickup_longitude", "delivery_latitude", "delivery_longitude"
        ),
    )
    total = F.col("_deadhead") + F.col("_loaded")
    return legs.select(
        "order_id",
        "truck_id",
        "pickup_address",
        "delivery_address",
        "dispatched_at",
        "collected_at",
        "delivered_at",
        round_to(F.col("_deadhead"), 3).alias("deadhead_distance_km"),
        round_to(F.col("_loaded"), 3).alias("loaded_distance_km"),
        round_to(total, 3).alias("total_distance_km"),
        minutes_between("dispatched_at", "collected_at").alias("deadhead_duration_min"),
        minutes_between("collected_at", "delivered_at").alias("loaded_duration_min"),
        total_minutes.alias("total_duration_min"),
        F.when(total > 0, round_to(F.col("_deadhead") / total, 4)).alias("deadhead_ratio"),
        F.col("dispatched_at").cast("date").alias("trip_date"),
        "is_deleted",
    )


def late_trucks(positions: DataFrame, stored: DataFrame, earlier: DataFrame, max_minutes: float = MAX_TRIP_MINUTES) -> DataFrame:
    """Trucks whose new positions may answer a probe of a stored trip.

    That is where the first new one precedes a delivery or a position stored
    ``earlier`` (without the new ones), or where a trip may still wait for the
    position of its pickup, the one probe that a later position can answer. Of
    the trips only days from the first new position on are read, and those
    without a position; of earlier positions those no older than the first.
    """
    first = positions.groupBy("truck_id").agg(F.min("event_ts").alias("_first"))
    micros = first.agg(F.unix_micros(F.min("_first").cast("timestamp"))).first()[0]
    if micros is None:
        return first.select("truck_id")
    since = F.timestamp_micros(F.lit(micros)).cast(earlier.schema["event_ts"].dataType)
    # No trip is longer than the cap, so one delivered since then has begun on these days.
    begun = F.to_date(F.timestamp_micros(F.lit(micros - int(max_minutes * 60_000_000))))
    last = stored.where((F.col("trip_date") >= begun) & (F.col("delivered_at") >= since))
    waiting = stored.where(F.col("deadhead_distance_km").isNull() & F.col("loaded_distance_km").isNull())
    known = earlier.where(F.col("event_ts") >= since)
    reached = [
        last.groupBy("truck_id").agg(F.max("delivered_at").alias("_until")),
        known.groupBy("truck_id").agg(F.max("event_ts").alias("_until")),
    ]
    kind = positions.schema["event_ts"].dataType
    until = reduce(DataFrame.unionByName, [r.withColumn("_until", F.col("_until").cast(kind)) for r in reached])
    before = first.join(until, "truck_id").where(F.col("_first") <= F.col("_until")).select("truck_id")
    return before.unionByName(first.join(waiting, "truck_id", "left_semi").select("truck_id")).distinct()


def revised_trips(orders: DataFrame, telemetry: DataFrame, stored: DataFrame, trucks: DataFrame, **options) -> DataFrame:
    """Trips of some trucks that come out differently from how they are stored, all positions considered."""
    trucks = trucks.select("truck_id").distinct()
    again = order_trips(
        orders.join(trucks, "truck_id", "left_semi"), telemetry.join(trucks, "truck_id", "left_semi"), **options
    )
    known = stored.join(trucks, "truck_id", "left_semi").select(*again.columns)
    return again.exceptAll(known)
