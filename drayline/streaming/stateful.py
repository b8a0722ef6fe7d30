"""Trips from two streams with nothing but state between them.

``start_trips`` looks positions up in a stored table. Here each truck keeps its
open orders and recent positions as state, so an order is matched as soon as it
or a position that answers it arrives, without reading any table.

What a truck holds follows from the watermark, not from its history: positions
from the longest trip's length before the watermark on (an order that is still to
come cannot have been dispatched earlier) with the last one before them, and
orders whose delivery lies ahead of the watermark or whose pickup no position has
answered. A timer clears the state of a truck that falls silent. Both lists are
stored as Arrow batches of many rows each, since a state row of its own costs far
more than what it holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from drayline.functions import minutes_between
from drayline.plans import trips
from drayline.sources.tables import PartitionedTable
from drayline.streaming.ingest import INGEST_INTERVAL

_TIMES = ["dispatched_at", "collected_at", "delivered_at"]
_ORDER = ["order_id", "pickup_address", "delivery_address", *_TIMES, "is_deleted"]
_PLACES = [f"{probe.name}_{axis}" for probe in trips.PROBES for axis in ("latitude", "longitude")]
_NONE = -(2**62)  # no position answers the probe
#: Rows of one stored batch of positions or orders.
STORED_ROWS = 1 << 16
_POSITION_TYPES = {"event_ts": pa.int64(), "latitude": pa.float64(), "longitude": pa.float64()}
_ORDER_TYPES = {
    "order_id": None, "pickup_address": pa.string(), "delivery_address": pa.string(), **dict.fromkeys(_TIMES, pa.int64()),
    "is_deleted": pa.bool_(), **{probe.name: pa.int64() for probe in trips.PROBES},
}

# Settings of the streaming query alone; the caller's session has its own back once it has started.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


class PackedRows:
    """A list state whose entries are Arrow batches of up to ``STORED_ROWS`` rows; rows are tuples."""

    def __init__(self, state, types: dict[str, pa.DataType | None]):
        self.state = state
        self.types = types  # ``None``: that of the values

    def get(self) -> Iterator[tuple]:
        for (packed,) in self.state.get():
            with pa.ipc.open_stream(packed) as batches:
                for batch in batches:
                    yield from zip(*[column.to_pylist() for column in batch.columns], strict=True)

    def put(self, rows: list[tuple]) -> None:
        packed = []
        for first in range(0, len(rows), STORED_ROWS):
            columns = zip(*rows[first : first + STORED_ROWS], strict=True)
            arrays = [pa.array(c, kind) for c, kind in zip(columns, self.types.values(), strict=True)]
            batch = pa.RecordBatch.from_arrays(arrays, names=list(self.types))
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema) as writer:
                writer.write_batch(batch)
            packed.append((sink.getvalue().to_pybytes(),))
        self.state.put(packed)

    def clear(self) -> None:
        self.state.clear()


class TripMatcher(StatefulProcessor):
    """Open orders and recent positions of one truck; all instants are microseconds."""

    def __init__(self, id_type: str, slack: int):
        self.id_type = id_type
        self.slack = slack

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.positions = PackedRows(handle.getListState("positions", "packed binary"), _POSITION_TYPES)
        self.orders = PackedRows(handle.getListState("orders", "packed binary"), _ORDER_TYPES)

    def _held(self) -> tuple[dict, dict]:
        places = {at: (latitude, longitude) for at, latitude, longitude in self.positions.get()}
        return places, {o[0]: (o[1:7], o[7:]) for o in self.orders.get()}

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        places, waiting = self._held()
        for chunk in rows:
            here = chunk[~chunk["is_order"]]
            places.update(zip(here["position_at"].tolist(), zip(here["latitude"].tolist(), here["longitude"].tolist())))
            new = chunk.loc[chunk["is_order"], _ORDER].astype(object)
            ids, *values = (new[c].where(new[c].notna(), None).tolist() for c in _ORDER)
            waiting.update(zip(ids, ((order, None) for order in zip(*values))))
        yield from self._advance(key, places, waiting, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._advance(key, *self._held(), timerValues)

    def close(self) -> None:
        pass

    def _advance(self, key, places: dict, waiting: dict, timer_values) -> Iterator[pd.DataFrame]:
        """Answer what is open, tell what has changed and keep what can still matter."""
        now = timer_values.getCurrentWatermarkInMs() * 1000
        times = np.array(sorted(places), dtype=np.int64)
        told, still = [], {}
        dispatched, collected, delivered = np.array([o[2:5] for o, _ in waiting.values()], dtype=np.int64).reshape(-1, 3).T
        # Strictly before dispatch, at or after collection, at or before delivery.
        at = np.stack([
            np.searchsorted(times, dispatched, "left"),
            np.searchsorted(times, collected, "left") + 1,
            np.searchsorted(times, delivered, "right"),
        ])
        answers = np.concatenate([[_NONE], times, [_NONE]])[at].T.tolist()
        for (order_id, (order, before)), found in zip(waiting.items(), map(tuple, answers), strict=True):
            if found != before:
                spots = [places.get(instant, (None, None)) for instant in found]
                told.append((order_id, key[0], *order, *[v for spot in spots for v in spot]))
            if now < order[4] or found[1] == _NONE or found[1] > now:
                still[order_id] = (order, found)
        oldest = min([now - self.slack, *[order[2] for order, _ in still.values()]])
        times = times[max(int(np.searchsorted(times, oldest, "left")) - 1, 0):]
        self._keep(self.positions, [(t, *places[t]) for t in times.tolist()])
        self._keep(self.orders, [(order_id, *order, *found) for order_id, (order, found) in still.items()])
        self._set_timer(now, times, still)
        if told:
            columns = ["order_id", "truck", *_ORDER[1:], *_PLACES]
            yield pd.DataFrame(told, columns=columns).astype({c: "float64" for c in _PLACES})

    @staticmethod
    def _keep(state, rows: list[tuple]) -> None:
        if rows:
            state.put(rows)
        else:
            state.clear()

    def _set_timer(self, now: int, times: np.ndarray, still: dict) -> None:
        """One timer, for when all that is held now can be reduced, if any of it can."""
        ahead = [order[4] for order, _ in still.values() if order[4] > now]
        if len(times) > 1:
            ahead.append(int(times[-1]))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if ahead and max(ahead) + self.slack > now:
            self.handle.registerTimer((max(ahead) + self.slack) // 1000 + 1)


def placed_orders(
    orders: DataFrame, positions: DataFrame, lateness: str = "2 hours", max_minutes: float = trips.MAX_TRIP_MINUTES
) -> DataFrame:
    """Completed orders of a stream with the positions that answer their probes, told again whenever an answer changes.

    Both streams may be out of order by up to ``lateness``, orders by their
    delivery and positions by their time; the watermark is that of the feed that is
    further behind. Rows later than that are left out (``start_late_log`` stores
    them). An order without an id is left out, of several rows of one order the last
    to arrive counts, also once it has been closed; a truck has one position an
    instant, as ``start_positions`` leaves them. An order's times are taken to be in
    sequence. An order without a truck has no places. Between an order and its next
    position there may be any time: it stays open and is told with a null place.
    """
    kinds = {c: orders.schema[c].dataType for c in [*_ORDER, "truck_id"]}
    done = trips.completed_orders(orders).where(
        F.col("order_id").isNotNull() & (minutes_between("dispatched_at", "delivered_at") <= max_minutes)
    )
    empty_place = {"position_at": F.lit(0).cast("long"), "latitude": F.lit(0.0), "longitude": F.lit(0.0)}
    micros = {c: F.unix_micros(F.col(c).cast("timestamp")).alias(c) for c in _TIMES}
    # Keys without nulls, names without leading underscores: both are lost on the way to the processor.
    truck = F.coalesce(F.concat(F.lit("="), F.col("truck_id").cast("string")), F.lit("")).alias("truck")
    left = done.withColumn("row_at", F.col("delivered_at").cast("timestamp")).withWatermark("row_at", lateness).select(
        F.lit(True).alias("is_order"), "row_at", truck, *[micros.get(c, F.col(c)) for c in _ORDER],
        *[v.alias(c) for c, v in empty_place.items()],
    )
    # Whole numbers must not meet nulls on their way through pandas.
    fill = {c: F.lit(0 if isinstance(kinds[c], T.NumericType) else "") for c in _ORDER if c not in _TIMES}
    fill |= {c: F.lit(0).cast("long") for c in _TIMES} | {"is_deleted": F.lit(False)}
    right = positions.where(F.col("event_ts").isNotNull() & F.col("truck_id").isNotNull())
    right = right.withColumn("row_at", F.col("event_ts").cast("timestamp")).withWatermark("row_at", lateness).select(
        F.lit(False).alias("is_order"), "row_at", truck,
        *[fill[c].cast("long" if c in _TIMES else kinds[c]).alias(c) for c in _ORDER],
        F.unix_micros(F.col("event_ts").cast("timestamp")).alias("position_at"),
        F.col("latitude").cast("double").alias("latitude"), F.col("longitude").cast("double").alias("longitude"),
    )
    id_type = kinds["order_id"].simpleString()
    shape = (
        f"order_id {id_type}, truck string, pickup_address string, delivery_address string, dispatched_at long, "
        "collected_at long, delivered_at long, is_deleted boolean, " + ", ".join(f"{c} double" for c in _PLACES)
    )
    # A minute more, because the cap applies to rounded minutes.
    slack = int((max_minutes + 1) * 60_000_000)
    placed = left.unionByName(right).groupBy("truck").transformWithStateInPandas(
        TripMatcher(id_type, slack), outputStructType=shape, outputMode="Update", timeMode="EventTime"
    )
    truck_id = F.when(F.col("truck") != "", F.expr("substring(truck, 2)")).cast(kinds["truck_id"])
    times = {c: F.timestamp_micros(c).cast(kinds[c]) for c in _TIMES}
    return placed.withColumns({"truck_id": truck_id, **times}).drop("truck")


def start_trips_stateful(
    orders: DataFrame,
    positions: DataFrame,
    table: PartitionedTable,
    checkpoint: str,
    lateness: str = "2 hours",
    available_now: bool = False,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Keep a table of trips from a stream of orders and one of positions, without reading either again.

    Trips are merged by order, so a batch that is run again changes nothing. The
    number of state partitions is fixed by a checkpoint's first run.
    """
    spark = orders.sparkSession

    def store(batch: DataFrame, _batch_id: int) -> None:
        table.merge(trips.trip_rows(batch), ["order_id"], keys_may_move=True)

    writer = placed_orders(orders, positions, lateness).writeStream.outputMode("update").foreachBatch(store)
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=INGEST_INTERVAL)
    settings = dict(STATE_STORE)
    if state_partitions:
        settings["spark.sql.shuffle.partitions"] = str(state_partitions)
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        return writer.start()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
