"""The chain of models over stored tables: feeds to staging, staging to marts, marts to checks.

Each step reads what the step before has written. A batch of events is stored
first and removed when raw, staging and dead letters have it, so a failed run is
completed by the next one.

What a step has changed goes to a change log beside its table: staged orders as
rows, everything else as keys and days. The steps after it read the entries
they have not seen and recompute those keys, so a correction of a day long
stored reaches every mart, and a run costs what has changed.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from drayline.functions import epoch_ms_to_timestamp
from drayline.operators import checks, incremental
from drayline.operators.latest import latest_per_key
from drayline.plans import activity, marts, staging, trips
from drayline.schemas import RUN_RESULTS
from drayline.session import RunFolder, remove_folder
from drayline.sources import cdc
from drayline.sources.change_log import ENTRY, ChangeLog, Pending
from drayline.sources.ledger import OffsetLedger
from drayline.sources.tables import PartitionedTable, SnapshotTable, insert_rows, path_exists, with_key_bucket

# The feeds, and below the names of layers and models.
FEEDS = {"orders": False, "trucks": False, "truck_telemetry": True}  # feed -> append-only
KEY_BUCKETS = 256


@dataclass
class Lakehouse:
    """Tables below one base path."""

    spark: SparkSession
    base: str
    key_buckets: int = KEY_BUCKETS

    def _partitioned(self, layer: str, name: str, by: list[str]) -> PartitionedTable:
        return PartitionedTable(self.spark, f"{self.base}/{layer}/{name}", by, f"{self.base}/_staging")

    def __post_init__(self) -> None:
        self.raw = {f: self._partitioned("bronze", f"{f}_raw", ["event_date"]) for f in FEEDS}
        self.ledgers = {f: OffsetLedger(self.spark, f"{self.base}/bronze/{f}_offsets") for f in FEEDS}
        self.stg_orders = self._partitioned("bronze", "stg_orders", ["_key_bucket"])
        self.stg_trucks = SnapshotTable(self.spark, f"{self.base}/bronze/stg_trucks")
        self.stg_telemetry = self._partitioned("bronze", "stg_telemetry", ["event_date"])
        self.order_trips = self._partitioned("silver", "order_trips", ["trip_date"])
        self.truck_activity = self._partitioned("silver", "truck_activity", ["activity_date"])
        self.otd = self._partitioned("gold", "otd", ["trip_date"])
        self.district_heatmap = self._partitioned("gold", "district_heatmap", ["trip_date"])
        self.fleet_utilization = self._partitioned("gold", "fleet_utilization", ["metric_date"])
        self.dead_letters = self._partitioned("bronze", "dead_letters", ["feed"])
        self.late = f"{self.base}/_staging/late_trucks"
        logged = ("stg_orders", "stg_trucks", "stg_telemetry", "order_trips", "truck_activity")
        self.changes = {n: ChangeLog(self.spark, f"{self.base}/_changes/{n}") for n in logged}
        self.run_results = f"{self.base}/observability/run_results"

    # --- feeds to staging -----------------------------------------------------------

    def ingest(self, feeds: dict[str, DataFrame]) -> None:
        """Land new events of the feeds and bring the staging tables up to date.

        A feed's new events are first stored as a batch of their own. The batch
        goes to the raw table, to staging and to the dead letters, its offsets
        go to the feed's ledger, and it is removed last; each of these steps
        can be repeated. Where to go on is read from the ledger alone. A run that fails in
        between leaves the batch, and the next one completes it before it takes
        new events, so nothing that has landed stays unstaged.
        """
        for name in FEEDS:
            self._complete(name)
        for name, source in feeds.items():
            new, marks = staging.raw_changes(source, None, FEEDS[name]), self._marks(name)
            new = new if marks is None else incremental.after_marks(new, marks)
            new.write.mode("overwrite").parquet(self._batch(name))
            self._complete(name)

    def _marks(self, feed: str) -> DataFrame | None:
        """The last landed offsets; a raw table from before the ledger is read for them once."""
        ledger = self.ledgers[feed]
        if not ledger.next_number() > 1 and self.raw[feed].exists():
            ledger.commit(1, self.raw[feed].read())
        return ledger.marks()

    def _not_landed(self, feed: str, batch: DataFrame) -> DataFrame:
        """Events of a dated batch that the raw table lacks; only the days of the batch are read."""
        stored = self.raw[feed].read()
        if stored is None:
            return batch
        place = ["_partition_id", "_partition_offset", "event_date"]
        span = batch.agg(F.min("event_date"), F.max("event_date")).first()
        near = F.col("event_date").isNull()
        if span[0] is not None:
            near = near | F.col("event_date").between(F.lit(span[0]), F.lit(span[1]))
        known = stored.where(near).select(*[F.col(c).alias(f"_s{c}") for c in place])
        same = [F.col(c).eqNullSafe(F.col(f"_s{c}")) for c in place]
        return batch.join(known, same[0] & same[1] & same[2], "left_anti")

    def _batch(self, feed: str) -> str:
        return f"{self.base}/_staging/{feed}-batch"

    def _complete(self, feed: str) -> None:
        """Land and stage the stored batch of a feed, if there is one."""
        path = self._batch(feed)
        if not path_exists(self.spark, f"{path}/_SUCCESS"):
            return
        schema = cdc.envelope_schema(FEEDS[feed])
        batch = self.spark.read.schema(schema).parquet(path)
        if not batch.isEmpty():
            day = F.to_date(epoch_ms_to_timestamp("ts_ms"))
            landing = self._not_landed(feed, batch.withColumn("event_date", day))
            if not landing.isEmpty():
                self.raw[feed].append(landing)
            letters = staging.malformed(batch, feed)
            if not letters.isEmpty():
                self.dead_letters.merge(letters, ["feed", "_partition_id", "_partition_offset"])
            getattr(self, f"_stage_{feed}")(batch)
            self.ledgers[feed].commit(self.ledgers[feed].next_number(), batch)
        remove_folder(self.spark, path)

    def _stage_orders(self, batch: DataFrame) -> None:
        self.land_orders(staging.stg_orders(batch, keep_offset=True))

    def _stage_trucks(self, batch: DataFrame) -> None:
        self.land_trucks(staging.stg_trucks(batch, keep_offset=True))

    def _stage_truck_telemetry(self, batch: DataFrame) -> None:
        self.land_positions(staging.stg_telemetry(batch))

    def land_orders(self, rows: DataFrame) -> None:
        """Merge decoded orders (one row an order, with ``ts_ms`` and ``_partition_offset``) and note how they stand now."""
        rows = with_key_bucket(rows, ["order_id"], self.key_buckets)
        self.stg_orders.merge(rows, ["order_id"], versions=["ts_ms", "_partition_offset"])
        place = ["_key_bucket", "order_id"]
        stored = self.stg_orders.read_partitions(rows.select("_key_bucket").distinct())
        if stored is not None:
            self.changes["stg_orders"].append(stored.join(rows.select(*place).distinct(), place, "left_semi"))

    def land_trucks(self, rows: DataFrame) -> None:
        """Merge registry rows (one a truck) and note the trucks."""
        self.stg_trucks.merge(rows, ["truck_id"], versions=["ts_ms", "_partition_offset"])
        self.changes["stg_trucks"].append(rows.select("truck_id").distinct())

    def land_positions(self, pings: DataFrame) -> None:
        """Add positions not stored yet; note their truck-days and the trucks whose stored trips they may change."""
        stored = self.stg_telemetry.read()
        if stored is not None:
            pings = incremental.append_absent(
                stored.drop("event_date"), pings, ["truck_id", "event_ts"], range_col="event_ts"
            )
        # The batch is read several times: new positions, once told from stored ones, are kept for the step.
        run = RunFolder(self.spark, "positions", f"{self.base}/_staging")
        try:
            pings = run.keep(pings.withColumn("event_date", F.to_date("event_ts")), "new")
            known = self.order_trips.read()
            if known is not None and stored is not None:
                late = trips.late_trucks(pings, known, stored)
                if not late.isEmpty():  # before the positions are stored: repeating this adds a truck twice at most
                    late.write.mode("append").parquet(self.late)
            if stored is not None or not pings.isEmpty():
                self.changes["stg_telemetry"].append(
                    pings.select("truck_id", F.col("event_date").alias("activity_date")).distinct()
                )
                self.stg_telemetry.append(pings)
        finally:
            run.close()

    # --- staging to marts -----------------------------------------------------------

    def build(
        self,
        full_refresh: bool = False,
        as_of: date | None = None,
        threshold: float = marts.OTD_THRESHOLD_MIN,
        lookback_days: int = marts.LOOKBACK_DAYS,
    ) -> None:
        """Bring trips, truck-days and marts up to date (or rebuild them).

        Each step recomputes the keys and days that the change logs name, and
        what a window carries on from them; the outcome is that of a rebuild. With
        ``as_of`` the daily marts also refresh the ``lookback_days`` before it,
        changed or not.
        """
        steps = [
            ("order_trips", self._build_trips, ()),
            ("truck_activity", self._build_activity, ()),
            ("otd", self._build_otd, (threshold,)),
            ("district_heatmap", self._build_heatmap, (threshold,)),
            ("fleet_utilization", self._build_fleet, ()),
        ]
        since = None if as_of is None else as_of - timedelta(days=lookback_days)
        for name, step, options in steps:
            self._run(name, full_refresh, lambda step=step, options=options: step(full_refresh, since, *options))

    def _pending(self, reader: str, sources: list[str], full_refresh: bool) -> tuple[dict[str, Pending], bool]:
        """What a step has not seen of its sources, and whether it has to run in full."""
        found = {name: self.changes[name].pending(reader) for name in sources}
        full = full_refresh or not getattr(self, reader).exists()
        return found, full or any(p.everything for p in found.values())

    def _seen(self, reader: str, found: dict[str, Pending]) -> None:
        for name, pending in found.items():
            self.changes[name].advance(reader, pending.upto)

    def _trip_inputs(self) -> tuple[DataFrame, DataFrame]:
        return self.stg_orders.read().drop("_key_bucket", "_partition_offset"), self.stg_telemetry.read().drop("event_date")

    def _build_trips(self, full_refresh: bool, _since: date | None) -> None:
        """Trips of the orders that changed, from the log of orders alone; then those of late positions."""
        log, key = self.changes["order_trips"], ["order_id"]
        found, full = self._pending("order_trips", ["stg_orders"], full_refresh)
        orders, telemetry = self._trip_inputs()
        if full:
            log.append_all()
            self.order_trips.overwrite(trips.order_trips(orders, telemetry))
        else:
            changed, near = found["stg_orders"].rows, None
            if changed is not None:
                changed = latest_per_key(changed, key, [ENTRY]).select(*orders.columns)
            if path_exists(self.spark, self.late):  # positions that came after their trips were stored
                late = self.spark.read.parquet(self.late).distinct()
                again, near = (rows.join(late, "truck_id", "left_semi") for rows in (orders, telemetry))
                # The other trucks' changed orders need the positions around them only.
                rest = None if changed is None else changed.join(late, "truck_id", "left_anti")
            else:
                again, rest = None, changed
            if rest is not None:
                around = trips.positions_for(trips.completed_orders(rest), telemetry)
                near = around if near is None else near.unionByName(around.join(late, "truck_id", "left_anti"))
                again = rest if again is None else again.unionByName(rest)
            if again is not None:
                track = ["truck_id", "trip_date", "pickup_address", "delivery_address"]
                rows = trips.order_trips(again, near)
                self.order_trips.replace_keys(rows, again.select("order_id"), key, log, track)
        remove_folder(self.spark, self.late)
        self._seen("order_trips", found)

    def _build_activity(self, full_refresh: bool, _since: date | None) -> None:
        """Truck-days with other trips, new positions or another registry entry."""
        log, place = self.changes["truck_activity"], ["truck_id", "activity_date"]
        found, full = self._pending("truck_activity", ["order_trips", "stg_telemetry", "stg_trucks"], full_refresh)
        trucks = self.stg_trucks.read().drop("_partition_offset")
        if full:
            rows = activity.truck_activity(self.order_trips.read(), trucks, self.stg_telemetry.read().drop("event_date"))
            log.append_all()
            self.truck_activity.overwrite(rows)
        else:
            days = [
                found["order_trips"].rows, found["stg_telemetry"].rows, self._days_of(found["stg_trucks"].rows)
            ]
            days = [d.withColumnRenamed("trip_date", "activity_date").select(*place) for d in days if d is not None]
            if days:
                dirty = reduce(DataFrame.unionByName, days).distinct()
                day = dirty.select("activity_date").distinct()
                near = self.order_trips.read_partitions(day.withColumnRenamed("activity_date", "trip_date"))
                pings = self.stg_telemetry.read_partitions(day.withColumnRenamed("activity_date", "event_date"))
                rows = activity.truck_activity(near, trucks, pings.drop("event_date"), only=dirty)
                self.truck_activity.replace_keys(rows, dirty, place, log)
        self._seen("truck_activity", found)

    def _days_of(self, trucks: DataFrame | None) -> DataFrame | None:
        """Stored days of some trucks, from the key columns alone."""
        if trucks is None:
            return None
        days = self.truck_activity.read().select("truck_id", "activity_date")
        return days.join(trucks.select("truck_id").distinct(), "truck_id", "left_semi")

    def _dirty(self, pending: Pending, names: dict[str, str], source: DataFrame, stored: DataFrame, since: date | None) -> DataFrame | None:
        """Keys of a daily mart (the first one its day) that changed or lie in the days to refresh."""
        day, *_ = names
        parts = [] if pending.rows is None else [pending.rows.select(*[F.col(o).alias(n) for n, o in names.items()])]
        if since is not None:
            recent = source.where(F.col(names[day]) >= F.lit(since))
            parts.append(recent.select(*[F.col(o).alias(n) for n, o in names.items()]))
            parts.append(stored.where(F.col(day) >= F.lit(since)).select(*names))
        return reduce(DataFrame.unionByName, parts).distinct() if parts else None

    def _build_daily(self, name: str, source: str, full_refresh: bool, since: date | None, names: dict[str, str], whole, changed) -> None:
        """A mart by day: ``whole`` from all rows of its source, ``changed`` for the dirty keys."""
        table, origin = getattr(self, name), getattr(self, source)
        found, full = self._pending(name, [source], full_refresh)
        if full:
            table.overwrite(whole(origin.read()))
        else:
            day = next(iter(names))
            dirty = self._dirty(found[source], names, origin.read(), table.read(), since)
            if dirty is not None:
                near = origin.read_partitions(dirty.select(F.col(day).alias(names[day])).distinct())
                rows = changed(near, table.read(), dirty)
                # Rows after a dirty one come out anew as well.
                table.replace_keys(rows, dirty.unionByName(rows.select(*names)), list(names))
        self._seen(name, found)

    def _build_otd(self, full_refresh: bool, since: date | None, threshold: float) -> None:
        self._build_daily(
            "otd", "order_trips", full_refresh, since, {"trip_date": "trip_date", "district": "delivery_address"},
            lambda rows: marts.otd(rows, threshold), lambda rows, stored, dirty: marts.otd_changed(rows, stored, dirty, threshold),
        )

    def _build_heatmap(self, full_refresh: bool, since: date | None, threshold: float) -> None:
        names = {"trip_date": "trip_date", "origin_district": "pickup_address", "destination_district": "delivery_address"}
        self._build_daily(
            "district_heatmap", "order_trips", full_refresh, since, names,
            lambda rows: marts.district_heatmap(rows, threshold),
            lambda rows, _stored, dirty: marts.district_heatmap(rows, threshold, only=dirty),
        )

    def _build_fleet(self, full_refresh: bool, since: date | None) -> None:
        self._build_daily(
            "fleet_utilization", "truck_activity", full_refresh, since, {"metric_date": "activity_date", "truck_id": "truck_id"},
            marts.fleet_utilization, marts.fleet_changed,
        )

    def _run(self, name: str, full_refresh: bool, step) -> None:
        """Run one model and log it, whether it succeeds or not."""
        started, status, message = datetime.now(), "success", None
        try:
            step()
        except Exception as error:
            status, message = "error", str(error)
            raise
        finally:
            ended = datetime.now()
            insert_rows(
                self.spark,
                [
                    {
                        "model_execution_id": uuid.uuid4().hex, "unique_id": f"model.{name}", "name": name,
                        "generated_at": ended, "status": status, "message": message, "resource_type": "model",
                        "execution_time": (ended - started).total_seconds(), "execute_started_at": started,
                        "execute_completed_at": ended, "full_refresh": full_refresh, "materialization": "incremental",
                    }
                ],
                RUN_RESULTS,
                self.run_results,
            )

    # --- checks ---------------------------------------------------------------------------

    def check(self, as_of: datetime | None = None) -> DataFrame:
        """Results of the declared column tests on all built tables."""
        results = None
        for table, declared in checks.mart_checks().items():
            rows = checks.run_checks(getattr(self, table).read(), declared, table, as_of)
            results = rows if results is None else results.unionByName(rows)
        return results
