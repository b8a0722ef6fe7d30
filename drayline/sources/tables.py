"""Stored Parquet tables and their maintenance.

Two layouts. A *snapshot table* keeps complete versions side by side and is
read at its newest finished one; it suits registries and anything rewritten as
a whole. A *partitioned table* replaces only the partitions a batch touches; it
is the layout for large tables, whose partition column has to be a function of
the merge key (a date inside the key, or a hash of it) so that a key never
moves. Where the catalog has row-level operations (``MERGE INTO``), use
:func:`merge_into` instead of either.
"""

from __future__ import annotations

from datetime import datetime
from typing import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from drayline.operators import incremental
from drayline.session import RunFolder, remove_folder
from drayline.sources.change_log import ChangeLog
from drayline.sources.schema_log import Entry, SchemaLog

KEY_BUCKET = "_key_bucket"
INSERT_CHUNK = 5000
#: So many partition values are also handed to the scan as a list, to prune folders; the join decides in any case.
PRUNED_PARTITIONS = 2_000


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


class SnapshotTable:
    """Complete versions below one path; a version counts once its job has committed."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _versions(self) -> list[int]:
        fs, root = _fs(self.spark, self.path)
        if not fs.exists(root):
            return []
        found = []
        for status in fs.listStatus(root):
            name = status.getPath().getName()
            if name.startswith("v=") and path_exists(self.spark, f"{self.path}/{name}/_SUCCESS"):
                found.append(int(name[2:]))
        return sorted(found)

    def exists(self) -> bool:
        return bool(self._versions())

    def read(self) -> DataFrame | None:
        """The newest finished version, ``None`` before the first."""
        versions = self._versions()
        return self.spark.read.parquet(f"{self.path}/v={versions[-1]}") if versions else None

    def overwrite(self, df: DataFrame) -> None:
        versions = self._versions()
        number = versions[-1] + 1 if versions else 1
        df.write.mode("overwrite").parquet(f"{self.path}/v={number}")

    def append(self, df: DataFrame) -> None:
        """Add rows to the newest version in place; a column that it lacks makes a new version."""
        current = self.read()
        if current is None:
            self.overwrite(df)
            return
        wide = incremental.append_new_columns(current, df)
        rows = incremental.append_new_columns(df, wide)
        rows = rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in wide.schema])
        if wide.columns == current.columns:
            rows.write.mode("append").parquet(f"{self.path}/v={self._versions()[-1]}")
        else:
            self.overwrite(wide.unionByName(rows))

    def merge(
        self,
        source: DataFrame,
        keys: list[str],
        full_refresh: bool = False,
        on_schema_change: str = "sync_all_columns",
        versions: list[str] | None = None,
    ) -> None:
        current = None if full_refresh else self.read()
        if current is None:
            self.overwrite(source)
        elif versions:
            self.overwrite(incremental.merge_latest(current, source, keys, versions))
        else:
            self.overwrite(incremental.merge_upsert(current, source, keys, on_schema_change))

    def replace_rows(self, df: DataFrame) -> None:
        """Other content, same columns."""
        current = self.read()
        self.overwrite(df if current is None else df.select(*current.columns))

    def truncate(self) -> None:
        current = self.read()
        if current is not None:
            self.overwrite(incremental.empty_like(current))

    def delete_where(self, predicate: Column | str) -> None:
        current = self.read()
        if current is not None:
            self.overwrite(incremental.delete_where(current, predicate))

    def delete_and_insert(self, insert_rows=None, delete_keys=None, key=None) -> None:
        self.overwrite(incremental.delete_and_insert(self.read(), insert_rows, delete_keys, key))

    def sync_by_hash(self, current: DataFrame, hash_col: str = "metadata_hash") -> bool:
        """Bring the table to ``current``; writes nothing when the hashes agree."""
        stored = self.read()
        if stored is None:
            self.overwrite(current)
            return True
        if incremental.diff_by_hash(stored, current, hash_col).isEmpty():
            return False
        self.overwrite(incremental.apply_hash_diff(stored, current, hash_col))
        return True


class PartitionedTable:
    """Parquet partitioned by columns derived from the key; merges touch few partitions.

    A merge is prepared beside the table and then put in place partition by
    partition. The prepared rows and the list of partitions that end up empty
    stay until all of it is done, so whoever opens the table next finishes what
    an interrupted run has begun.

    Columns, their types and the types of the partition columns are kept beside
    the table (:class:`SchemaLog`), so partitions written before a column came
    hold it as null, one written after a column went does not bring it back,
    and a text in a folder name stays a text. (An empty text as a partition value
    is a null, as Spark writes it.)
    """

    def __init__(self, spark: SparkSession, path: str, partition_by: list[str], staging_fallback: str | None = None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.partition_by = partition_by
        self.staging_fallback = staging_fallback
        self._pending = f"{self.path}.pending"
        self.schema_log = SchemaLog(spark, f"{self.path}.schema")

    def exists(self) -> bool:
        """Whether any partition is stored."""
        fs, root = _fs(self.spark, self.path)
        return fs.exists(root) and any(s.isDirectory() and "=" in s.getPath().getName() for s in fs.listStatus(root))

    def _entry(self) -> Entry:
        """The schema of a table that exists; one written without a log is read once to make one."""
        entry = self.schema_log.newest()
        return entry or self.schema_log.replace(self.spark.read.option("mergeSchema", True).parquet(self.path).schema)

    def read(self) -> DataFrame | None:
        self.finish()
        return self._entry().read(self.spark, self.path) if self.exists() else None

    def _write(self, df: DataFrame, mode: str, watch: Callable[[DataFrame], DataFrame] | None = None) -> None:
        # AQE sizes this shuffle and splits a partition value that is very large.
        spread = self._entry().for_files(df).hint("rebalance", *self.partition_by)
        (
            (watch(spread) if watch else spread)
            .write.mode(mode)
            .option("partitionOverwriteMode", "dynamic" if mode == "overwrite" else "static")
            .partitionBy(*self.partition_by)
            .parquet(self.path)
        )

    def overwrite(self, df: DataFrame) -> None:
        """Replace the whole table."""
        remove_folder(self.spark, self._pending)
        self.schema_log.replace(df.schema)
        (
            df.hint("rebalance", *self.partition_by)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .partitionBy(*self.partition_by)
            .parquet(self.path)
        )

    def append(self, df: DataFrame, watch: Callable[[DataFrame], DataFrame] | None = None) -> None:
        """Add rows. New columns join the table's; values are cast to the types it has, missing columns are null.

        ``watch`` is applied to the rows as they are written, after the last shuffle (see ``operators/observed.py``).
        """
        self.finish()
        if not self.exists():
            self.schema_log.replace(df.schema)
        else:
            held = self._entry()
            fields = [T.StructField(n, kind) for n, (_, kind) in held.columns.items()]
            fields += [f for f in df.schema if f.name not in held.columns]
            self.schema_log.evolve(T.StructType(fields), self.partition_by)
        self._write(df, "append", watch)

    def _same_partition(self, other: dict[str, str]) -> Column:
        match = F.lit(True)
        for c, name in other.items():
            match = match & F.col(c).eqNullSafe(F.col(name))
        return match

    def _only(self, df: DataFrame, partitions: DataFrame) -> DataFrame:
        """Rows of the given partitions. A short list also prunes the folders that are read."""
        renamed = {c: f"_{c}" for c in self.partition_by}
        listed = partitions.select(*[F.col(c).alias(n) for c, n in renamed.items()])
        first = self.partition_by[0]
        values = [r[0] for r in partitions.select(first).distinct().limit(PRUNED_PARTITIONS + 1).collect()]
        if len(values) <= PRUNED_PARTITIONS and not any(v is None or isinstance(v, datetime) for v in values):
            df = df.where(F.col(first).isin(*[F.lit(v).cast(df.schema[first].dataType) for v in values]))
        return df.join(listed, self._same_partition(renamed), "left_semi")

    def merge(
        self,
        source: DataFrame,
        keys: list[str],
        full_refresh: bool = False,
        on_schema_change: str = "sync_all_columns",
        versions: list[str] | None = None,
        keys_may_move: bool = False,
    ) -> None:
        """Upsert that rewrites only the partitions the batch touches, however many.

        ``keys_may_move`` also finds the partitions that hold older rows of
        the batch's keys, by a scan of the key columns alone; those that are
        empty afterwards go. ``versions`` keeps the newer of the stored and the
        incoming row. Where a column's type changes, all partitions are written
        again, so a value that cannot be cast fails the merge and not a later
        read. The batch is computed once; see the class for what happens after
        an interruption.
        """
        current = None if full_refresh else self.read()
        if current is None:
            self.overwrite(source)
            return
        run = RunFolder(self.spark, "merge", self.staging_fallback or f"{self.path}.staging")
        try:
            source = run.keep(source, "batch")
            touched = source.select(*self.partition_by)
            if keys_may_move:
                held = current.select(*dict.fromkeys([*keys, *self.partition_by])).join(source.select(*keys), keys, "left_semi")
                touched = touched.unionByName(held.select(*self.partition_by))
            touched = run.keep(touched.distinct(), "touched")
            follows = versions or on_schema_change == "sync_all_columns"
            retyped = bool(follows) and self._entry().retyped(source.schema)
            stored = current if retyped else self._only(current, touched)
            if retyped and keys_may_move:
                touched = touched.unionByName(current.select(*self.partition_by).distinct())
            if versions:
                merged = incremental.merge_latest(stored, source, keys, versions)
            else:
                merged = incremental.merge_upsert(stored, source, keys, on_schema_change)
            self.replace_partitions(merged, touched if keys_may_move else None, whole=retyped)
        finally:
            run.close()

    def read_partitions(self, partitions: DataFrame) -> DataFrame | None:
        """Rows of the listed partitions, the other folders unread where the list is short."""
        stored = self.read()
        return None if stored is None else self._only(stored, partitions)

    def replace_keys(
        self, rows: DataFrame, dirty: DataFrame, keys: list[str], log: ChangeLog | None = None, track: list[str] | None = None
    ) -> None:
        """Rows whose key is listed in ``dirty`` go, ``rows`` (of such keys only) come in their place.

        Nulls in keys match nulls. Rows that come out as they are stored change
        nothing: only partitions with a difference are written. ``log`` is told
        the values of ``track`` of all rows that go or come, before they do.
        """
        current = self.read()
        if current is None:
            if log is not None:
                log.append_all()
            self.overwrite(rows)
            return
        run = RunFolder(self.spark, "replace", self.staging_fallback or f"{self.path}.staging")
        try:
            rows = run.keep(rows, "rows")
            dirty = run.keep(dirty.select(*keys).distinct(), "dirty")
            if set(self.partition_by) <= set(keys):
                places = dirty.select(*self.partition_by).distinct()
            else:
                narrow = current.select(*dict.fromkeys([*keys, *self.partition_by]))
                places = incremental.matching(narrow, dirty, keys).select(*self.partition_by)
                places = run.keep(places.unionByName(rows.select(*self.partition_by)).distinct(), "places")
            near = self._only(current, places)
            held = run.keep(incremental.matching(near, dirty, keys), "held")
            if dict(rows.dtypes) == dict(held.dtypes):
                old = held.select(*rows.columns)
                changed = old.exceptAll(rows).unionByName(rows.exceptAll(old))
            else:
                changed = held.unionByName(rows, allowMissingColumns=True)
            noted = list(dict.fromkeys([*(track or keys), *self.partition_by]))
            changed = run.keep(changed.select(*noted).distinct(), "changed")
            if changed.isEmpty():
                return
            if log is not None:
                log.append(changed.select(*(track or keys)).distinct())
            touched = changed.select(*self.partition_by).distinct()
            kept = incremental.matching(self._only(current, touched), dirty, keys, "left_anti")
            coming = incremental.matching(rows, touched, self.partition_by)
            self.replace_partitions(incremental.stacked(kept, coming), touched)
        finally:
            run.close()

    def replace_partitions(self, df: DataFrame, affected: DataFrame | None = None, whole: bool = False) -> None:
        """Swap in new content; ``affected`` partitions (a DataFrame of them) that end up empty are removed.

        New columns join the table and missing ones leave it. Other types are
        refused unless ``whole`` says that ``df`` holds every partition.
        """
        if not whole and self.exists() and self._entry().retyped(df.schema):
            raise ValueError("column types differ from the table's")
        remove_folder(self.spark, self._pending)
        df.write.parquet(f"{self._pending}/rows")
        fresh = self.spark.read.schema(df.schema).parquet(f"{self._pending}/rows")
        if affected is not None and self.exists():
            # The folders are taken from the files, so no rule for their names is needed here.
            renamed = {c: f"_{c}" for c in self.partition_by}
            filled = fresh.select(*[F.col(c).alias(n) for c, n in renamed.items()]).distinct()
            gone = affected.join(filled, self._same_partition(renamed), "left_anti")
            listed = gone.select(*[F.col(c).alias(n) for c, n in renamed.items()])
            files = self.spark.read.schema(self._entry().stored()).parquet(self.path)
            stored = files.select(*self.partition_by, F.col("_metadata.file_path").alias("_file"))
            folders = stored.join(listed, self._same_partition(renamed), "left_semi").select(
                F.regexp_replace("_file", "/[^/]*$", "").alias("folder")
            )
            folders.distinct().write.parquet(f"{self._pending}/emptied")
        fs, ready = _fs(self.spark, f"{self._pending}/_READY")
        fs.create(ready).close()
        self.finish()

    def finish(self) -> None:
        """Complete a replacement that was prepared in full; drop one that was not. Repeating it does no harm."""
        if not path_exists(self.spark, self._pending):
            return
        if path_exists(self.spark, f"{self._pending}/_READY"):
            rows = self.spark.read.parquet(f"{self._pending}/rows")
            if rows.columns:
                if self.exists():
                    self._entry()
                self.schema_log.evolve(rows.schema, self.partition_by)
                self._write(rows, "overwrite")
            if path_exists(self.spark, f"{self._pending}/emptied"):
                for row in self.spark.read.schema("folder string").parquet(f"{self._pending}/emptied").toLocalIterator():
                    remove_folder(self.spark, row.folder, is_uri=True)
        remove_folder(self.spark, self._pending)


def with_key_bucket(df: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """Add a partition column computed from the key, for tables without a natural one."""
    return df.withColumn(KEY_BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def merge_into(source: DataFrame, table: str, keys: list[str]) -> None:
    """``MERGE INTO`` for catalogs with row-level operations."""
    condition = None
    for key in keys:
        match = F.col(f"source.{key}") == F.col(f"{table}.{key}")
        condition = match if condition is None else condition & match
    source.alias("source").mergeInto(table, condition).whenMatched().updateAll().whenNotMatched().insertAll().merge()


# --- catalog tables -------------------------------------------------------------


class Layers:
    """Layer names mapped to databases; a layer name is used as it is, never prefixed."""

    # The layers and which models they hold.
    ROUTES = {
        "raw": "bronze",
        "staging": "bronze",
        "silver": "silver",
        "gold": "gold",
        "observability": "observability",
        "test_failures": "test_failures",
    }

    def __init__(self, spark: SparkSession, routes: dict[str, str] | None = None):
        self.spark = spark
        self.routes = routes or dict(self.ROUTES)

    def database(self, folder: str, default: str = "default") -> str:
        return self.routes.get(folder, default).strip()

    def create_all(self) -> None:
        for name in sorted(set(self.routes.values())):
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")

    def table(self, folder: str, name: str) -> str:
        return f"{self.database(folder)}.{name}"


def create_table_as(df: DataFrame, table: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """Columnar table from a query."""
    writer = df.write.format("parquet").mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)


def intermediate_view(df: DataFrame, name: str) -> DataFrame:
    """Register a query under a session name."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def drop_relation(spark: SparkSession, name: str) -> None:
    """Drop a view or table, whichever the name denotes."""
    if spark.catalog.dropTempView(name):
        return
    if spark.catalog.tableExists(name):
        kind = spark.catalog.getTable(name).tableType
        spark.sql(f"DROP {'VIEW' if kind == 'VIEW' else 'TABLE'} IF EXISTS {name}")


def insert_rows(
    spark: SparkSession,
    rows: Iterable[tuple | dict],
    schema: T.StructType,
    path: str,
    chunk_size: int = INSERT_CHUNK,
) -> int:
    """Append driver-side rows (run logs, configuration) in chunks; returns the count."""
    if chunk_size < 1:
        raise ValueError("chunk_size must be positive")
    buffer: list = []
    total = 0

    def flush() -> None:
        spark.createDataFrame(buffer, schema).coalesce(1).write.mode("append").parquet(path)

    for row in rows:
        buffer.append(row)
        total += 1
        if len(buffer) == chunk_size:
            flush()
            buffer = []
    if buffer:
        flush()
    return total


def append_rows(df: DataFrame, path: str, chunk_size: int = INSERT_CHUNK) -> None:
    """Append rows in files of at most ``chunk_size`` rows, written by the executors."""
    if chunk_size < 1:
        raise ValueError("chunk_size must be positive")
    df.write.mode("append").option("maxRecordsPerFile", chunk_size).parquet(path)


def read_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV file with a header, read with explicit types."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def partition_for_series(df: DataFrame, key: str, ts: str, path: str, mode: str = "append") -> None:
    """Write a time series by day, sorted so that one key's rows of a day lie together."""
    dated = df.withColumn("event_date", F.to_date(ts))
    (
        dated.hint("rebalance", "event_date")
        .sortWithinPartitions("event_date", key, ts)
        .write.mode(mode)
        .partitionBy("event_date")
        .parquet(path)
    )
