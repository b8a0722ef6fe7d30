"""Session construction and the shared working folder.

The library never relies on a machine-local folder on a cluster: anything that
has to outlive a task (checkpoints, staged merges) goes to the folder named by
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Adaptive execution does the run-time sizing: post-shuffle coalescing, skewed
# join splitting and the switch to broadcast joins once real sizes are known.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Window groups up to this many rows stay in a plain buffer instead of the spillable one.
    "spark.sql.windowExec.buffer.in.memory.threshold": "65536",
    "spark.ui.enabled": "false",
    # Capturing the Python call site costs a JVM round trip per column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    app_name: str = "drayline",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or get) a session. On a cluster leave ``master`` unset."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**BASE_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> None:
    """Pin the runtime time zone; every bucket and date boundary assumes it."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The cluster's shared folder.

    Where none is configured, ``fallback`` is used, or a temporary folder if
    Spark runs in this one process; on a cluster that would be an error.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None) or fallback
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{CHECKPOINT_CONF} is not set: name a folder that every executor can reach")
    return _local_folder()


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="drayline-")


def scratch_path(spark: SparkSession, label: str, fallback: str | None = None) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark, fallback)}/{label}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str, is_uri: bool = False) -> None:
    """Delete a folder of this library's own through Spark's file system layer; ``is_uri``: the path is percent-encoded."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(path) if is_uri else path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


class RunFolder:
    """The intermediate tables of one run below the shared folder, with an explicit end.

    ``keep`` writes a table that lives until ``close``; ``result`` writes one
    that outlives the run, so that the run's own folder can go.
    """

    def __init__(self, spark: SparkSession, label: str, fallback: str | None = None):
        self.spark = spark
        self.path = scratch_path(spark, label, fallback)
        self._tables: list[str] = []

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.path}/{name}"
        df.write.mode("errorifexists").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def keep_bucketed(self, df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
        """Like ``keep``, stored by hash of a key: joins on the key leave this side where it is."""
        table = f"run_{uuid.uuid4().hex}"
        writer = df.write.format("parquet").option("path", f"{self.path}/{name}").option("compression", "zstd")
        writer.bucketBy(buckets, key).sortBy(key).saveAsTable(table)
        self._tables.append(table)
        return self.spark.table(table)

    def drop(self, name: str) -> None:
        """Remove one intermediate table before the end of the run."""
        remove_folder(self.spark, f"{self.path}/{name}")

    def result(self, df: DataFrame) -> DataFrame:
        """Store the outcome beside the run, end the run and read the outcome back."""
        path = f"{self.path}-result"
        df.write.mode("errorifexists").parquet(path)
        self.close()
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        for table in self._tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self._tables.clear()
        remove_folder(self.spark, self.path)


def cut_lineage(df: DataFrame, label: str = "stage", fallback: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Survives the loss of executors, unlike executor-local storage, and gives
    the reader real file statistics.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label, fallback)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
