"""What has been landed of a feed: one row per batch and stream partition."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from drayline.sources.tables import path_exists

PARTITION, OFFSET = "_partition_id", "_partition_offset"


class OffsetLedger:
    """First and last offset of each partition in each landed batch, a folder of its own for every batch.

    The offsets to go on from come from here, so nobody reads the landed
    events for them. Committing a number again replaces its rows.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _numbers(self) -> list[int]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        return sorted(int(n) for n in names if n.isdigit() and path_exists(self.spark, f"{self.path}/{n}/_SUCCESS"))

    def next_number(self) -> int:
        numbers = self._numbers()
        return numbers[-1] + 1 if numbers else 1

    def commit(self, number: int, batch: DataFrame) -> None:
        rows = batch.groupBy(F.col(PARTITION).cast("long").alias("part")).agg(
            F.min(OFFSET).cast("long").alias("first"), F.max(OFFSET).cast("long").alias("last"), F.count(F.lit(1)).alias("n")
        )
        rows.withColumn("batch", F.lit(number).cast("long")).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{number:012d}")

    def read(self) -> DataFrame | None:
        """``part``, ``first``, ``last``, ``n``, ``batch``; ``None`` before the first commit."""
        numbers = self._numbers()
        if not numbers:
            return None
        return self.spark.read.schema("part long, first long, last long, n long, batch long").parquet(
            *[f"{self.path}/{n:012d}" for n in numbers]
        )

    def marks(self) -> DataFrame | None:
        """The last offset of each partition: ``_of``, ``_mark``."""
        rows = self.read()
        return None if rows is None else rows.groupBy(F.col("part").alias("_of")).agg(F.max("last").alias("_mark"))
