"""Operators for preparing text corpora and embeddings, each on the whole of its input."""

from pyspark.sql import SparkSession

#: Rows and bytes that go to a Python worker at a time; texts are long rows.
BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20


def use_small_batches(spark: SparkSession) -> None:
    """Bound what the JVM and a Python worker hold of a stream of long texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
