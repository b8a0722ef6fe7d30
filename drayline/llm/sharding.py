"""Shuffled shards of a corpus by a two-pass external shuffle.

First pass: every record goes to a bucket chosen by a seeded hash of its place
in the input, so buckets are uniform samples of about ``BUCKET_BYTES`` whatever
the keys or copies in the data.  Second pass: each bucket fits a task, is
shuffled there by Fisher-Yates with a seed of its own and written.  Buckets
follow one another, so a record's position is its bucket's first position plus
its place in the bucket, and shards are equal stretches of the positions: a
bucket touches one or two shards, never all.

The place in the input is Spark's partition and row, which is the same again
when a lost task is repeated as long as the input is stored; an input that is
computed with shuffles of its own should be written first.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

BUCKET_BYTES = 16 << 20
#: Law of the shards: numbers of rows at most one apart.
LAW = "rows"


def write_shards(docs: DataFrame, path: str, shards: int, size_col: str = "text", seed: int = 11, bucket_bytes: int = BUCKET_BYTES) -> None:
    """Write the rows in random order as ``shards`` folders ``shard=<k>``, with their ``slot`` (gapless from 0).

    The order depends on the seed and the stored input alone.  Shards differ by
    one row at most; with fewer rows than shards the last ones are empty.
    Input columns named ``shard`` or ``slot`` are left out; all others are
    kept, nulls included.  An empty table writes an empty one.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    columns = [c for c in docs.columns if c not in ("shard", "slot")]
    plain = docs.select(*columns).toDF(*[f"c{i}" for i in range(len(columns))])
    size = F.coalesce(F.octet_length(f"c{columns.index(size_col)}"), F.lit(0)) + 1
    total, rows = plain.agg(F.sum(size.cast("long")), F.count("*")).first()
    buckets = max(1, -(-(total or 0) // bucket_bytes))
    row = plain.withColumn("row", F.monotonically_increasing_id())
    scattered = row.withColumn("bucket", F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(buckets)))
    counts = scattered.groupBy("bucket").count()  # one row a bucket
    firsts = counts.select("bucket", (F.sum("count").over(Window.orderBy("bucket")) - F.col("count")).alias("first"))
    more, each = rows % shards, rows // shards
    schema = T.StructType([*plain.schema.fields, T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())])

    def shuffle(table: pa.Table) -> pa.Table:
        table = table.sort_by("row")
        order = np.random.default_rng([seed, table.column("bucket")[0].as_py()]).permutation(len(table))  # Fisher-Yates
        position = table.column("first")[0].as_py() + np.arange(len(table))
        long = more * (each + 1)  # positions in the shards that hold one more
        late = more + (position - long) // max(each, 1)
        shard = np.where(position < long, position // (each + 1), late)
        slot = position - (shard * each + np.minimum(shard, more))
        out = table.take(pa.array(order)).select([f.name for f in plain_fields])
        return out.append_column("shard", pa.array(shard, pa.int32())).append_column("slot", pa.array(slot, pa.int64()))

    plain_fields = plain.schema.fields
    shuffled = scattered.join(firsts, "bucket").groupBy("bucket").applyInArrow(shuffle, schema)
    named = shuffled.toDF(*columns, "shard", "slot")
    named.write.mode("errorifexists").partitionBy("shard").parquet(path)


def read_shards(spark, path: str, schema: T.StructType) -> DataFrame:
    """All shards of a folder; ``schema`` is that of the written rows, ``shard`` and ``slot`` are added."""
    fields = [f for f in schema.fields if f.name not in ("shard", "slot")]
    full = T.StructType([*fields, T.StructField("slot", T.LongType()), T.StructField("shard", T.IntegerType())])
    return spark.read.schema(full).parquet(path)
