"""Token ids of a corpus as files of coded blocks, written in id order and read back.

A corpus is sorted by range on the document id, tokenised and coded partition by
partition.  The stored table has one row for each segment (some millions of ids
of whole documents): the partition it came from, its number there, the ids and
lengths of its documents and the coded blocks (see ``range_coder``).  Spark's
own commit protocol writes it, so a lost executor leaves no half file.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T

from drayline.llm import range_coder
from drayline.llm.tokens import encoder
from drayline.session import RunFolder

END_ID = 1
#: Text of one partition of the sort; blocks of one partition are coded side by side.
PARTITION_BYTES = 32 << 20
SEGMENT_IDS = range_coder.BLOCK_IDS * range_coder.LANES


def write_token_files(docs: DataFrame, path: str, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> None:
    """Code all documents in ascending order of ``id_col``, nulls first, ``end_id`` after each.

    Null and empty texts are the end id alone.  Rows with equal ids are all
    written, in an order that their texts decide; equal rows are equal ids too.
    An empty table writes an empty one.
    """
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    total = plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // PARTITION_BYTES))
    order = [F.col("id").asc_nulls_first(), F.col("text").asc_nulls_first()]
    ordered = plain.repartitionByRange(parts, F.col("id").asc_nulls_first()).sortWithinPartitions(*order)
    tail = np.array([end_id], dtype="<u4").tobytes()
    schema = "part int, segment int, docs array<bigint>, lengths array<bigint>, coded binary"

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, segment, held, docs_here, size = TaskContext.get().partitionId(), 0, [], [], 0

        def flush() -> pa.RecordBatch:
            lengths = [len(raw) // 4 for raw in held]
            ids = np.frombuffer(b"".join(held), dtype="<u4")
            held.clear()
            coded = range_coder.encode(ids)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([segment], pa.int32()),
                    pa.array([docs_here], pa.list_(pa.int64())),
                    pa.array([lengths], pa.list_(pa.int64())),
                    pa.array([coded], pa.binary()),
                ],
                names=["part", "segment", "docs", "lengths", "coded"],
            )

        for batch in batches:
            texts = ["" if t is None else t for t in batch.column(1).to_pylist()]
            for doc, raw in zip(batch.column(0).to_pylist(), encoder(vocabulary).encode(texts), strict=True):
                raw += tail
                if held and size + len(raw) // 4 > SEGMENT_IDS:
                    yield flush()
                    held, docs_here, size, segment = [], [], 0, segment + 1
                held.append(raw)
                docs_here.append(doc)
                size += len(raw) // 4
        if held:
            yield flush()

    ordered.mapInArrow(code, schema).write.mode("errorifexists").parquet(path)


def read_token_files(spark, path: str, want_ids: bool = True) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``, ``ids_crc32`` and with ``want_ids``
    ``ids`` (little-endian 32-bit) of every document of the files; damaged blocks raise ``Corrupt``."""
    stored = spark.read.parquet(path)
    sizes = stored.select("part", "segment", F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    by_part = sizes.groupBy("part").agg(F.sum("n").alias("n"))  # one row a partition of the sort
    before = by_part.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    inside = sizes.select("part", "segment", (F.sum("n").over(Window.partitionBy("part").orderBy("segment")) - F.col("n")).alias("inside"))
    placed = inside.join(before, "part").select("part", "segment", (F.col("inside") + F.col("before")).alias("first"))
    fields = [("doc_id", T.LongType()), ("start", T.LongType()), ("n_tokens", T.LongType()), ("ids_crc32", T.LongType())]
    if want_ids:
        fields.append(("ids", T.BinaryType()))
    schema = T.StructType([T.StructField(n, t) for n, t in fields])

    def restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                docs, lengths = batch.column(2)[i].values, batch.column(3)[i].values.to_numpy()
                raw = memoryview(range_coder.decode(batch.column(4)[i].as_py()).astype("<u4", copy=False)).cast("B")
                first = batch.column(5)[i].as_py()
                ends = np.cumsum(lengths)
                if 4 * int(ends[-1]) != len(raw):
                    raise range_coder.Corrupt("the documents do not fill the segment")
                cuts = [raw[4 * (b - n) : 4 * b] for b, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                columns = [docs, pa.array(first + ends - lengths), pa.array(lengths), pa.array([zlib.crc32(c) for c in cuts], pa.int64())]
                if want_ids:
                    columns.append(pa.array(map(bytes, cuts), pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=[n for n, _ in fields])

    joined = stored.join(F.broadcast(placed), ["part", "segment"])  # one narrow row for some millions of ids
    return joined.select("part", "segment", "docs", "lengths", "coded", "first").mapInArrow(restore, schema)


def round_trip(docs: DataFrame, run: RunFolder, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", want_ids: bool = True) -> DataFrame:
    """Write the token files of a corpus below the run's folder and read them back."""
    path = f"{run.path}/tokens"
    write_token_files(docs, path, vocabulary, id_col, text_col)
    return read_token_files(docs.sparkSession, path, want_ids)
