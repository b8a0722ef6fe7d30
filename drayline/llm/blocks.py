"""Texts in numbered blocks, and the exchange that tells blocks which of their names repeat.

A corpus is written once as blocks of a few megabytes, bucketed by block
number: later passes read a block, join the short replies to it without moving
the text again, and find every position where it was before.

The exchange is a distributed sort.  Each block sorts its distinct names and
cuts them at fixed bounds; Spark brings the parts of a range together; the
range is sorted and each part gets back, in its own order, one code a name.
Equal names inside a block travel once with their count, so a name that a third
of all rows hold is one entry a block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from drayline.llm.names import heads
from drayline.session import RunFolder

BLOCK_BYTES = 4 << 20
#: Bytes of text for each range of the exchange; a range holds at most so many names.
RANGE_BYTES = 8 << 20
ONCE, REPEATED, HOT = 0, 1, 2
#: Added to the code of a repeated name in exactly one block of those that hold it.
CHOSEN = 4


@dataclass
class Block:
    """One block inside a task: bytes of all texts, their bounds, the other columns."""

    number: int
    data: np.ndarray
    ends: np.ndarray
    nulls: np.ndarray
    rest: pa.Array

    @property
    def starts(self) -> np.ndarray:
        return np.concatenate([[0], self.ends[:-1]]).astype(np.int64)


def binary_parts(column: pa.Array) -> tuple[np.ndarray, memoryview]:
    """Offsets and bytes of a binary or string column; null cells are empty."""
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    size = np.dtype(np.int64 if wide else np.int32)
    bounds = np.frombuffer(offsets, dtype=size)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return bounds, memoryview(data if data is not None else b"")


def write_blocks(docs: DataFrame, text_col: str, run: RunFolder, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, T.StructType]:
    """Store ``docs`` as blocks; the second result is the schema of the columns beside the text.

    Columns are held by place, so no name of the input can clash with one used here.
    """
    at = docs.columns.index(text_col)
    rest = T.StructType([T.StructField(f"c{i}", f.dataType, True) for i, f in enumerate(f for j, f in enumerate(docs.schema) if j != at)])
    schema = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("rest", T.ArrayType(rest if len(rest) else T.StructType([T.StructField("none", T.IntegerType())]))),
            T.StructField("ends", T.BinaryType()),
            T.StructField("nulls", T.BinaryType()),
            T.StructField("data", T.BinaryType()),
        ]
    )
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    plain = plain.select(F.col(f"c{at}").cast("binary").alias("text"), *[f"c{i}" for i in range(len(docs.columns)) if i != at])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        texts, lengths, nulls, others, size = [], [], [], [], 0

        def flush() -> pa.RecordBatch:
            rows = pa.concat_arrays(others)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    pa.array([size], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows),
                    pa.array([np.cumsum(np.concatenate(lengths), dtype=np.int64).tobytes()], pa.binary()),
                    pa.array([np.concatenate(nulls).astype(np.uint8).tobytes()], pa.binary()),
                    pa.array([b"".join(texts)], pa.binary()),
                ],
                names=[f.name for f in schema],
            )

        for batch in batches:
            column = batch.column(0)
            bounds, data = binary_parts(column)
            missing = column.is_null().to_numpy(zero_copy_only=False)
            fields = [batch.column(i) for i in range(1, batch.num_columns)]
            names = [f"c{i}" for i in range(len(fields))]
            other = pa.StructArray.from_arrays(fields or [pa.nulls(len(column), pa.int32())], names if fields else ["none"])
            a = 0
            while a < len(column):
                b = int(np.searchsorted(bounds, bounds[a] + max(block_bytes - size, 1), side="left"))
                b = min(max(b, a + 1), len(column))
                texts.append(bytes(data[bounds[a] : bounds[b]]))
                lengths.append(np.diff(bounds[a : b + 1]))
                nulls.append(missing[a:b])
                others.append(other.slice(a, b - a))
                size += int(bounds[b] - bounds[a])
                a = b
                if size >= block_bytes:
                    yield flush()
                    texts, lengths, nulls, others, size, number = [], [], [], [], 0, number + 1
        if others:
            yield flush()

    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return run.keep_bucketed(plain.mapInArrow(pack, schema), "blocks", "block", buckets), rest


def range_count(blocks: DataFrame) -> int:
    """Ranges in proportion to the bytes of text."""
    total = blocks.agg(F.sum("n_bytes")).first()[0] or 0
    return max(1, -(-total // RANGE_BYTES))


def read_blocks(batches: Iterator[pa.RecordBatch], replies: int = 0) -> Iterator[tuple[Block, list[np.ndarray]]]:
    """The blocks of a task with the replies joined to them as columns r0, r1, ..."""
    for batch in batches:
        place = {name: i for i, name in enumerate(batch.schema.names)}
        for i in range(batch.num_rows):
            cell = lambda name: batch.column(place[name])[i]  # noqa: B023, E731
            block = Block(
                cell("block").as_py(),
                np.frombuffer(cell("data").as_buffer(), dtype=np.uint8),
                np.frombuffer(cell("ends").as_buffer(), dtype=np.int64),
                np.frombuffer(cell("nulls").as_buffer(), dtype=np.uint8).astype(bool),
                cell("rest").values if "rest" in place else None,
            )
            codes = [b"".join(x["codes"] for x in cell(f"r{k}").as_py() or ()) for k in range(replies)]
            yield block, [np.frombuffer(c, dtype=np.uint8) for c in codes]


def counted(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct names and how often each occurs, at most 255."""
    names = np.sort(names)
    first = heads(names)
    return names[first], np.minimum(np.diff(np.append(first, len(names))), 255).astype(np.uint8)


def _shrink(names: np.ndarray) -> bytes:
    """Sorted names as their first and their gaps in as many bytes as the largest needs."""
    gaps = np.diff(names)
    width = max(1, (int(gaps.max()).bit_length() + 7) // 8) if len(gaps) else 1
    return names[:1].tobytes() + bytes([width]) + gaps.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _grow(cell: bytes) -> np.ndarray:
    width = cell[8]
    gaps = np.frombuffer(cell, dtype=np.uint8, offset=9).reshape(-1, width)
    out = np.zeros((len(gaps) + 1, 8), dtype=np.uint8)
    out[0] = np.frombuffer(cell, dtype=np.uint8, count=8)
    out[1:, :width] = gaps
    return np.cumsum(out.reshape(-1).view(np.uint64), dtype=np.uint64)


def repeated_names(
    blocks: DataFrame,
    names_of: Callable[[Block, list[np.ndarray]], np.ndarray],
    ranges: int,
    replies: int = 0,
    hot_above: int | None = None,
    choose: bool = False,
) -> DataFrame:
    """For each block, a code for each of its distinct names in their order, as parts by range.

    ``names_of`` gives a block's names, repeats included.  Codes: the name
    occurs once, repeatedly, or more than ``hot_above`` times; with ``choose``
    one block of those that hold a repeated name is told so.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, codes in read_blocks(batches, replies):
            names, counts = counted(names_of(block, codes))
            place = ((names >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
            cuts = np.append(heads(place), len(names))
            spans = list(zip(cuts[:-1], cuts[1:], strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(place[a]) for a, _ in spans], pa.int64()),
                    pa.array([block.number] * len(spans), pa.int64()),
                    pa.array([_shrink(names[a:b]) for a, b in spans], pa.binary()),
                    pa.array([counts[a:b].tobytes() for a, b in spans], pa.binary()),
                ],
                names=["part", "block", "names", "counts"],
            )

    def settle(table: pa.Table) -> pa.Table:
        parts = [_grow(x.as_py()) for x in table.column("names")]
        names = np.concatenate(parts)
        counts = np.concatenate([np.frombuffer(x.as_buffer(), dtype=np.uint8) for x in table.column("counts")])
        order = np.argsort(names, kind="stable")
        first = heads(names[order])
        total = np.add.reduceat(counts[order], first, dtype=np.int64)
        code = (total > 1).astype(np.uint8)
        if hot_above is not None:
            code[total > hot_above] = HOT
        out = np.empty(len(names), dtype=np.uint8)
        out[order] = np.repeat(code, np.diff(np.append(first, len(names))))
        if choose:
            out[order[first]] += CHOSEN * (code > 0).astype(np.uint8)
        cuts = np.cumsum([0, *map(len, parts)])
        return pa.table(
            {
                "part": table.column("part"),
                "block": table.column("block"),
                "codes": pa.array([out[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()),
            }
        )

    wanted = ["block", "ends", "nulls", "data", *[f"r{k}" for k in range(replies)]]
    sent = blocks.select(*wanted).mapInArrow(send, "part long, block long, names binary, counts binary")
    settled = sent.groupBy("part").applyInArrow(settle, "part long, block long, codes binary")
    return settled.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("part", "codes"))).alias("reply"))


def with_reply(blocks: DataFrame, reply: DataFrame, k: int) -> DataFrame:
    """Join the reply of round ``k`` to the blocks as column ``rk``."""
    return blocks.join(reply.select("block", F.col("reply").alias(f"r{k}")), "block", "left")


def flags_of(names: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The code of each name of a block, from the codes of its distinct names."""
    order = np.argsort(names)
    first = heads(names[order])
    out = np.empty(len(names), dtype=np.uint8)
    out[order] = np.repeat(codes, np.diff(np.append(first, len(names))))
    return out
