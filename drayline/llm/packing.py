"""Packing of documents into sequences: first-fit decreasing in randomised groups.

Documents become token ids and an end id, longer ones are cut into whole
sequences and a rest.  Whole sequences need no packing.  The rests are dealt
over groups of about equal size by a seeded hash of their stored place, so no
group depends on a key of the data, and each group is packed on its own: rests
in falling order of length, each into the first sequence with room, found by
walking down a tournament tree whose nodes hold the largest room below them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from drayline.llm.tokens import encoder
from drayline.session import RunFolder

CAPACITY = 4096
END_ID = 2
#: Rests packed together; more of them fill sequences slightly better.
GROUP_ROWS = 20_000
#: Sequences that hold one whole piece are numbered from here on.
WHOLE = 1 << 62


class TournamentTree:
    """Room in a row of sequences; ``place`` takes it from the first that has enough."""

    def __init__(self, count: int, capacity: int):
        self.leaves = 1 << max(0, count - 1).bit_length()
        self.room = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> int:
        room, at, leaves = self.room, 1, self.leaves
        while at < leaves:
            at *= 2
            if room[at] < size:
                at += 1
        room[at] -= size
        found = at - leaves
        while at > 1:
            at >>= 1
            largest = max(room[2 * at], room[2 * at + 1])
            if room[at] == largest:
                break
            room[at] = largest
        return found


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset in it for each length, longest first, ties in the order given."""
    tree = TournamentTree(len(lengths), capacity)
    sequence, offset = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    filled = [0] * len(lengths)
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        at = tree.place(size)
        sequence[i], offset[i] = at, filled[at]
        filled[at] += size
    return sequence, offset


def token_pieces(docs: DataFrame, text_col: str, vocabulary: str, end_id: int = END_ID, capacity: int = CAPACITY, want_ids: bool = True) -> DataFrame:
    """Each document's ids cut at every ``capacity``: columns beside the text by place, then the piece."""
    at = docs.columns.index(text_col)
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    plain = plain.select(F.col(f"c{at}").alias("text"), *[f"c{i}" for i in range(len(docs.columns)) if i != at])
    fields = [T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens")]
    if want_ids:
        fields.append(T.StructField("ids", T.BinaryType()))
    schema = T.StructType([*plain.schema.fields[1:], *fields])
    tail = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = ["" if t is None else t for t in batch.column(0).to_pylist()]
            row, start, length, crc, total, ids = [], [], [], [], [], []
            for i, raw in enumerate(encoder(vocabulary).encode(texts)):
                raw += tail
                for begin in range(0, len(raw), 4 * capacity):
                    piece = raw[begin : begin + 4 * capacity]
                    row.append(i)
                    start.append(begin // 4)
                    length.append(len(piece) // 4)
                    crc.append(zlib.crc32(piece))
                    total.append(len(raw) // 4)
                    if want_ids:
                        ids.append(piece)
            take = pa.array(row, pa.int64())
            columns = [batch.column(i).take(take) for i in range(1, batch.num_columns)]
            columns += [pa.array(x, pa.int64()) for x in (start, length, crc, total)]
            if want_ids:
                columns.append(pa.array(ids, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema])

    return plain.mapInArrow(cut, schema)


def pack_documents(
    docs: DataFrame,
    run: RunFolder,
    vocabulary: str,
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    seed: int = 17,
    group_rows: int = GROUP_ROWS,
    want_ids: bool = True,
) -> DataFrame:
    """One row for each piece: the input's columns beside the text, ``start``, ``length``, ``ids_crc32``,
    ``doc_tokens``, with ``want_ids`` ``ids`` (little-endian 32-bit), ``sequence_id`` and ``offset``.

    Pieces of a sequence lie side by side from offset 0; what is left up to
    ``capacity`` is padding.  Null and empty texts are the end id alone.  Rows
    are rows: repeated rows and ids are packed each.  An empty table gives an
    empty result; input columns named like a result column are left out.
    """
    pieces = token_pieces(docs, text_col, vocabulary, end_id, capacity, want_ids)
    stored = run.keep(pieces.withColumn("piece", F.monotonically_increasing_id()), "pieces")
    rests = stored.where(F.col("length") < capacity)
    groups = max(1, round(rests.count() / group_rows))
    dealt = rests.select("piece", "length", F.pmod(F.xxhash64("piece", F.lit(seed)), F.lit(groups)).alias("lot"))

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("piece")
        sequence, offset = first_fit_decreasing(table.column("length").to_numpy(), capacity)
        lot = table.column("lot").to_numpy()
        return pa.table({"piece": table.column("piece"), "sequence_id": pa.array((lot << 32) + sequence), "offset": pa.array(offset)})

    packed = dealt.groupBy("lot").applyInArrow(pack, "piece long, sequence_id long, offset long")
    whole = stored.where(F.col("length") == capacity).withColumns(
        {"sequence_id": F.col("piece") + F.lit(WHOLE), "offset": F.lit(0).cast("long")}
    )
    placed = rests.join(packed, "piece").unionByName(whole)
    made = ["start", "length", "ids_crc32", "doc_tokens", *(["ids"] if want_ids else []), "sequence_id", "offset"]
    others = [c for c in docs.columns if c != text_col]
    at = docs.columns.index(text_col)
    places = [i for i in range(len(docs.columns)) if i != at]
    return placed.select(*[F.col(f"c{i}").alias(name) for i, name in zip(places, others, strict=True) if name not in made], *made)
