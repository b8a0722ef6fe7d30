"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most ``2r`` bits have a common neighbour at
most ``r`` bits from each.  So each distinct fingerprint emits every value
within ``r`` of it (itself included), equal values meet in a shuffle, and the
fingerprints that met are verified by their differing bits.  For radius 2 that
is 65 values a fingerprint, and a value can be met by 65 fingerprints at most,
whatever the data: no bucket is larger than that, and copies count once.

The fingerprints that meet at a value link to the smallest of them where the
bits agree; for an even radius all of them do, as both are within half the
radius of the value.  So links are a star a value and not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F, types as T

from drayline.llm.blocks import binary_parts
from drayline.llm.components import components
from drayline.session import RunFolder

SEED = 42
SHINGLE = 3
RADIUS = 2
#: Words hashed at a time, so that a long text needs no more memory than a short one.
STRETCH = 1 << 16


def fingerprint_of(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64-bit SimHash of one text: a bit is set if over half of its shingles' hashes have it."""
    words = text.lower().split()  # on bytes: only A-Z change, only 9-13 and 32 separate
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    digest = xxhash.xxh64_intdigest
    votes, total = np.zeros(64, dtype=np.int64), len(words) - shingle + 1
    for at in range(0, total, STRETCH):
        part = words[at : at + STRETCH + shingle - 1]
        joined = b" ".join(part)
        ends = np.cumsum(np.fromiter(map(len, part), dtype=np.int64, count=len(part)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        spans = zip(starts[: len(part) - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], seed) for a, b in spans], dtype="<u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * votes > total, bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, text_col: str, out: str = "fingerprint", shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """The input's columns with the SimHash (as a signed long) in place of the text."""
    at = docs.columns.index(text_col)
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    plain = plain.select(F.col(f"c{at}").cast("binary").alias("text"), *[f"c{i}" for i in range(len(docs.columns)) if i != at])
    schema = T.StructType([*plain.schema.fields[1:], T.StructField("fp", T.LongType())])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bounds, data = binary_parts(batch.column(0))
            values = [fingerprint_of(bytes(data[a:b]), shingle, seed) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            column = pa.array(np.array(values, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], column], names=[f.name for f in schema])

    made = plain.mapInArrow(apply, schema)
    kept = [(f"c{i}", name) for i, name in ((i, c) for i, c in enumerate(docs.columns) if i != at) if name != out]
    return made.select(*[F.col(c).alias(name) for c, name in kept], F.col("fp").alias(out))


def ball(radius: int) -> list[int]:
    """All 64-bit masks of at most ``radius`` set bits, as signed values."""
    masks, layer = [0], [(0, 0)]
    for _ in range(radius):
        layer = [(m | 1 << b, b + 1) for m, low in layer for b in range(low, 64)]
        masks += [m for m, _ in layer]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(values: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs ``a < b`` of distinct fingerprints (column ``fp``) that connect all within ``radius`` bits.

    Fingerprints of one component under "at most ``radius`` bits apart" are
    connected by these pairs, and every pair is within ``radius`` bits.
    """
    half = (radius + 1) // 2
    masks = F.array(*[F.lit(m).cast("long") for m in ball(half)])
    spread = values.select("fp").distinct().select("fp", F.explode(F.transform(masks, lambda m: m.bitwiseXOR(F.col("fp")))).alias("value"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    if radius % 2 == 0:
        least = F.min("fp").over(Window.partitionBy("value"))
        pairs = spread.select(least.alias("a"), F.col("fp").alias("b"))
    else:  # two that met may be one bit too far apart; at most len(ball) of them meet
        met = spread.groupBy("value").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
        pairs = met.select("fps", F.explode("fps").alias("a")).select("a", F.explode("fps").alias("b"))
    return pairs.where("a < b").where(near).distinct()


def near_duplicates(
    docs: DataFrame,
    run: RunFolder,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    seed: int = SEED,
) -> DataFrame:
    """The input's columns beside the text, ``fingerprint`` (long) and ``component_id``.

    Texts lower-cased in A-Z are split at spaces and the bytes 9 to 13, shingles
    of ``shingle`` words joined by a space, repeats included (fewer words: the
    whole sequence; none, an empty or a null text: fingerprint zero, linked like
    any other).  ``component_id`` is the smallest id reachable over links of at
    most ``radius`` bits.  Null ids never name a component unless all its ids
    are null.  Rows are rows: repeated ids and repeated rows each get a result.
    An empty table gives an empty result; input columns named like a result
    column are left out.
    """
    names = [c for c in docs.columns if c != text_col and c not in ("fingerprint", "component_id")]
    docs = docs.select(*[c for c in docs.columns if c in names or c == text_col])
    marked = run.keep(_plain(fingerprints(docs, text_col, "fingerprint", shingle, seed)), "fingerprints")
    at = names.index(id_col)
    by_value = run.keep(marked.groupBy("fp").agg(F.min(f"c{at}").alias("least")), "values")
    parts = components(links(by_value, radius), run)
    owner = by_value.join(parts, by_value.fp == parts.vertex, "left").select("fp", "least", F.coalesce("component", "fp").alias("part"))
    smallest = owner.groupBy("part").agg(F.min("least").alias("component_id"))
    label = owner.join(smallest, "part").select("fp", "component_id")
    return marked.join(label, "fp").select(
        *[F.col(f"c{i}").alias(name) for i, name in enumerate(names)], F.col("fp").alias("fingerprint"), "component_id"
    )


def _plain(df: DataFrame) -> DataFrame:
    """Columns by place, the last one as ``fp``: stored tables then allow any name in the input."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns) - 1)], "fp")


def keep_one(docs: DataFrame, run: RunFolder, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The documents with one of each group left: that of the smallest id, null ids last.

    Equal ids are told apart by their place in the input as stored, so exactly
    one row of a group stays even where whole rows repeat.
    """
    names = docs.columns
    stored = run.keep(docs.toDF(*[f"d{i}" for i in range(len(names))]).withColumn("row", F.monotonically_increasing_id()), "documents")
    of, text = f"d{names.index(id_col)}", f"d{names.index(text_col)}"
    grouped = near_duplicates(stored.select("row", F.col(of).alias("id"), F.col(text).alias("text")), run, "row", "text", shingle, radius)
    grouped = run.keep(grouped.select("row", "id", "component_id"), "groups")
    best = grouped.groupBy("component_id").agg(F.min_by("row", F.struct(F.col("id").isNull(), "id", "row")).alias("row"))
    kept = stored.join(best.select("row"), "row", "left_semi")
    return kept.select(*[F.col(f"d{i}").alias(name) for i, name in enumerate(names)])
