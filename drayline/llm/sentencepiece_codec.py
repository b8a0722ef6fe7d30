"""SentencePiece encoding and decoding by a streaming Viterbi search.

Among all ways to cut a normalised text into pieces the one of largest total
score is taken; of equal ones that whose last piece starts first.  The search
moves over the text once and keeps only the positions that a piece can still
reach back to, at most the longest piece's length.  Now and then it follows the
back pointers of all positions in that window; where they converge on one
boundary, no later text can change what lies before it, so the ids up to there
are committed and forgotten.  Memory does not grow with the text.

A boundary between two characters that no piece has side by side is such a
point of convergence at sight.  Texts are cut there first (before a word mark
that follows another character), and a worker keeps the ids of the stretches it
has seen, in two generations; the cache is bounded and changes the speed only.

Scores are those of the model file, whatever its training method.  A unigram
model's own encoder searches for the same maximum; the merges of a BPE model
follow another rule and may cut some words differently.  Decoding does not
depend on the cut.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Positions between two looks for a convergence.
LOOK_EVERY = 64
#: Of one generation of the cache.
CACHED_STRETCHES = 250_000
CACHED_CHARS = 16 << 20


class Codec:
    """One model: its pieces, the search and the way back."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.processor = p = SentencePieceProcessor(model_file=path)
        ids = range(p.get_piece_size())
        plain = [i for i in ids if not (p.is_control(i) or p.is_unknown(i) or p.is_unused(i) or p.is_byte(i))]
        self.pieces = {p.id_to_piece(i): (p.get_score(i), i) for i in plain}
        self.tree: list = [{}, None]  # a node: what follows by character, and the score of the piece that ends here
        for piece, (score, _) in self.pieces.items():
            node = self.tree
            for sign in piece:
                node = node[0].setdefault(sign, [{}, None])
            node[1] = score
        self.longest = max(map(len, self.pieces), default=1)
        self.unknown = min((s for s, _ in self.pieces.values()), default=0.0) - UNKNOWN_PENALTY
        self.bytes = {int(p.id_to_piece(i)[1:-1], 16): i for i in ids if p.is_byte(i)}
        self.unk = p.unk_id()
        self.raw = [p.id_to_piece(i).replace(MARK, " ").encode() for i in ids]
        for value, i in self.bytes.items():
            self.raw[i] = bytes([value])
        for i in ids:
            if p.is_control(i):
                self.raw[i] = b""
        self.raw[self.unk] = " ⁇ ".encode()
        self.prefixed = p.normalize("x").startswith(MARK)
        inner = any(a != MARK and b == MARK for piece in self.pieces for a, b in zip(piece, piece[1:], strict=False))
        self.stretch = re.compile(r"(?s).+" if inner else f"{MARK}*[^{MARK}]+|{MARK}+")
        self.known: dict[str, bytes] = {}
        self.elder: dict[str, bytes] = {}
        self.held = 0

    def search(self, text: str) -> list[int]:
        """Ids of a normalised text."""
        tree, unknown, longest = self.tree, self.unknown, self.longest
        out: list[int] = []
        size, base = len(text), 0
        room = min(size, LOOK_EVERY + longest) + 1
        score: list[float | None] = [0.0, *[None] * (room - 1)]  # of positions base, base + 1, ...
        back: list[int] = [0] * room
        at = 0
        while at < size:
            here = score[at - base]
            missing = min(longest, size - at) + at - base + 1 - len(score)
            if missing > 0:
                score += [None] * missing
                back += [0] * missing
            place, node, end = at - base, tree, at
            while end < size:
                node = node[0].get(text[end])
                if node is None:
                    break
                end += 1
                place += 1
                if node[1] is not None:
                    total = here + node[1]
                    if score[place] is None or total > score[place]:
                        score[place], back[place] = total, at
            if text[at] not in self.pieces:
                total, place = here + unknown, at + 1 - base
                if score[place] is None or total > score[place]:
                    score[place], back[place] = total, at
            at += 1
            if at % LOOK_EVERY == 0 and at < size:
                meet = self._convergence(score, back, base, at)
                if meet > base:
                    out += self._path(text, back, base, meet)
                    score, back, base = score[meet - base :], back[meet - base :], meet
        return out + self._path(text, back, base, size)

    @staticmethod
    def _convergence(score: list[float | None], back: list[int], base: int, at: int) -> int:
        """The last boundary that the best paths to all reached positions from ``at`` on have in common."""
        ends = {p for p in range(at, base + len(score)) if score[p - base] is not None}
        while len(ends) > 1:
            last = max(ends)
            ends.remove(last)
            ends.add(back[last - base])
        return ends.pop()

    def _path(self, text: str, back: list[int], base: int, end: int) -> list[int]:
        out: list[int] = []
        while end > base:
            begin = back[end - base]
            part = text[begin:end]
            if part in self.pieces:
                out.append(self.pieces[part][1])
            elif self.bytes:
                out += [self.bytes[b] for b in reversed(part.encode("utf-8", "surrogatepass"))]
            else:
                out.append(self.unk)
            end = begin
        out.reverse()
        return out

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if len(self.known) > CACHED_STRETCHES or self.held > CACHED_CHARS:
            self.elder, self.known, self.held = self.known, {}, 0
        known, out = self.known, []
        for stretch in self.stretch.findall(self.processor.normalize(text)):
            ids = known.get(stretch)
            if ids is None:
                ids = self.elder.get(stretch)
                if ids is None:
                    ids = np.array(self.search(stretch), dtype="<u4").tobytes()
                known[stretch] = ids
                self.held += len(stretch)
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        text = b"".join(map(self.raw.__getitem__, np.frombuffer(ids, dtype="<u4").tolist())).decode("utf-8", "replace")
        return text[1:] if self.prefixed and text.startswith(" ") else text


@functools.cache
def codec(path: str) -> Codec:
    """One codec for each model and worker."""
    return Codec(path)


def encode_documents(docs: DataFrame, model: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """The input's columns and ``ids_col`` (little-endian 32-bit integers; null for a null text, empty for an empty one).

    Rows are encoded alone: repeated rows get equal ids, an empty table gives
    an empty result.  An input column named like the result is replaced.
    """
    return _apply(docs, text_col, ids_col, T.BinaryType(), pa.binary(), lambda cells: [None if c is None else codec(model).encode(c) for c in cells])


def decode_documents(docs: DataFrame, model: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """The input's columns and the text of the ids, null for null."""
    return _apply(docs, ids_col, text_col, T.StringType(), pa.string(), lambda cells: [None if c is None else codec(model).decode(c) for c in cells])


def _apply(docs: DataFrame, source: str, target: str, kind: T.DataType, arrow: pa.DataType, function) -> DataFrame:
    at = docs.columns.index(source)
    names = [(i, c) for i, c in enumerate(docs.columns) if c != target]
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    schema = T.StructType([*plain.schema.fields, T.StructField("made", kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array(function(batch.column(at).to_pylist()), arrow)
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names=[f.name for f in schema])

    return plain.mapInArrow(run, schema).select(*[F.col(f"c{i}").alias(c) for i, c in names], F.col("made").alias(target))


def round_trip(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode each whole text in one pass: the id, counts and check sums of ids and text, and whether the text came back.

    A null text counts as empty.  A text that holds the word mark itself comes
    back with a space in its place, as the model format has it.
    """
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    fields = [("n_tokens", "long"), ("ids_crc32", "long"), ("text_crc32", "long"), ("same_text", "boolean")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(model)
        for batch in batches:
            texts = ["" if t is None else t for t in batch.column(1).to_pylist()]
            ids = [tool.encode(t) for t in texts]
            back = [tool.decode(i) for i in ids]
            columns = [
                batch.column(0),
                pa.array([len(i) // 4 for i in ids], pa.int64()),
                pa.array([zlib.crc32(i) for i in ids], pa.int64()),
                pa.array([zlib.crc32(b.encode()) for b in back], pa.int64()),
                pa.array([a == b for a, b in zip(texts, back, strict=True)], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["id", *[n for n, _ in fields]])

    kind = plain.schema["id"].dataType.simpleString()
    made = plain.mapInArrow(run, f"id {kind}, " + ", ".join(f"{n} {t}" for n, t in fields))
    return made.withColumnRenamed("id", id_col)
