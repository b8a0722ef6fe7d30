"""Alignment of two tokenizers over the same bytes: a byte-level one (A) and a SentencePiece one (B).

Both read a text with a blank before it.  Intervals are coalesced: the byte
ranges of all A and B tokens are sorted by start, a running maximum of their
ends is kept, and a group ends where the next start reaches it, which is where a
token of A and one of B end together.  Inside a group every A token is linked to
the B tokens whose bytes it shares.

A blank between two characters that are no white space always begins a token of
A, and no piece of B holds a blank after another character, so both sides and
all groups break there.  The stretches between such blanks are aligned once for
each worker (a bounded cache) and a text is the sum of its stretches.  A text with
a stretch that either tokenizer does not give back byte for byte is compared and
aligned as a whole.

How many documents link a pair of ids, and which pairs are the most frequent of
their A id, are counts over the whole corpus.  Documents travel in blocks of a
few megabytes: a block names each of its different pairs once, with the number
of its documents, and gets back one count and one flag for it, so a pair that
all documents hold is one row a block.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from drayline.session import RunFolder

BLOCK_BYTES = 4 << 20
LOT_BYTES = 1 << 20
#: Stretches and characters that one generation of a worker's cache holds.
CACHED_STRETCHES = 300_000
CACHED_CHARS = 4 << 20
STRETCHES_AT_A_TIME = 1500
#: A blank that surely ends a token on both sides.
_PLAIN_BLANK = re.compile(r"(?<=\S) (?=\S)")
#: White space beside the blank.
_WHITE = [c for c in map(chr, range(0x3001)) if c.isspace() and c != " "]
#: Letters and signs that every regular expression library puts into the same classes.
_COMMON = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
_DIGITS = 10 ** np.arange(1, 10)
COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: itself where printable, else one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def intervals_to_groups(start: np.ndarray, end: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order by start (A before B) and the group number of each token in that order."""
    order = np.lexsort((kind, start))
    reach = np.maximum.accumulate(end[order])
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = start[order][1:] >= reach[:-1]
    return order, np.cumsum(fresh) - 1


def overlaps(a_start: np.ndarray, a_end: np.ndarray, b_start: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in A and in B of all pairs that share bytes; both sides tile the same range."""
    low = np.searchsorted(b_end, a_start, side="right")
    many = np.searchsorted(b_start, a_end, side="left") - low
    left = np.repeat(np.arange(len(a_start)), many)
    within = np.arange(len(left)) - np.repeat(np.cumsum(many) - many, many)
    return left, np.repeat(low, many) + within


#: A stretch or a whole text in one object: token, group and link counts (int32), the id pairs of its links (int64, A id
#: in the upper half), its groups as text.
Aligned = bytes


def unpack(made: Aligned) -> tuple[tuple[int, ...], bytes, bytes]:
    """Counts, links and groups."""
    counts = struct.unpack_from("<4i", made)
    cut = 16 + 8 * counts[3]
    return counts, made[16:cut], made[cut:]


def plain_stretches(text: str) -> list[str]:
    """A text cut at its plain blanks, which are left out; every stretch stands for itself with a blank before it."""
    stretches = text.split(" ")
    other = "" in stretches or any(f"{c} " in text or f" {c}" in text for c in _WHITE if c in text)
    return _PLAIN_BLANK.split(text) if other else stretches


def _different(values: np.ndarray) -> np.ndarray:
    """Sorted different values; the sort is faster than the hash table of ``np.unique``."""
    values = np.sort(values)
    fresh = np.ones(len(values), dtype=bool)
    fresh[1:] = values[1:] != values[:-1]
    return values[fresh]


class Aligner:
    """Aligned stretches of texts, from two vocabulary files."""

    def __init__(self, byte_level: str, pieces: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_level)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        alphabet = byte_alphabet()
        by_id = {i: token for token, i in self.a.get_vocab(with_added_tokens=True).items()}
        tokens = [by_id.get(i, "") for i in range(max(by_id) + 1)]
        self.a_bytes = [bytes(alphabet[c] for c in t) if all(c in alphabet for c in t) else t.encode() for t in tokens]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in ((i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))
        ]
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in side], dtype=np.int64) for side in (self.a_bytes, self.b_bytes))
        self.width = max(len(self.a_bytes), len(self.b_bytes))
        self.signs = [b"%d%b" % (i, sign) for sign in (b",", b"|", b";") for i in range(self.width)]
        self.ranked = self._ranked(byte_level)
        self.known: dict[str, Aligned | None] = {}
        self.elder: dict[str, Aligned | None] = {}
        self.odd: set[str] = set()  # stretches whose bytes are not given back
        self.held = 0

    def _ranked(self, byte_level: str):
        """The same vocabulary for a faster library, which merges by rank; ``None`` unless ids and merges are in one order."""
        import tiktoken

        with open(byte_level, encoding="utf-8") as file:
            told = json.load(file)
        model, splitter = told["model"], told.get("pre_tokenizer") or {}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", ())]
        usual = splitter.get("type") == "ByteLevel" and splitter.get("use_regex", True) and not splitter.get("add_prefix_space")
        in_order = all(model["vocab"].get("".join(m)) == 256 + i for i, m in enumerate(merges))
        if model["type"] != "BPE" or told.get("normalizer") or not usual or not in_order or model.get("ignore_merges"):
            return None
        ranks = {self.a_bytes[i]: i for i in model["vocab"].values() if i < 256 + len(merges)}
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"  # fixed value of byte-level splitting
        return tiktoken.Encoding("ranked", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def _tokens(self, text: str, raw: bytes, common: bool) -> tuple[list[int], list[int]] | None:
        """Ids of both sides for a text with its leading blank; ``None`` where the bytes are not given back."""
        a = self.ranked.encode_ordinary(text) if common else self.a.encode(text, add_special_tokens=False).ids
        b = self.b.encode(text[1:], num_threads=1)
        if b"".join([self.a_bytes[i] for i in a]) != raw or b"".join([self.b_bytes[i] for i in b]) != raw:
            return None
        return a, b

    def align(self, stretches: list[str]) -> list[Aligned | None]:
        """Each stretch by itself, a blank before it; ``None`` where the bytes are not given back.

        Stretches that begin and end without white space stay apart when they
        are joined by blanks, so a lot of them is tokenised in one call.
        """
        out: list[Aligned | None] = [None] * len(stretches)
        common = [bool(self.ranked and _COMMON.fullmatch(c)) for c in stretches]
        joins = [k or bool(c) and not c[0].isspace() and not c[-1].isspace() for k, c in zip(common, stretches, strict=True)]
        lots = [[i for i, (k, j) in enumerate(zip(common, joins, strict=True)) if j and k == kind] for kind in (True, False)]
        alone = [i for i, j in enumerate(joins) if not j]
        for lot, kind in zip(lots, (True, False), strict=True):
            made = self._coalesce([stretches[i] for i in lot], kind) if lot else []
            if made is None:
                alone += lot
            else:
                for i, x in zip(lot, made, strict=True):
                    out[i] = x
        for i in alone:
            made = self._coalesce([stretches[i]], False)
            out[i] = made[0] if made else None
        return out

    def _coalesce(self, stretches: list[str], common: bool) -> list[Aligned] | None:
        """Groups and links of stretches side by side; ``None`` if the bytes of their tokens differ from theirs."""
        text = " " + " ".join(stretches)
        raw = text.encode()
        both = self._tokens(text, raw, common)
        if both is None:
            return None
        a, b = (np.array(x, dtype=np.int64) for x in both)
        a_end, b_end = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        a_start, b_start = a_end - self.a_sizes[a], b_end - self.b_sizes[b]
        start, end = np.concatenate([a_start, b_start]), np.concatenate([a_end, b_end])
        kind = np.repeat(np.array([0, 1], dtype=np.int8), [len(a), len(b)])
        order, group = intervals_to_groups(start, end, kind)
        # Inside a group all A ids, then all B ids, each in their order.
        start, kind, ids = start[order], kind[order], np.concatenate([a, b])[order]
        by_side = np.argsort(2 * group + kind, kind="stable")
        start, kind, ids, group = start[by_side], kind[by_side], ids[by_side], group[by_side]
        sign = np.zeros(len(ids), dtype=np.int64)
        sign[:-1] = np.where(np.diff(group) != 0, 2, np.diff(kind) != 0)
        told = b"".join(map(self.signs.__getitem__, (ids + sign * self.width).tolist()))
        written = np.concatenate([[0], np.cumsum(_DIGITS.searchsorted(ids, side="right") + 2)])
        left, right = overlaps(a_start, a_end, b_start, b_end)
        links = ((a[left] << 32) | b[right]).tobytes()
        # A stretch begins where a group and tokens of both sides do.
        sizes = np.fromiter((len(c.encode()) + 1 for c in stretches), dtype=np.int64, count=len(stretches))
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        a_cut, b_cut = (np.searchsorted(s, bounds) for s in (a_start, b_start))
        first = np.flatnonzero(np.diff(group, prepend=-1))
        g_cut = np.searchsorted(start[first], bounds)
        t_cut = written[np.append(first, len(ids))[g_cut]]
        l_cut = np.searchsorted(left, a_cut)
        counts = np.diff(np.stack([a_cut, b_cut, g_cut, l_cut], axis=1), axis=0).astype("<i4").tobytes()
        spans = zip(t_cut[:-1].tolist(), (t_cut[1:] - 1).tolist(), (8 * l_cut[:-1]).tolist(), (8 * l_cut[1:]).tolist(), strict=True)
        return [counts[16 * i : 16 * i + 16] + links[u:v] + told[p:q] for i, (p, q, u, v) in enumerate(spans)]

    def learn(self, stretches: set[str]) -> None:
        """Make ``known`` hold all these stretches."""
        if len(self.known) > CACHED_STRETCHES or self.held > CACHED_CHARS:
            self.elder, self.known, self.odd, self.held = self.known, {}, set(), 0
        new = stretches.difference(self.known)
        again = self.elder.keys() & new
        self.known.update((c, self.elder[c]) for c in again)
        unseen = list(new - again)
        for at in range(0, len(unseen), STRETCHES_AT_A_TIME):
            part = unseen[at : at + STRETCHES_AT_A_TIME]
            self.known.update(zip(part, self.align(part), strict=True))
        self.odd.update(c for c in new if self.known[c] is None)
        self.held += sum(map(len, new))

    def stretches(self, texts: list[str]) -> list[list[str]]:
        """The stretches of each text, all in ``known``; none for empty texts and those that do not align."""
        split = [plain_stretches(t) if t else [] for t in texts]
        self.learn(set().union(*split))
        if self.odd:
            for i, parts in enumerate(split):
                if not self.odd.isdisjoint(parts):  # as a whole: what one stretch lacks another may hold
                    self.known[texts[i]] = self.align([texts[i]])[0]
                    split[i] = [] if self.known[texts[i]] is None else [texts[i]]
        return split


@functools.cache
def aligner(byte_level: str, pieces: str) -> Aligner:
    """One for each pair of vocabularies and worker."""
    return Aligner(byte_level, pieces)


def _block_schema(rest: T.StructType, want_groups: bool) -> T.StructType:
    told = [T.StructField("groups", T.ArrayType(T.StringType()))] if want_groups else []
    return T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("rest", T.ArrayType(rest)),
            T.StructField("counts", T.BinaryType()),  # int64, the four counts of each document
            T.StructField("digests", T.ArrayType(T.StringType())),
            *told,
            T.StructField("ends", T.BinaryType()),  # int64, where each document's stretches end in codes
            T.StructField("codes", T.BinaryType()),  # int32, the stretches of all documents
            T.StructField("link_ends", T.BinaryType()),  # int64, where each stretch's links end
            T.StructField("links", T.BinaryType()),  # int32, places in pairs
            T.StructField("pairs", T.ArrayType(T.LongType())),
            T.StructField("holders", T.ArrayType(T.LongType())),  # documents of the block that hold the pair
        ]
    )


def _in_blocks(docs: DataFrame, text_col: str, byte_level: str, pieces: str, want_groups: bool) -> DataFrame:
    """Aligned documents in blocks; columns beside the text by place."""
    at = docs.columns.index(text_col)
    others = [i for i in range(len(docs.columns)) if i != at]
    rest = T.StructType([T.StructField(f"c{i}", docs.schema[i].dataType) for i in others] or [T.StructField("none", T.IntegerType())])
    schema = _block_schema(rest, want_groups)
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    plain = plain.select(F.col(f"c{at}").cast("string").alias("text"), *[f"c{i}" for i in others])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = aligner(byte_level, pieces)
        number = TaskContext.get().partitionId() << 32
        place: dict[str, int] = {}
        stretches: list[tuple[tuple[int, ...], bytes, bytes]] = []
        codes, digests, told, rows, held = [], [], [], [], 0

        def flush() -> pa.RecordBatch:
            raw = np.frombuffer(b"".join([s[1] for s in stretches]), dtype=np.int64)
            link_ends = np.cumsum([s[0][3] for s in stretches], dtype=np.int64)
            pairs, links = np.unique(raw, return_inverse=True)
            sizes = np.fromiter(map(len, codes), dtype=np.int64, count=len(codes))
            flat, ends = np.concatenate([np.zeros(0, np.int32), *codes]), np.cumsum(sizes)
            each = np.array([s[0] for s in stretches], dtype=np.int64).reshape(-1, 4)
            along = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(each[flat], axis=0)])
            counts = np.diff(along[ends], axis=0, prepend=np.zeros((1, 4), np.int64))
            # Documents that hold a pair: different stretches of a document first, then their different pairs.
            held_once = _different(np.repeat(np.arange(len(sizes)), sizes) * max(1, len(stretches)) + flat)
            doc, code = np.divmod(held_once, max(1, len(stretches)))
            many = np.diff(link_ends, prepend=0)
            span = np.repeat(link_ends[code] - np.cumsum(many[code]), many[code]) + np.arange(int(many[code].sum()))
            both = _different(np.repeat(doc, many[code]) * max(1, len(pairs)) + links[span])
            holders = np.bincount(both % max(1, len(pairs)), minlength=len(pairs))
            columns = [
                pa.array([number], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, len(sizes)], pa.int32()), pa.concat_arrays(rows)),
                pa.array([counts.tobytes()], pa.binary()),
                pa.array([digests], pa.list_(pa.string())),
                *([pa.array([told], pa.list_(pa.string()))] if want_groups else []),
                pa.array([ends.tobytes()], pa.binary()),
                pa.array([flat.tobytes()], pa.binary()),
                pa.array([link_ends.tobytes()], pa.binary()),
                pa.array([links.astype(np.int32).tobytes()], pa.binary()),
                pa.array([pairs], pa.list_(pa.int64())),
                pa.array([holders], pa.list_(pa.int64())),
            ]
            return pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema])

        for batch in batches:
            texts = ["" if t is None else t for t in batch.column(0).to_pylist()]
            fields = [batch.column(i) for i in range(1, batch.num_columns)]
            names = [f.name for f in rest]
            whole = pa.StructArray.from_arrays(fields or [pa.nulls(batch.num_rows, pa.int32())], names)
            a = 0
            while a < len(texts):
                b, size = a, 0
                while b < len(texts) and (b == a or size < min(LOT_BYTES, BLOCK_BYTES - held)):
                    size += len(texts[b])
                    b += 1
                held += size
                rows.append(whole.slice(a, b - a))
                for parts in align.stretches(texts[a:b]):
                    for c in set(parts).difference(place):
                        place[c] = len(stretches)
                        stretches.append(unpack(align.known[c]))
                    mine = list(map(place.__getitem__, parts))
                    groups = b";".join([stretches[k][2] for k in mine])
                    codes.append(np.array(mine, dtype=np.int32))
                    digests.append(hashlib.sha256(groups).hexdigest() if mine else "")
                    if want_groups:
                        told.append(groups.decode())
                a = b
                if held >= BLOCK_BYTES:
                    yield flush()
                    number, held, place, stretches = number + 1, 0, {}, []
                    codes, digests, told, rows = [], [], [], []
        if rows:
            yield flush()

    return plain.mapInArrow(pack, schema)


def align_tokens(
    docs: DataFrame,
    run: RunFolder,
    byte_level: str,
    pieces: str,
    text_col: str = "text",
    want_groups: bool = False,
) -> DataFrame:
    """One row a document: the input's columns beside the text, ``n_a``, ``n_b`` (tokens), ``n_groups``, ``n_links``,
    ``n_best`` (links whose pair no other pair of the same A id exceeds in documents), ``count_sum`` (documents of
    the pair, added over the links), ``groups_sha256`` and with ``want_groups`` ``groups`` (``a1,a2|b1;a3|b2,b3``).

    ``byte_level`` is a tokenizers file of a byte-level vocabulary, ``pieces``
    a SentencePiece model with byte fallback that puts a blank before a text.
    Null and empty texts, and texts whose tokens of either side do not give
    back their bytes, have no tokens: zeros and empty strings.  Special tokens
    inside a text are plain text.  Rows are documents, repeated ids and rows
    too.  A very long text is one document of a block of its own, held by one
    task as a whole.  An empty table gives an empty result; input columns named
    like a result column are left out.
    """
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = _in_blocks(docs, text_col, byte_level, pieces, want_groups)
    blocks = run.keep_bucketed(packed, "aligned", "block", buckets)

    named = blocks.select(F.explode(F.arrays_zip("pairs", "holders")).alias("x")).select("x.pairs", "x.holders")
    counted = named.groupBy(F.col("pairs").alias("pair")).agg(F.sum("holders").alias("n"))
    counted = run.keep(counted.withColumn("a", F.shiftright("pair", 32)), "pairs")
    most = counted.groupBy("a").agg(F.max("n").alias("most"))
    judged = counted.join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    asked = blocks.select("block", F.posexplode("pairs").alias("at", "pair"))
    reply = asked.join(judged, "pair").groupBy("block").agg(
        F.collect_list("at").alias("at"), F.collect_list("n").alias("n"), F.collect_list("best").alias("best")
    )

    fields = list(blocks.schema["rest"].dataType.elementType)
    numbers = [*COUNTS, "n_best", "count_sum"]
    texts = ["groups_sha256", *(["groups"] if want_groups else [])]
    schema = T.StructType([*fields, *[T.StructField(f"m{i}", T.LongType()) for i in range(6)], *[T.StructField(f"t{i}", T.StringType()) for i in range(len(texts))]])
    wanted = ["rest", "counts", "digests", *(["groups"] if want_groups else []), "ends", "codes", "link_ends", "links"]

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = {name: i for i, name in enumerate(batch.schema.names)}
            for i in range(batch.num_rows):
                cell = lambda name: batch.column(place[name])[i]  # noqa: B023, E731
                raw = lambda name, kind: np.frombuffer(cell(name).as_buffer(), dtype=kind)  # noqa: B023, E731
                counts, ends, codes = raw("counts", np.int64).reshape(-1, 4), raw("ends", np.int64), raw("codes", np.int32)
                link_ends, links = raw("link_ends", np.int64), raw("links", np.int32)
                at = cell("at").values
                total, best = np.zeros(0 if at is None else len(at), np.int64), np.zeros(0 if at is None else len(at), np.int64)
                if at is not None:
                    at = at.to_numpy(zero_copy_only=False)
                    total[at] = cell("n").values.to_numpy(zero_copy_only=False)
                    best[at] = cell("best").values.to_numpy(zero_copy_only=False)
                added = []
                for value in (best, total):
                    along = np.concatenate([[0], np.cumsum(value[links])])
                    by_stretch = np.diff(along[link_ends], prepend=0)
                    summed = np.concatenate([[0], np.cumsum(by_stretch[codes])])
                    added.append(np.diff(summed[ends], prepend=0))
                rest = cell("rest").values
                columns = [*rest.flatten(), *[pa.array(counts[:, k]) for k in range(4)], *[pa.array(x, pa.int64()) for x in added]]
                columns += [cell(name).values for name in ("digests", *(["groups"] if want_groups else []))]
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema])

    told = blocks.select("block", *wanted).join(reply, "block", "left").select(*wanted, "at", "n", "best").mapInArrow(tell, schema)
    at = docs.columns.index(text_col)
    kept = [F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns) if i != at and c not in (*numbers, *texts)]
    made = [F.col(f"m{i}").alias(c) for i, c in enumerate(numbers)] + [F.col(f"t{i}").alias(c) for i, c in enumerate(texts)]
    return told.select(*kept, *made)
