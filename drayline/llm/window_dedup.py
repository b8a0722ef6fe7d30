"""Substring deduplication: words covered by a window that an earlier document has too.

Method: super-k-mer partitioning.  Consecutive windows of one document that
share a minimiser (the least-named run of ``gram`` words in each) travel as one
packed string to the bucket of that minimiser.  Equal windows have equal
minimisers, so they meet in one bucket, where the windows are cut again, sorted
and counted exactly, word by word.

* A first exchange (see ``blocks``) counts minimisers; windows whose minimiser
  occurs once cannot repeat and are never packed.
* Equal packed strings of a block travel once, for the smallest id among them.
* A minimiser that occurs more than ``hot_above`` times would fill one bucket
  with different strings around one common passage.  Its windows are packed
  singly and go to the bucket of the whole window, so only equal windows meet;
  those travel once a block.  The results are the same.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from drayline.llm.blocks import HOT, Block, flags_of, range_count, read_blocks, repeated_names, with_reply, write_blocks
from drayline.llm.names import SPACES, gram_names, heads, sampled, spread, window_mask, word_values, words_of
from drayline.session import RunFolder

WINDOW = 50
GRAM = 20
HOT_ABOVE = 2000
#: Stands for a null id: after all others.
LAST = np.iinfo(np.int64).max


class Words:
    """The words of a block and the documents they belong to."""

    def __init__(self, block: Block):
        self.block = block
        self.starts, self.ends = words_of(block.data, block.starts)
        self.first = np.searchsorted(self.starts, block.starts)
        self.last = np.append(self.first[1:], len(self.starts))
        self.values = word_values(block.data, self.starts, self.ends)

    def samples(self, gram: int, window: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Window starts and the name of each window's minimiser with the place of it."""
        n = len(self.values)
        valid = window_mask(self.first, self.last, window, n)
        for begin, names, starts, picked in sampled(lambda a, b: self.values[a:b], n, gram, window, valid):
            yield starts + begin, picked + begin, spread(names[picked])

    def joined(self) -> tuple[bytes, np.ndarray, np.ndarray]:
        """All words joined by one space, and where each begins and ends there."""
        lengths = self.ends - self.starts
        ends = np.cumsum(lengths + 1) - 1
        out = np.full(int(ends[-1]) + 1 if len(ends) else 0, 32, dtype=np.uint8)
        inside = np.ones(len(out), dtype=bool)
        inside[ends] = False
        out[inside] = self.block.data[~SPACES[self.block.data]]
        return out.tobytes(), ends - lengths, ends


def _minimisers(block: Block, gram: int, window: int) -> np.ndarray:
    parts = [names[heads(picked)] for _, picked, names in Words(block).samples(gram, window)]
    return np.concatenate(parts) if parts else np.empty(0, dtype=np.uint64)


def _packed(words: Words, codes: np.ndarray, gram: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last window of each packed string and the name that decides its bucket."""
    chunks = list(words.samples(gram, window))
    if not chunks:
        return (np.empty(0, dtype=np.int64),) * 2 + (np.empty(0, dtype=np.uint64),)
    runs = [heads(picked) for _, picked, _ in chunks]
    names = np.concatenate([names[first] for (_, _, names), first in zip(chunks, runs, strict=True)])
    begins = np.concatenate([starts[first] for (starts, _, _), first in zip(chunks, runs, strict=True)])
    lengths = np.concatenate([np.diff(np.append(first, len(starts))) for (starts, _, _), first in zip(chunks, runs, strict=True)])
    code = flags_of(names, codes)
    keep, hot = (code > 0) & (code < HOT), code == HOT
    begin, end, name = begins[keep], begins[keep] + lengths[keep], names[keep]
    if hot.any():
        single = np.repeat(begins[hot], lengths[hot]) + np.arange(lengths[hot].sum()) - np.repeat(np.cumsum(lengths[hot]) - lengths[hot], lengths[hot])
        whole = _whole_names(words.values, single, window)
        begin, end, name = np.append(begin, single), np.append(end, single + 1), np.append(name, whole)
    return begin, end, name


def _whole_names(values: np.ndarray, starts: np.ndarray, window: int) -> np.ndarray:
    return gram_names(values, window)[starts]


def _collapsed(words: Words, ids: np.ndarray, begin: np.ndarray, end: np.ndarray, name: np.ndarray, buckets: int, window: int):
    """For each bucket of a block its distinct strings, their smallest ids, and which string each packed run is."""
    owner = np.searchsorted(words.last, begin, side="right")
    place = ((name >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    raw, firsts, lasts = words.joined()
    order = np.lexsort((begin, place))
    of, cuts = place[order], np.append(heads(place[order]), len(order))
    first, last = firsts[begin].tolist(), lasts[end + window - 2].tolist()
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        known: dict[bytes, int] = {}
        which = np.array([known.setdefault(raw[first[i] : last[i]], len(known)) for i in order[a:b].tolist()], dtype=np.int64)
        least = np.full(len(known), LAST, dtype=np.int64)
        np.minimum.at(least, which, ids[owner[order[a:b]]])
        yield int(of[a]), order[a:b], which, list(known), least


def _least_holders(blob: bytes, ids: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of the strings (one a line) the smallest id that has it; and the windows of each string."""
    data = np.frombuffer(blob, dtype=np.uint8)
    begins, ends = words_of(data, np.zeros(1, dtype=np.int64))
    first = np.searchsorted(begins, np.concatenate([[0], np.flatnonzero(data == 10) + 1]))
    windows = np.diff(np.append(first, len(begins))) - window + 1
    starts = np.repeat(first, windows) + np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    holder = np.repeat(ids, windows)
    names = gram_names(word_values(data, begins, ends), window)[starts]
    order = np.argsort(names, kind="stable")
    groups = heads(names[order])
    spans = list(zip(begins[starts].tolist(), ends[starts + window - 1].tolist(), strict=True))
    again = np.ones(len(order), dtype=bool)
    again[groups] = False
    for k in np.flatnonzero(again).tolist():  # windows of one name must agree in every byte
        (a, b), (c, d) = spans[order[k - 1]], spans[order[k]]
        if blob[a:b] != blob[c:d]:
            order = np.array(sorted(range(len(spans)), key=lambda i: blob[spans[i][0] : spans[i][1]]), dtype=np.int64)
            texts = [blob[a:b] for a, b in (spans[i] for i in order.tolist())]
            groups = np.array([i for i in range(len(texts)) if not i or texts[i] != texts[i - 1]], dtype=np.int64)
            break
    out = np.empty(len(order), dtype=np.int64)
    out[order] = np.repeat(np.minimum.reduceat(holder[order], groups), np.diff(np.append(groups, len(order))))
    return out, windows


def _ids(block: Block, at: int) -> np.ndarray:
    column = block.rest.field(at)
    return np.where(column.is_null().to_numpy(zero_copy_only=False), LAST, column.fill_null(0).to_numpy(zero_copy_only=False)).astype(np.int64)


def repeated_windows(
    docs: DataFrame,
    run: RunFolder,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    hot_above: int = HOT_ABOVE,
    want_text: bool = True,
) -> DataFrame:
    """Remove each word covered by a window of ``window`` words that also starts in a document of smaller id.

    Words are separated by spaces and the bytes 9 to 13 and compared as they
    are; windows stay inside one document and are judged on the input.

    Result: the input's columns beside the text, then ``n_words``,
    ``n_removed``, ``kept_sha256`` (hex, of the kept words joined by one space)
    and with ``want_text`` ``kept`` (null for a null text).  An input column of
    one of these names is left out.

    ``id_col`` is an integer.  A null id comes after all others; equal ids are
    not smaller than one another, so repeated rows leave each other alone.
    Null, empty and short texts lose nothing.  An empty table gives an empty
    result.
    """
    blocks, _ = write_blocks(docs, text_col, run)
    others = [c for c in docs.columns if c != text_col]
    at = others.index(id_col)
    ranges = range_count(blocks)
    reply = run.keep(repeated_names(blocks, lambda block, _: _minimisers(block, gram, window), ranges, hot_above=hot_above), "minimisers")
    known = with_reply(blocks, reply, 0)

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, codes in read_blocks(batches, 1):
            words = Words(block)
            begin, end, name = _packed(words, codes[0], gram, window)
            for bucket, _, _, strings, least in _collapsed(words, _ids(block, at), begin, end, name, ranges, window):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([bucket], pa.int64()),
                        pa.array([block.number], pa.int64()),
                        pa.array([b"\n".join(strings)], pa.binary()),
                        pa.array([least.tobytes()], pa.binary()),
                    ],
                    names=["part", "block", "strings", "ids"],
                )

    def count(table: pa.Table) -> pa.Table:
        strings = [x.as_py() for x in table.column("strings")]
        ids = np.concatenate([np.frombuffer(x.as_buffer(), dtype=np.int64) for x in table.column("ids")])
        counts = [y.as_buffer().size // 8 for y in table.column("ids")]
        least, windows = _least_holders(b"\n".join(strings), ids, window)
        flags = (least < np.repeat(ids, windows)).astype(np.uint8)
        cuts = np.concatenate([[0], np.cumsum(windows)])[np.cumsum([0, *counts])]
        return pa.table(
            {
                "part": table.column("part"),
                "block": table.column("block"),
                "codes": pa.array([flags[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()),
            }
        )

    scattered = known.select("block", "rest", "ends", "nulls", "data", "r0").mapInArrow(
        scatter, "part long, block long, strings binary, ids binary"
    )
    counted = scattered.groupBy("part").applyInArrow(count, "part long, block long, codes binary")
    answer = counted.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("part", "codes"))).alias("reply"))
    known = with_reply(known, run.keep(answer, "windows"), 1)

    fields = [("n_words", T.LongType()), ("n_removed", T.LongType()), ("kept_sha256", T.StringType())]
    if want_text:
        fields.append(("kept", T.StringType()))
    rest_type = blocks.schema["rest"].dataType.elementType
    schema = T.StructType([T.StructField("rest", rest_type), *[T.StructField(f"o{i}", t) for i, (_, t) in enumerate(fields)]])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, codes in read_blocks(batches, 2):
            words = Words(block)
            begin, end, name = _packed(words, codes[0], gram, window)
            ids = _ids(block, at)
            hit, offset = np.zeros(len(words.values) + 1, dtype=np.int32), 0
            for _, runs, which, strings, least in _collapsed(words, ids, begin, end, name, ranges, window):
                counts = np.empty(len(strings), dtype=np.int64)
                counts[which] = (end - begin)[runs]
                base = offset + np.cumsum(counts) - counts
                offset += int(counts.sum())
                lengths = (end - begin)[runs]
                inside = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
                flag = codes[1][np.repeat(base[which], lengths) + inside] > 0
                own = ids[np.searchsorted(words.last, begin[runs], side="right")]
                flag |= np.repeat(own > least[which], lengths)
                found = (np.repeat(begin[runs], lengths) + inside)[flag]
                np.add.at(hit, found, 1)
                np.add.at(hit, found + window, -1)
            gone = np.cumsum(hit[:-1]) > 0
            removed = np.concatenate([[0], np.cumsum(gone)])
            hashes, kept = [], []
            for i, (a, b) in enumerate(zip(words.first.tolist(), words.last.tolist(), strict=True)):
                text = block.data[block.starts[i] : block.ends[i]].tobytes().split()
                if removed[b] > removed[a]:
                    text = [w for w, g in zip(text, gone[a:b].tolist(), strict=True) if not g]
                joined = b" ".join(text)
                hashes.append(hashlib.sha256(joined).hexdigest())
                if want_text:
                    kept.append(None if block.nulls[i] else joined.decode())
            columns = [
                block.rest,
                pa.array(words.last - words.first, pa.int64()),
                pa.array(removed[words.last] - removed[words.first], pa.int64()),
                pa.array(hashes, pa.string()),
            ]
            if want_text:
                columns.append(pa.array(kept, pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=["rest", *[f"o{i}" for i in range(len(fields))]])

    done = known.select("block", "rest", "ends", "nulls", "data", "r0", "r1").mapInArrow(finish, schema)
    made = [name for name, _ in fields]
    return done.select(
        *[F.col(f"rest.c{i}").alias(name) for i, name in enumerate(others) if name not in made],
        *[F.col(f"o{i}").alias(name) for i, name in enumerate(made)],
    )
