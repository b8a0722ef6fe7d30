"""Suffix-array deduplication: bytes covered by a long string that also starts elsewhere.

Method: distributed prefix doubling with early discarding.  The name of a
prefix (its place in the sorted order of equal prefixes) is doubled from length
to length by sorting pairs ``(name at i, name at i + offset)``; a suffix whose
name is unique leaves, because nothing longer that starts there can repeat.

* The first sort ranks a sample of suffixes, not all: in each window of the
  threshold's length the least-named prefix of ``base`` bytes.  Equal windows
  sample equal prefixes at equal places, so a window whose sample is unique is
  unique itself and its suffix is discarded.  The sample is about two suffixes
  in a hundred.
* The following sorts rank all suffixes that are left, by pairs at growing
  offsets, until the prefixes reach the threshold.

Names are 64-bit polynomial fingerprints, which any task computes from its own
block, so ranks never have to be looked up across blocks; only sorted names and
one code for each travel.  Whole texts that repeat are recognised in the first
sort by two more names each (128 bits); all their bytes go, and the suffixes of
one copy stand for all in the later sorts.

Memory: one block of text, its surviving names and one range of the exchange.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from drayline.llm.blocks import CHOSEN, Block, flags_of, range_count, read_blocks, repeated_names, with_reply, write_blocks
from drayline.llm.names import byte_values, heads, pair, sampled, spread, window_mask
from drayline.session import RunFolder

THRESHOLD = 200


def growing_lengths(base: int, threshold: int) -> list[int]:
    """Prefix lengths of the sorts: doubled from ``base``, the last one exactly the threshold."""
    out = [base]
    while out[-1] < threshold:
        out.append(min(2 * out[-1], threshold))
    return out


def _digests(block: Block, long: np.ndarray) -> np.ndarray:
    """Two names for each of the given whole texts, side by side."""
    starts, data = block.starts, block.data
    return np.frombuffer(
        b"".join(hashlib.blake2b(data[starts[i] : block.ends[i]], digest_size=16).digest() for i in long), dtype=np.uint64
    )


def _samples(block: Block, base: int, threshold: int, valid: np.ndarray):
    """Chunks with their sampled grams, one entry for each run of windows that share a sample."""
    values = byte_values()
    for begin, names, starts, picked in sampled(lambda a, b: values[block.data[a:b]], len(block.data), base, threshold, valid):
        first = heads(picked)
        yield begin, names, starts, picked[first], np.diff(np.append(first, len(starts)))


def _first_names(block: Block, base: int, threshold: int) -> np.ndarray:
    valid = window_mask(block.starts, block.ends, threshold, len(block.data))
    long = np.flatnonzero(block.ends - block.starts >= threshold)
    parts = [_digests(block, long)]
    parts += [spread(names[picked]) for _, names, _, picked, _ in _samples(block, base, threshold, valid)]
    return np.concatenate(parts)


def _left(block: Block, lengths: list[int], codes: list[np.ndarray], rounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes left after ``len(codes)`` sorts, their names at length ``lengths[rounds]``, and the whole copies.

    With as many codes as rounds this is what the next sort gets; with one more
    the names are those of the last sort and the suffixes those that repeat.
    """
    base, threshold = lengths[0], lengths[-1]
    starts, ends = block.starts, block.ends
    long = np.flatnonzero(ends - starts >= threshold)
    chunks = list(_samples_of_first(block, base, threshold))
    digests = _digests(block, long)
    first = np.concatenate([digests, *[spread(names[picked]) for _, names, _, picked, _ in chunks]])
    flags = flags_of(first, codes[0]) if len(first) else np.empty(0, dtype=np.uint8)
    halves = flags[: len(digests)].reshape(-1, 2)
    copies = long[(halves > 0).all(axis=1)]
    standing = np.flatnonzero((halves > 0).all(axis=1) & (halves[:, 0] >= CHOSEN))
    standing = standing[np.unique(digests[::2][standing], return_index=True)[1]]
    out = np.zeros(len(ends), dtype=bool)  # copies that another one stands for
    out[copies] = True
    out[long[standing]] = False
    at, positions, found = len(digests), [], []
    for begin, names, begins, picked, runs in chunks:
        alive = np.repeat(flags[at : at + len(picked)] > 0, runs)
        at += len(picked)
        here = begins[alive]
        here = here[~out[np.searchsorted(ends, here + begin, side="right")]]
        current = names
        for done, length in zip(lengths[:rounds], lengths[1 : rounds + 1], strict=True):
            step = length - done
            if length == threshold:
                current = pair(current[here], current[here + step])
            else:
                current = pair(current[:-step], current[step:])
        positions.append(here + begin)
        found.append(current if lengths[rounds] == threshold and rounds else current[here])
    if not positions:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64), copies
    return np.concatenate(positions), np.concatenate(found), copies


def _samples_of_first(block: Block, base: int, threshold: int):
    valid = window_mask(block.starts, block.ends, threshold, len(block.data))
    return _samples(block, base, threshold, valid)


def _survivors(block: Block, lengths: list[int], codes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes that every sort so far left, with their names for the next one."""
    keep = None
    for done in range(1, len(codes)):
        positions, names, copies = _left(block, lengths, codes, done)
        if keep is not None:
            positions, names = positions[keep], names[keep]
        passed = flags_of(names, codes[done]) > 0
        keep = passed if keep is None else _narrow(keep, passed)
    rounds = min(len(codes), len(lengths) - 1)
    positions, names, copies = _left(block, lengths, codes, rounds)
    return (positions, names, copies) if keep is None else (positions[keep], names[keep], copies)


def _narrow(keep: np.ndarray, passed: np.ndarray) -> np.ndarray:
    out = keep.copy()
    out[keep] = passed
    return out


def _spans(block: Block, positions: np.ndarray, copies: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal removed stretches as document, first byte and end inside the block."""
    owner = np.searchsorted(block.ends, positions, side="right")
    apart = ~np.isin(owner, copies)
    positions, owner = positions[apart], owner[apart]
    cut = np.ones(len(positions), dtype=bool)
    cut[1:] = (positions[1:] > positions[:-1] + threshold) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(cut)
    last = np.append(first[1:], len(positions)) - 1 if len(first) else first
    docs = np.concatenate([owner[first], copies])
    begins = np.concatenate([positions[first], block.starts[copies]])
    ends = np.concatenate([positions[last] + threshold, block.ends[copies]])
    order = np.argsort(begins, kind="stable")
    return docs[order], begins[order], ends[order]


def repeated_spans(
    docs: DataFrame,
    run: RunFolder,
    text_col: str = "text",
    threshold: int = THRESHOLD,
    base: int | None = None,
    want_text: bool = True,
) -> DataFrame:
    """Remove every byte covered by a ``threshold``-byte string that also starts anywhere else.

    Texts are their UTF-8 bytes; matches do not cross texts; a string may
    repeat within one text and may overlap itself.  Judged on the input alone.

    Result: the input's columns beside the text, then ``n_bytes``,
    ``n_removed``, ``n_spans`` (maximal removed stretches), ``kept_sha256``
    (hex, of the bytes left, joined) and with ``want_text`` ``spans`` (start
    and end byte) and ``kept`` (the text left, without characters that lost a
    part of their bytes; null for a null text).  An input column of one of
    these names is left out.

    Null and empty texts and texts under the threshold have nothing removed.
    Rows are rows: two with the same id, null ids or equal in every column are
    separate texts, and copies of one another.  An empty table gives an empty
    result.
    """
    base = base or -(-threshold // 2)
    if not 0 < base <= threshold:
        raise ValueError("base must lie between 1 and the threshold")
    lengths = growing_lengths(base, threshold) if base < threshold else [base, base]
    blocks, rest = write_blocks(docs, text_col, run)
    ranges = range_count(blocks)

    joined = blocks
    for k in range(len(lengths)):
        if k == 0:
            names_of = lambda block, _: _first_names(block, base, threshold)
        else:
            names_of = lambda block, codes: _survivors(block, lengths, codes)[1]
        reply = run.keep(repeated_names(joined, names_of, ranges, replies=k, choose=k == 0), f"reply{k}")
        joined = with_reply(joined, reply, k)

    fields = [("n_bytes", T.LongType()), ("n_removed", T.LongType()), ("n_spans", T.LongType()), ("kept_sha256", T.StringType())]
    if want_text:
        span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
        fields += [("spans", T.ArrayType(span)), ("kept", T.StringType())]
    rest_type = blocks.schema["rest"].dataType.elementType
    schema = T.StructType([T.StructField("rest", rest_type), *[T.StructField(f"o{i}", t) for i, (_, t) in enumerate(fields)]])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, codes in read_blocks(batches, len(lengths)):
            positions, names, copies = _survivors(block, lengths, codes[:-1])
            repeated = positions[flags_of(names, codes[-1]) > 0] if len(names) else positions
            docs_of, begins, ends = _spans(block, repeated, copies, threshold)
            n = len(block.ends)
            firsts = np.searchsorted(docs_of, np.arange(n + 1))
            removed = np.zeros(n, dtype=np.int64)
            np.add.at(removed, docs_of, ends - begins)
            hashes, kept, spans = [], [], []
            for i, (s, e) in enumerate(zip(block.starts.tolist(), block.ends.tolist(), strict=True)):
                a, b = firsts[i], firsts[i + 1]
                at, parts = s, []
                for x, y in zip(begins[a:b].tolist(), ends[a:b].tolist(), strict=True):
                    parts.append(block.data[at:x])
                    at = y
                parts.append(block.data[at:e])
                digest = hashlib.sha256()
                for part in parts:
                    digest.update(part)
                hashes.append(digest.hexdigest())
                if want_text:
                    kept.append(None if block.nulls[i] else b"".join(p.tobytes() for p in parts).decode(errors="ignore"))
                    spans.append([{"start": x - s, "end": y - s} for x, y in zip(begins[a:b].tolist(), ends[a:b].tolist(), strict=True)])
            columns = [
                block.rest,
                pa.array(block.ends - block.starts, pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array(np.diff(firsts), pa.int64()),
                pa.array(hashes, pa.string()),
            ]
            if want_text:
                columns += [pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["rest", *[f"o{i}" for i in range(len(fields))]])

    wanted = ["block", "rest", "ends", "nulls", "data", *[f"r{k}" for k in range(len(lengths))]]
    done = joined.select(*wanted).mapInArrow(finish, schema)
    others = [c for c in docs.columns if c != text_col]
    made = [name for name, _ in fields]
    return done.select(
        *[F.col(f"rest.c{i}").alias(name) for i, name in enumerate(others) if name not in made],
        *[F.col(f"o{i}").alias(name) for i, name in enumerate(made)],
    )
