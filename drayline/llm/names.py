"""Fixed-width names (fingerprints) of the substrings of a sequence, in numpy.

A sequence is an array of 64-bit values (bytes or words through a table).  The
name of a run of ``k`` values is the polynomial sum over them modulo 2**64,
divided by the power of its start, and mixed: equal runs have equal names
wherever they stand.  Arrays are handled in chunks, so memory does not depend
on the length of a text.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np

BASE = 0x9E3779B97F4A7C15
MIX = np.uint64(0xD6E8FEB86659FD93)
CHUNK = 1 << 20
#: What separates words: space and the bytes 9 to 13.
SPACES = np.zeros(256, dtype=bool)
SPACES[[32, *range(9, 14)]] = True


@functools.cache
def byte_values() -> np.ndarray:
    """A fixed random value for each byte."""
    return np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of each."""
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, CHUNK + (1 << 12))
        for name, factor in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            out = np.full(size, factor, dtype=np.uint64)
            out[0] = 1
            _powers[name] = np.multiply.accumulate(out)
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= MIX
    x ^= x >> np.uint64(29)
    return x


def sums(values: np.ndarray) -> np.ndarray:
    """Prefix sums of ``value * base**position``; one longer than ``values``."""
    up, _ = powers(len(values) + 1)
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[: len(values)], out=out[1:])
    return out


def gram_names(values: np.ndarray, k: int) -> np.ndarray:
    """The name of each run of ``k`` values."""
    if len(values) < k:
        return np.empty(0, dtype=np.uint64)
    total = sums(values)
    out = total[k:] - total[:-k]
    out *= powers(len(values) + 1)[1][: len(out)]
    return mix(out)


def spread(least: np.ndarray) -> np.ndarray:
    """Names of sampled grams, which are small as the least of many, over the whole range again."""
    return mix(least * np.uint64(BASE))


def pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The name of a run from the names of two runs that cover it."""
    return mix(first * np.uint64(BASE) + second)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, by doubling."""
    done = 1
    while 2 * done <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    rest = width - done
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def window_mask(starts: np.ndarray, ends: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which positions start a window of ``width`` inside one of the given spans."""
    fits = ends - starts >= width
    marks = np.zeros(n + 1, dtype=np.int8)
    marks[starts[fits]] += 1
    marks[ends[fits] - width + 1] -= 1
    return np.cumsum(marks[:n], dtype=np.int8).view(bool)


def sampled(values_of, n: int, gram: int, width: int, valid: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each chunk: its start, the names of its grams, its window starts and each window's sampled gram.

    A window's sample is the gram of least name in it, the leftmost among
    equals, so equal windows sample equal grams at equal places.
    ``values_of(a, b)`` gives the values of a stretch.
    """
    for begin in range(0, n, CHUNK):
        end = min(begin + CHUNK + width - 1, n)
        count = end - begin - width + 1
        if count <= 0:
            return
        starts = np.flatnonzero(valid[begin : begin + count])
        if not len(starts):
            continue
        names = gram_names(values_of(begin, end), gram)
        low = np.uint64((1 << (CHUNK + width).bit_length()) - 1)
        keys = (names & ~low) | np.arange(len(names), dtype=np.uint64)
        least = sliding_min(keys, width - gram + 1) & low
        yield begin, names, starts, least[starts].astype(np.int64)


def heads(x: np.ndarray) -> np.ndarray:
    """Positions where a run of equal values begins."""
    if not len(x):
        return np.empty(0, dtype=np.int64)
    return np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))


def words_of(data: np.ndarray, doc_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of each word; no word crosses the start of a document."""
    inside = ~SPACES[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cuts = doc_starts[doc_starts < len(data)]
    first[cuts] = inside[cuts]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    before = cuts[cuts > 0] - 1
    last[before] = inside[before]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def word_values(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit value for each word, stretch by stretch; stretches end between words."""
    out = np.empty(len(starts), dtype=np.uint64)
    a = 0
    while a < len(starts):
        b = max(int(np.searchsorted(ends, starts[a] + CHUNK, side="right")), a + 1)
        begin, end = starts[a], ends[b - 1]
        total = sums(byte_values()[data[begin:end]])
        down = powers(end - begin + 1)[1]
        s = starts[a:b] - begin
        out[a:b] = (total[ends[a:b] - begin] - total[s]) * down[s] + (ends[a:b] - starts[a:b]).astype(np.uint64)
        a = b
    return mix(out)
