"""An adaptive range coder for token ids that mixes predictions of order 0, 1 and 2.

Ids are coded in blocks of equal count; each block starts from an empty model
and carries the CRC of its ids, so any block can be read alone and a damaged one
is noticed.  Many blocks are coded side by side, one numpy lane each.

For each id three predictions share the code range.  Order 2 names the id that
followed the same two ids in this block, order 1 the id that followed the same
one; each keeps a confidence that grows when it was right.  How often each order
was right at the present pair of confidences gives the shares of "as order 2",
"as order 1" and "neither" - the mixing weights.  An id that neither predicts is
coded by order 0: the frequencies of the ids of the block so far, with an escape
for new ids in proportion to how many different ones there were.  A new id is
coded by the adaptive frequencies of its magnitude class (bit length and the bit
below the top one), then the remaining bits evenly.

New ids of a
block are coded first, on their own, so that later an escape just takes the next.

All models learn from what is coded, so nothing of them is stored.  They learn
in steps, orders 1 and 2, shares and classes after every ``LEARN`` ids, order 0
each time the block has doubled: between two steps the tables stand still, and a
step is a few operations on all ids of all lanes.  When writing, the predictions
of a step are made at once too, and only the registers go id by id.

The range coder has 48-bit registers, whole numbers in doubles, and gives out
16-bit words; carries are added when a lane ends.  Layout of coded data,
little-endian: magic, number of blocks, ids in a full block (32 bits each); for
each block its ids, its words and the CRC-32 of its ids as 32-bit integers; then
the words of all blocks.
"""

from __future__ import annotations

import zlib

import numpy as np

MAGIC = b"DTC2"
BLOCK_IDS = 8192
#: Blocks coded side by side; more give no more speed but need more memory.
LANES = 1024
ORDER1_BITS, ORDER2_BITS = 10, 11
SURE = 3
#: Ids between two steps of learning; order 0 learns when the ids are a power of two times as many.
LEARN = 64
#: Order 0 learns from no more ids, so that its total stays below 2**13 and that of all orders at 2**16.
ORDER0_IDS = 4096
#: Total of order 0 before it has seen an id.
UNSEEN = 256
#: Greatest shares of orders 2 and 1, as multiples of the total of order 0.
MOST2, MOST1 = 5, 2
LIMIT = 1 << 13
CLASSES = 64
_FULL, _LEAST, _WORD = 2.0**48, 2.0**32, 2.0**16


class Corrupt(ValueError):
    """Coded data that does not give the ids it was made from."""


def _class_table() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each class its lowest id and its number of free bits; for each 16-bit id its class."""
    ids = np.arange(1 << 16, dtype=np.int64)
    length = np.zeros(1 << 16, dtype=np.int64)
    length[1:] = np.floor(np.log2(ids[1:])).astype(np.int64) + 1
    below = np.where(length >= 2, (ids >> np.maximum(length - 2, 0)) & 1, 0)
    of = np.where(length >= 2, 2 * length + below, length)
    base, bits = np.zeros(CLASSES, dtype=np.int32), np.zeros(CLASSES, dtype=np.int32)
    for c in np.unique(of):
        members = np.flatnonzero(of == c)
        base[c], bits[c] = members[0], int(len(members)).bit_length() - 1
    return base, bits, of.astype(np.int8)


BASE, BITS, CLASS_OF = _class_table()
USED = int(CLASS_OF.max()) + 1
_WIDTH = 2.0**BITS


class _Model:
    """What all lanes have learnt, for the writer and the reader alike."""

    def __init__(self, lanes: int):
        self.lanes = lanes
        self.base1 = np.arange(lanes) << ORDER1_BITS
        self.base2 = np.arange(lanes) << ORDER2_BITS
        self.base0 = np.arange(lanes) * (SURE + 1) ** 2
        self.next1 = np.zeros(lanes << ORDER1_BITS, dtype=np.int32)  # id and confidence in one number
        self.next2 = np.zeros(lanes << ORDER2_BITS, dtype=np.int32)
        self.count2, self.count1, self.count0 = (np.ones(lanes * (SURE + 1) ** 2) for _ in range(3))
        self.last = np.zeros((lanes, 2), dtype=np.int32)  # the two ids before the step
        self.total0 = np.full(lanes, float(UNSEEN))  # of order 0, escape included
        self.share()

    def share(self) -> None:
        """Where the shares of orders 1 and 2 end, from the counts so far; order 0 has the first."""
        total = np.repeat(self.total0, (SURE + 1) ** 2)
        unit = total / self.count0
        self.upto1 = total + np.maximum(np.minimum(np.floor(self.count1 * unit), MOST1 * total), 1)
        self.upto2 = self.upto1 + np.maximum(np.minimum(np.floor(self.count2 * unit), MOST2 * total), 1)

    def predict(self, before: np.ndarray, last: np.ndarray, lane=slice(None)) -> tuple[np.ndarray, ...]:
        """Where orders 1 and 2 look, what they say, with their confidences, and the row of the shares."""
        key = last * 40503
        slot1 = (key >> 4 & (1 << ORDER1_BITS) - 1) + self.base1[lane]
        key += before * 25717
        slot2 = (key >> 3 & (1 << ORDER2_BITS) - 1) + self.base2[lane]
        said1, said2 = self.next1.take(slot1), self.next2.take(slot2)
        return slot1, slot2, said1, said2, ((said2 & SURE) << 2 | said1 & SURE) + self.base0[lane]

    def predict_step(self, ids: np.ndarray) -> tuple[np.ndarray, ...]:
        """``predict`` for a step of ids, a row each lane, which keeps to the tables of one lane after the other."""
        every = np.concatenate([self.last, ids], axis=1).astype(np.int64)
        return self.predict(every[:, :-2], every[:, 1:-1], (slice(None), None))

    def learn(self, ids: np.ndarray, predicted: tuple[np.ndarray, ...]) -> None:
        """Learn a step of ids, a row each lane."""
        slot1, slot2, said1, said2, row = predicted
        right1, right2 = said1 >> 2 == ids, said2 >> 2 == ids
        held = ids << 2
        for slot, said, right, following in ((slot1, said1, right1, self.next1), (slot2, said2, right2, self.next2)):
            sure = said & SURE
            following[slot] = np.where(right, said + (sure < SURE), np.where(sure > 0, said - 1, held))  # the last of a slot stays
        right1 &= ~right2
        n = len(self.base0) * (SURE + 1) ** 2
        row += right1 * n
        row += right2 * (2 * n)
        seen = np.bincount(row.reshape(-1), minlength=3 * n)
        for k, count in enumerate((self.count0, self.count1, self.count2)):
            count += seen[k * n : (k + 1) * n]
        full = np.flatnonzero(self.count0 + self.count1 + self.count2 > LIMIT)
        for count in (self.count0, self.count1, self.count2):
            count[full] = np.floor(count[full] / 2) + 1
        self.last = np.concatenate([self.last, ids], axis=1)[:, -2:]
        self.share()


class _Writer:
    """Registers of all lanes and the words they gave out, which may still hold a carry."""

    def __init__(self, lanes: int, ids: int):
        self.low, self.range = np.zeros(lanes), np.full(lanes, _FULL)
        self.words = np.zeros((lanes, ids + 64), dtype=np.uint32)
        self.place = np.zeros(lanes, dtype=np.int64)

    def narrow(self, begin: np.ndarray, size: np.ndarray, total: np.ndarray) -> None:
        """Code rows of parts of the range, one row after the other; a row gives out at most one word a lane."""
        given, gives = np.zeros(begin.shape, dtype=np.uint32), np.zeros(begin.shape, dtype=bool)
        low, width = self.low, self.range
        for k in range(len(begin)):
            width /= total[k]
            np.floor(width, out=width)
            low += width * begin[k]
            width *= size[k]
            now = np.less(width, _LEAST, out=gives[k])
            word = np.floor(low * (1 / _LEAST))
            given[k] = word
            word *= now
            word *= _LEAST
            low -= word
            more = now * (_WORD - 1)
            more += 1
            low *= more
            width *= more
        self.append(given, gives)

    def append(self, given: np.ndarray, gives: np.ndarray) -> None:
        count = gives.sum(axis=0)
        if int((self.place + count).max()) > self.words.shape[1]:
            self.words = np.concatenate([self.words, np.zeros_like(self.words[:, : self.words.shape[1] // 2 + len(gives)])], axis=1)
        first = np.arange(len(count)) * self.words.shape[1] + self.place - (np.cumsum(count) - count)
        given = given.T[gives.T]
        self.words.reshape(-1)[np.repeat(first, count) + np.arange(len(given))] = given
        self.place += count

    def finish(self) -> tuple[np.ndarray, np.ndarray]:
        """The words of all lanes, a row each, and how many they are."""
        given = np.zeros((3, len(self.low)), dtype=np.uint32)
        for row in range(3):
            given[row] = word = np.floor(self.low / _LEAST)
            self.low = (self.low - word * _LEAST) * _WORD
        self.append(given, np.ones(given.shape, dtype=bool))
        flat = self.words.reshape(-1)
        while len(over := np.flatnonzero(flat > 0xFFFF)):
            flat[over] &= 0xFFFF
            flat[over - 1] += 1
        return self.words, self.place


class _Reader:
    """Registers of all lanes, over the words of all."""

    def __init__(self, words: np.ndarray, begin: np.ndarray):
        self.words, self.at = words, begin.copy()
        self.range, self.code = np.full(len(begin), _FULL), np.zeros(len(begin))
        for _ in range(3):
            self.code = self.code * _WORD + self.words.take(self.at, mode="clip")
            self.at += 1
        self.every = self.code

    def end(self) -> None:
        """Nothing is left of the code when all is read, for the writer gives out its registers whole."""
        if self.every.any():
            raise Corrupt("a block does not end where its words end")

    def keep(self, lanes: int) -> None:
        """Go on with the first lanes only."""
        self.at, self.range, self.code = self.at[:lanes], self.range[:lanes], self.code[:lanes]

    def value(self, total: np.ndarray) -> np.ndarray:
        """Where in ``total`` each lane stands."""
        self.range /= total
        np.floor(self.range, out=self.range)
        value = self.code / self.range
        return np.floor(value, out=value)

    def narrow(self, begin: np.ndarray, size: np.ndarray) -> None:
        code, width = self.code, self.range
        code -= width * begin
        width *= size
        gives = width < _LEAST
        more = gives * (_WORD - 1)
        more += 1
        width *= more
        code *= more
        word = self.words.take(self.at, mode="clip") * gives
        code += word
        self.at += gives


class _Classes:
    """Adaptive frequencies of the classes of new ids, a column each lane."""

    def __init__(self, lanes: int):
        self.count = np.ones((USED, lanes), dtype=np.int64)
        self.learn(np.zeros((0, lanes), dtype=np.int64), np.zeros((0, lanes), dtype=bool))

    def learn(self, kind: np.ndarray, held: np.ndarray) -> None:
        lanes = self.count.shape[1]
        at = kind * lanes + np.arange(lanes)
        self.count += np.bincount(at[held], minlength=self.count.size).reshape(self.count.shape)
        full = np.flatnonzero(self.count.sum(axis=0) > LIMIT)
        self.count[:, full] = (self.count[:, full] >> 1) + 1
        self.upto = np.zeros((USED + 1, lanes), dtype=np.int16)
        np.cumsum(self.count, axis=0, out=self.upto[1:])


def _write_new(ids: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code the first ``count`` of each row of new ids; a row that is through stands still."""
    ids = np.ascontiguousarray(ids.T)
    writer, classes, lane = _Writer(len(count), len(ids)), _Classes(len(count)), np.arange(len(count))
    for at in range(0, len(ids), LEARN):
        step = ids[at : at + LEARN]
        held = np.arange(at, at + len(step))[:, None] < count
        kind = CLASS_OF[step].astype(np.int64)
        begin, end = classes.upto[kind, lane], classes.upto[kind + 1, lane]
        rows = np.zeros((3, 2 * len(step), len(count)))  # class and rest of an id, one after the other
        rows[0, ::2], rows[0, 1::2] = np.where(held, begin, 0), np.where(held, step - BASE[kind], 0)
        rows[1, ::2], rows[1, 1::2] = np.where(held, end - begin, 1), 1
        rows[2, ::2], rows[2, 1::2] = np.where(held, classes.upto[-1], 1), np.where(held, _WIDTH[kind], 1)
        writer.narrow(*rows)
        classes.learn(kind, held)
    return writer.finish()


def _read_new(words: np.ndarray, begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The new ids of all lanes, a row each."""
    most, order = int(count.max()), np.argsort(-count, kind="stable")  # lanes that are through come last
    count, each = count[order], np.arange(len(count))
    ids, reader, classes = np.zeros((most, len(count)), dtype=np.uint16), _Reader(words, begin[order]), _Classes(len(count))
    for at in range(0, most, LEARN):
        kinds = np.zeros((min(LEARN, most - at), len(count)), dtype=np.int64)
        held = np.arange(at, at + len(kinds))[:, None] < count
        for k, now in enumerate(held.sum(axis=1).tolist()):
            reader.keep(now)
            upto, lane = classes.upto[:, :now], each[:now]
            value = reader.value(upto[-1]).astype(np.int16)
            kind = (upto[1:-1] <= value).view(np.int8).sum(axis=0, dtype=np.int8).astype(np.int64)
            below = upto[kind, lane]
            reader.narrow(below, upto[kind + 1, lane] - below)
            width = _WIDTH[kind]
            rest = np.minimum(reader.value(width), width - 1)
            reader.narrow(rest, 1)
            kinds[k, :now], ids[at + k, :now] = kind, BASE[kind] + rest.astype(np.int64)
        classes.learn(kinds, held)
    reader.end()
    lanes = np.zeros((len(count), most + 1), dtype=np.uint16)
    lanes[order, :most] = ids.T
    return lanes


def _learns(seen: int) -> bool:
    """Whether order 0 learns after so many ids."""
    return seen % LEARN == 0 and LEARN <= seen <= ORDER0_IDS and (seen // LEARN).bit_count() == 1


def _known(ids: np.ndarray, seen: int, until: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the ids of each lane from ``seen`` to ``until`` their begin and size in order 0, and each lane's total."""
    shape = (len(ids), until - seen)
    begin, size, total = np.zeros(shape, dtype=np.uint16), np.full(shape, UNSEEN, dtype=np.uint16), np.full(len(ids), float(UNSEEN))
    if not seen:
        return begin, size, total
    present = np.zeros(1 << 16, dtype=bool)
    present[ids[:, :until]] = True
    rank, width = np.cumsum(present) - 1, int(present.sum())
    group = max(1, (1 << 20) // width)
    for a in range(0, len(ids), group):  # a bounded table of counts
        at = rank.take(ids[a : a + group, :until])
        at += (np.arange(len(at)) * width)[:, None]
        count = np.bincount(at[:, :seen].reshape(-1), minlength=len(at) * width).astype(np.uint16).reshape(-1, width)
        below = np.cumsum(count, axis=1, dtype=np.uint16) - count
        different = (count > 0).sum(axis=1)
        total[a : a + group] = seen + different
        now = count.take(at[:, seen:])
        fresh = now == 0
        begin[a : a + group] = np.where(fresh, np.uint16(seen), below.take(at[:, seen:]))
        size[a : a + group] = np.where(fresh, different[:, None].astype(np.uint16), now)
    return begin, size, total


_BEGIN, _SIZE = 16, 32


def _table(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each lane and place in order 0 the id, its begin and its size in one number, the escape last; each lane's total."""
    lanes, seen = ids.shape
    held = np.sort(ids.astype(np.uint16), axis=1, kind="stable")
    first = np.ones(held.shape, dtype=bool)
    np.not_equal(held[:, 1:], held[:, :-1], out=first[:, 1:])
    different = first.sum(axis=1)
    starts = np.flatnonzero(first)
    sizes = np.diff(starts, append=held.size)
    table = np.empty((lanes, seen + 1), dtype=np.int64)
    table[:, :seen] = np.repeat(held.reshape(-1)[starts] + (starts % seen << _BEGIN) + (sizes << _SIZE), sizes).reshape(lanes, seen)
    table[:, seen] = (seen << _BEGIN) + (different << _SIZE)
    return table.reshape(-1), (seen + different).astype(np.float64)


def _write(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code one row of ids in each lane; the words of all lanes and how many of them are whose.

    A lane has the numbers of its new ids and of their words, two words each, then the words of the new ids, then its own."""
    lanes, count = matrix.shape
    model, writer, fresh = _Model(lanes), _Writer(lanes, count), np.zeros(matrix.shape, dtype=bool)
    for at in range(0, count, LEARN):
        if not at or _learns(at):
            seen, until = at, min(count, 2 * max(at, LEARN // 2) if at < ORDER0_IDS else count)
            begins, sizes, model.total0 = _known(matrix, seen, until)
            model.share()
        step = matrix[:, at : at + LEARN].astype(np.int32)
        predicted = model.predict_step(step)
        _, _, said1, said2, row = predicted
        is2, is1 = said2 >> 2 == step, said1 >> 2 == step
        upto1, total, total0 = model.upto1.take(row), model.upto2.take(row), model.total0[:, None]
        begin = begins[:, at - seen : at - seen + LEARN]
        fresh[:, at : at + LEARN] = (begin == seen) & ~(is1 | is2)
        size = np.where(is2, total - upto1, np.where(is1, upto1 - total0, sizes[:, at - seen : at - seen + LEARN]))
        begin = np.where(is2, upto1, np.where(is1, total0, begin))
        writer.narrow(*(np.ascontiguousarray(x.T) for x in (begin, size, total)))
        model.learn(step, predicted)
    words, place = writer.finish()
    count_new = fresh.sum(axis=1)
    new = np.zeros((lanes, int(count_new.max())), dtype=np.int64)
    new[np.arange(new.shape[1]) < count_new[:, None]] = matrix[fresh]
    words_new, place_new = _write_new(new, count_new)
    numbers = np.stack([count_new & 0xFFFF, count_new >> 16, place_new & 0xFFFF, place_new >> 16], axis=1)
    parts = [x for lane in zip(numbers, words_new, words, place_new.tolist(), place.tolist()) for x in (lane[0], lane[1][: lane[3]], lane[2][: lane[4]])]
    return np.concatenate(parts).astype("<u2"), 4 + place_new + place


def _read(words: np.ndarray, begin: np.ndarray, count: int) -> np.ndarray:
    """The ids of all lanes, one row each; a lane's words begin at ``begin``."""
    lanes = len(begin)
    words = np.concatenate([words, np.zeros(8, dtype="<u2")])
    numbers = words[np.minimum(begin[:, None] + np.arange(4), len(words) - 1)].astype(np.int64)
    count_new = numbers[:, 0] | numbers[:, 1] << 16
    if (count_new > count).any():
        raise Corrupt("a block has more new ids than ids")
    new = _read_new(words, begin + 4, count_new)
    place, new = np.arange(lanes) * new.shape[1], new.reshape(-1)  # of the next new id of each lane
    ids = np.zeros((lanes, count), dtype=np.uint16)
    model, reader = _Model(lanes), _Reader(words, begin + 4 + (numbers[:, 2] | numbers[:, 3] << 16))
    table, seen = np.full(lanes, UNSEEN << _SIZE), 0
    base = np.arange(lanes)
    for at in range(0, count, LEARN):
        if _learns(at):
            (table, model.total0), seen = _table(ids[:, :at]), at
            base = np.arange(lanes) * (seen + 1)
            model.share()
        step = np.zeros((min(LEARN, count - at), lanes), dtype=np.int64)
        before, last = model.last.T.astype(np.int64)
        total0, most = model.total0, float(seen)
        for k in range(len(step)):
            _, _, said1, said2, row = model.predict(before, last)
            upto1, total = model.upto1.take(row), model.upto2.take(row)
            value = reader.value(total)
            literal, is2 = value < total0, value >= upto1
            fresh = np.flatnonzero(literal & (value >= most))
            held = table.take(np.minimum(value, most).astype(np.int64) + base)
            begin = np.where(literal, held >> _BEGIN & (1 << _SIZE - _BEGIN) - 1, np.where(is2, upto1, total0))
            reader.narrow(begin, np.where(literal, held >> _SIZE, np.where(is2, total, upto1) - begin))
            now = np.where(literal, held & (1 << _BEGIN) - 1, np.where(is2, said2, said1) >> 2)
            at_new = place[fresh]
            now[fresh] = new.take(at_new, mode="clip")
            place[fresh] = at_new + 1
            step[k] = now
            before, last = last, now
        done = np.ascontiguousarray(step.T, dtype=np.int32)
        ids[:, at : at + LEARN] = done
        model.learn(done, model.predict_step(done))
    reader.end()
    return ids


def encode(ids: np.ndarray, block_ids: int = BLOCK_IDS) -> bytes:
    """Coded form of ids under 2**16."""
    ids = np.ascontiguousarray(ids, dtype="<u4")
    if len(ids) and int(ids.max()) >= 1 << 16:
        raise ValueError("ids must be under 65536")
    sizes = [min(block_ids, len(ids) - a) for a in range(0, len(ids), block_ids)]
    payload, counts = [], []
    for first in range(0, len(sizes), LANES):
        here = sizes[first : first + LANES]
        matrix = np.zeros((len(here), here[0]), dtype=np.uint16)  # zeros fill a short last block beside full ones
        matrix.reshape(-1)[: sum(here)] = ids[first * block_ids : first * block_ids + sum(here)]
        words, count = _write(matrix)
        counts += count.tolist()
        payload.append(words.tobytes())
    table = np.zeros((len(sizes), 3), dtype="<u4")
    for i, size in enumerate(sizes):
        table[i] = size, counts[i], zlib.crc32(ids[i * block_ids : i * block_ids + size])
    return MAGIC + np.array([len(sizes), block_ids], dtype="<u4").tobytes() + table.tobytes() + b"".join(payload)


def decode(data: bytes) -> np.ndarray:
    """The ids of coded data; ``Corrupt`` if a block is damaged."""
    if len(data) < 12 or data[:4] != MAGIC:
        raise Corrupt("not coded token ids")
    blocks, block_ids = np.frombuffer(data, dtype="<u4", count=2, offset=4).tolist()
    if len(data) < 12 + 12 * blocks:
        raise Corrupt("the block table is cut off")
    table = np.frombuffer(data, dtype="<u4", count=3 * blocks, offset=12).reshape(-1, 3).astype(np.int64)
    if (len(data) - 12 - 12 * blocks) % 2:
        raise Corrupt("the blocks do not fill the data")
    words = np.frombuffer(data, dtype="<u2", offset=12 + 12 * blocks)
    ends = np.cumsum(table[:, 1])
    if blocks and (len(words) != ends[-1] or (table[:-1, 0] != block_ids).any() or not 0 < table[-1, 0] <= block_ids):
        raise Corrupt("the blocks do not fill the data")
    parts = []
    for first in range(0, blocks, LANES):
        here = range(first, min(first + LANES, blocks))
        ids = _read(words, ends[here] - table[here, 1], int(table[first, 0])).astype("<u4")
        for lane, block in enumerate(here):
            if zlib.crc32(ids[lane, : table[block, 0]]) != table[block, 2]:
                raise Corrupt(f"block {block} has a wrong checksum")
        parts.append(ids.reshape(-1)[: int(table[here, 0].sum())])
    return parts[0] if len(parts) == 1 else np.concatenate([np.empty(0, dtype="<u4"), *parts])
