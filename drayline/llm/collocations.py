"""Phrases that occur more often than their parts suggest, by language.

Texts are cut into pieces and words and stored once as blocks of numbered words.
Phrases grow word by word.  At each length the frequent phrases are put into
double-array tries; every text position starts at the root of its language,
numpy moves all positions together one word deeper at a time, and the states
where a phrase ends are counted with one bincount a block.  The sums over all
blocks are the phrase counts.  The same step names the candidates of the next
length: a position where a frequent phrase ends, with the word after it, if the
phrase that begins one word later is frequent too.  No phrase can be frequent
otherwise, and no phrase that does not occur is ever made.

A trie holds at most ``TRIE_PHRASES`` phrases, whatever the corpus; where there are
more, they are dealt over several tries by a hash and the blocks are read once
for each, so that what is broadcast stays bounded.

Words travel as strings only twice: once to be counted, once to be numbered,
and both times a block names each of its different words once.  To be numbered
they travel as one list for each block and range of word hashes, not as rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from drayline.session import RunFolder

BLOCK_BYTES = 4 << 20
#: Bytes of text that all open blocks of a task may hold together, whatever the number of languages.
OPEN_BYTES = 16 << 20
#: Phrases in one trie: some 60 MB at five words each.
TRIE_PHRASES = 1_000_000
NO_LANGUAGE = "und"
#: Signs that end a piece, and what separates words inside one.
_SIGNS = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n\n\n\n\n\n\n\n\n ")
_END = b"\n"


def words_of(text: str) -> list[bytes]:
    """The words of a text with A-Z in lower case; a line feed stands between pieces."""
    raw = text.encode().lower().translate(_SIGNS).replace(b"\n", b" \n ")
    return [w for w in raw.split(b" ") if w]


def _blocks(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """Words as numbers inside blocks of one language: ``words`` in the order of their numbers, their ``counts``, ``codes``."""
    plain = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    schema = "block long, lang string, words array<string>, counts array<long>, codes binary"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        open_: dict[str, tuple[dict[bytes, int], list[np.ndarray], int]] = {}
        held = 0

        def flush(lang: str) -> pa.RecordBatch:
            nonlocal number, held
            place, parts, size = open_.pop(lang)
            codes = np.concatenate(parts)
            counts = np.bincount(codes, minlength=len(place))
            held -= size
            number += 1
            end = place[_END]
            names = [w for w in place if w != _END]  # the sign between pieces has number 0
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([number - 1], pa.int64()),
                    pa.array([lang], pa.string()),
                    pa.array([[w.decode() for w in names]], pa.list_(pa.string())),
                    pa.array([np.delete(counts, end)], pa.list_(pa.int64())),
                    pa.array([codes.astype(np.int32).tobytes()], pa.binary()),
                ],
                names=["block", "lang", "words", "counts", "codes"],
            )

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words_of(text)
                place, parts, size = open_.get(lang) or ({_END: 0}, [], 0)
                for w in set(words).difference(place):
                    place[w] = len(place)
                parts.append(np.array([*map(place.__getitem__, words), 0], dtype=np.int32))
                open_[lang] = (place, parts, size + len(text) + 64)
                held += len(text) + 64
                if size + len(text) >= BLOCK_BYTES:
                    yield flush(lang)
                while held > OPEN_BYTES:
                    yield flush(max(open_, key=lambda x: open_[x][2]))
        for lang in list(open_):
            yield flush(lang)

    return plain.mapInArrow(pack, schema)


class DoubleArray:
    """Phrases of numbered words, one root a language: from state s word w leads to ``base[s] + w`` if ``check`` there is s.

    States are places in the arrays, the first ones are the roots.  ``base``
    may lie below zero; a place outside the arrays leads nowhere.
    """

    def __init__(self, base: np.ndarray, check: np.ndarray):
        self.base, self.check = base, check

    @classmethod
    def build(cls, roots: np.ndarray, words: np.ndarray, n_roots: int, n_words: int) -> tuple[DoubleArray, np.ndarray]:
        """From phrases (a root number and a row of word numbers each); the second result is each phrase's last state.

        Room is found at random, widest nodes first; nodes of one word fill the
        holes.  Arrays stay short if the words of a root lie close together.
        """
        state = roots.astype(np.int64)  # nodes are numbered level by level, the roots first
        parents, symbols, nodes = [], [], n_roots
        for level in range(words.shape[1]):
            edge, inverse = np.unique(state * n_words + words[:, level], return_inverse=True)
            parents.append(edge // n_words)
            symbols.append(edge % n_words)
            state = nodes + inverse
            nodes += len(edge)
        parent, symbol = np.concatenate(parents), np.concatenate(symbols)
        order = np.argsort(parent, kind="stable")
        parent, symbol, child = parent[order], symbol[order], order + n_roots
        first = np.flatnonzero(np.diff(parent, prepend=-1))
        fan = np.diff(np.append(first, len(parent)))
        place = np.full(nodes, -1, dtype=np.int64)
        size = 2 * (len(parent) + n_words) + n_roots
        free = np.ones(size, dtype=bool)
        place[:n_roots] = np.arange(n_roots)
        free[:n_roots] = False
        base = np.zeros(nodes, dtype=np.int64)
        rng = np.random.default_rng(3)
        for at in np.argsort(-fan, kind="stable"):  # wide nodes first, while there is room
            if fan[at] == 1:
                break
            mine = symbol[first[at] : first[at] + fan[at]]
            tries = 0
            while True:
                low = rng.integers(0, len(free) - int(mine[-1] - mine[0]), size=32)
                fits = np.flatnonzero(free[low[:, None] + (mine - mine[0])].all(axis=1))
                if len(fits):
                    break
                tries += 1
                if tries % 8 == 0:
                    free = np.append(free, np.ones(max(len(free) // 2, int(mine[-1] - mine[0]) + 1), dtype=bool))
            begin = int(low[fits[0]]) - int(mine[0])
            base[parent[first[at]]] = begin
            place[child[first[at] : first[at] + fan[at]]] = begin + mine
            free[begin + mine] = False
        single = first[fan == 1]
        room = np.flatnonzero(free)
        if len(room) < len(single):
            free = np.append(free, np.ones(len(single), dtype=bool))
            room = np.flatnonzero(free)
        place[child[single]] = room[: len(single)]
        base[parent[single]] = room[: len(single)] - symbol[single]
        end = int(place.max()) + 1 if nodes else 0
        out_base, check = np.zeros(end, dtype=np.int64), np.full(end, -1, dtype=np.int64)
        out_base[place] = base
        check[place[child]] = place[parent]
        return cls(out_base.astype(np.int32), check.astype(np.int32)), place[state]

    def step(self, states: np.ndarray, words: np.ndarray) -> np.ndarray:
        """The state after one word, -1 where there is none; negative words lead nowhere."""
        to = self.base[states].astype(np.int64) + words
        good = (words >= 0) & (to >= 0) & (to < len(self.check))
        to[~good] = 0
        good &= self.check[to] == states
        to[~good] = -1
        return to

    def advance(self, root: int, words: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions where a phrase of ``length`` words begins, and the states where it ends, for all positions together."""
        at = np.flatnonzero(words >= 0)
        states = np.full(len(at), root, dtype=np.int64)
        for k in range(length):
            if k:
                inside = at + k < len(words)
                at, states = at[inside], states[inside]
            states = self.step(states, words[at + k])
            alive = states >= 0
            at, states = at[alive], states[alive]
        return at, states


_TRIE = "shard long, langs array<string>, ids binary, ranks binary, base binary, check binary, leaves array<struct<state:long,lang:string,words:array<bigint>>>"


def _tries(phrases: DataFrame, shards: int) -> DataFrame:
    """One trie a shard; phrases are dealt by a hash of all their words, so no word gathers in one."""

    def build(table: pa.Table) -> pa.Table:
        langs = table.column("lang").combine_chunks()
        langs = (langs.chunk(0) if isinstance(langs, pa.ChunkedArray) else langs).dictionary_encode()
        words = np.array(table.column("words").to_pylist(), dtype=np.int64)
        ids, local = np.unique(words, return_inverse=True)
        local, root, names = local.reshape(words.shape), langs.indices.to_numpy(), langs.dictionary.to_pylist()
        # Words are ranked by the first language that has them.
        holder = np.full(len(ids), len(names))
        np.minimum.at(holder, local, np.broadcast_to(root[:, None], local.shape))
        ranks = np.empty(len(ids), dtype=np.int32)
        ranks[np.argsort(holder, kind="stable")] = np.arange(len(ids), dtype=np.int32)
        trie, ends = DoubleArray.build(root, ranks[local].astype(np.int64), len(names), len(ids))
        leaves = pa.StructArray.from_arrays([pa.array(ends), pa.array(langs.cast(pa.string())), pa.array(list(words), pa.list_(pa.int64()))], names=["state", "lang", "words"])
        return pa.table(
            {
                "shard": pa.array([table.column("shard")[0].as_py()], pa.int64()),
                "langs": pa.array([names], pa.list_(pa.string())),
                "ids": pa.array([ids.tobytes()], pa.binary()),
                "ranks": pa.array([ranks.tobytes()], pa.binary()),
                "base": pa.array([trie.base.tobytes()], pa.binary()),
                "check": pa.array([trie.check.tobytes()], pa.binary()),
                "leaves": pa.ListArray.from_arrays(pa.array([0, len(leaves)], pa.int32()), leaves),
            }
        )

    dealt = phrases.select("lang", "words", F.pmod(F.xxhash64("lang", "words"), F.lit(shards)).alias("shard"))
    return dealt.groupBy("shard").applyInArrow(build, _TRIE)


#: Candidates that a task holds before it adds equal ones up.
HELD_CANDIDATES = 1 << 21


#: Words of text for each range in which counts are added up and words are numbered.
RANGE_WORDS = 2_000_000


def _added_up(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different keys and the sums of their counts."""
    key, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    return key[first], np.add.reduceat(n[order], first)


def _pack(key: np.ndarray, n: np.ndarray) -> bytes:
    """Sorted keys as gaps and their counts, byte by byte of equal rank: most of these are zero and cost nothing."""
    planes = [np.ascontiguousarray(x.astype("<i8").view(np.uint8).reshape(-1, 8).T) for x in (np.diff(key, prepend=0), n)]
    return zstandard.ZstdCompressor(level=1).compress(np.concatenate(planes).tobytes())


def _unpack(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), dtype=np.uint8).reshape(2, 8, -1)
    gaps, n = (np.ascontiguousarray(x.T).reshape(-1).view("<i8") for x in planes)
    return np.cumsum(gaps), n


def _count(blocks: DataFrame, trie, length: int, whole: bool, grow: bool, n_words: int, least: int, ranges: int) -> DataFrame:
    """``state``, ``word``, ``n`` of at least ``least``: how often phrases end in a state (word -1), and with which word they go on.

    ``trie`` is the broadcast (languages, word ids, ranks, base, check) of one
    shard; ``whole`` says that there is no other shard.  A state and a word are
    one key; a task adds its keys up and sends them packed, dealt by a hash.
    """
    width = n_words + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, *raw = trie.value
        ids, ranks, base, check = (np.frombuffer(x, dtype=k) for x, k in zip(raw, (np.int64, np.int32, np.int32, np.int32), strict=True))
        walker = DoubleArray(base, check)
        root_of = {lang: i for i, lang in enumerate(langs)}
        ended = np.zeros(len(check), dtype=np.int64)
        parts, held = [], 0
        for batch in batches:
            for lang, cell, known in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                if lang not in root_of:
                    continue
                codes = np.frombuffer(cell.as_buffer(), dtype=np.int32)
                mine = known.values.to_numpy(zero_copy_only=False)  # ids by number; 0 is the sign between pieces
                at = np.minimum(np.searchsorted(ids, mine), len(ids) - 1)
                words = np.where(ids[at] == mine, ranks[at], -1)[codes]
                begin, states = walker.advance(root_of[lang], words, length)
                ended += np.bincount(states, minlength=len(ended))
                if not grow:
                    continue
                if whole:  # what goes on has to be frequent from its second word on too
                    frequent = np.zeros(len(words) + 1, dtype=bool)
                    frequent[begin] = True
                    going = frequent[begin + 1]
                    begin, states = begin[going], states[going]
                inside = begin + length < len(words)
                begin, states = begin[inside], states[inside]
                # The next word by its own id, so that words of other shards count as well.
                after = mine[codes[begin + length]]
                good = after >= 0
                parts.append(np.unique(states[good] * width + after[good] + 1, return_counts=True))
                held += len(parts[-1][0])
                if held > HELD_CANDIDATES:
                    parts = [_added_up(parts)]
                    held = len(parts[0][0]) // 2  # room for as many again at least
        found = np.flatnonzero(ended)
        key, n = _added_up([(found * width, ended[found]), *parts])
        place = ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % np.uint64(ranges)
        order = np.argsort(place, kind="stable")
        cuts = np.flatnonzero(np.diff(place[order].astype(np.int64), prepend=-1, append=-1))
        for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            here = order[i:j]
            yield pa.RecordBatch.from_arrays([pa.array([int(place[here[0]])], pa.int64()), pa.array([_pack(key[here], n[here])], pa.binary())], names=["part", "packed"])

    def add(table: pa.Table) -> pa.Table:
        key, n = _added_up([_unpack(x.as_py()) for x in table.column("packed")])
        key, n = key[n >= least], n[n >= least]
        return pa.table({"state": key // width, "word": key % width - 1, "n": n})

    sent = blocks.select("lang", "codes", "ids").mapInArrow(count, "part long, packed binary")
    return sent.groupBy("part").applyInArrow(add, "state long, word long, n long")


def _dense_ids(words: DataFrame, run: RunFolder) -> DataFrame:
    """``word`` and ``id`` from 0 without gaps: the place in a stored partition after those before it."""
    placed = run.keep(words.withColumn("at", F.monotonically_increasing_id()), "numbers")
    part = F.shiftright("at", 33)
    sizes = sorted((r[0], r[1]) for r in placed.groupBy(part.alias("p")).count().collect())  # one row a partition
    before, rows = 0, []
    for p, n in sizes:
        rows.append((p, before))
        before += n
    offsets = words.sparkSession.createDataFrame(rows, "p long, before long")
    return placed.join(F.broadcast(offsets), part == F.col("p")).select("word", (F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1)).alias("id"))


def _numbers(blocks: DataFrame, numbered: DataFrame, ranges: int) -> DataFrame:
    """``block`` and ``reply``: place and id of those of a block's words that have one, in one row for each range that knows any.

    Words are dealt over ``ranges`` by their CRC; a range looks up the lists of all blocks in its part of the words.
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, cell in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = cell.values
                if not words:
                    continue
                crc = np.fromiter(map(zlib.crc32, words.cast(pa.binary()).to_pylist()), dtype=np.int64, count=len(words))
                order = np.argsort(crc % ranges, kind="stable")
                part, first = np.unique((crc % ranges)[order], return_index=True)
                cuts = pa.array(np.append(first, len(order)), pa.int32())
                columns = [
                    pa.array(part),
                    pa.array(np.full(len(part), block)),
                    pa.ListArray.from_arrays(cuts, pa.array(order, pa.int32())),
                    pa.ListArray.from_arrays(cuts, words.take(pa.array(order))),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "block", "at", "words"])

    def answer(asked: pa.Table, known: pa.Table) -> pa.Table:
        sizes = pc.list_value_length(asked.column("words")).to_numpy()
        found = pc.index_in(pc.list_flatten(asked.column("words")), value_set=known.column("word")).to_numpy()
        has = ~np.isnan(found)
        at = pc.list_flatten(asked.column("at")).to_numpy()[has]
        ids = known.column("id").to_numpy()[found[has].astype(np.int64)] if has.any() else np.zeros(0, np.int64)
        ends = np.concatenate([[0], np.cumsum(has)])[np.concatenate([[0], np.cumsum(sizes)])]
        reply = pa.StructArray.from_arrays([pa.array(at, pa.int32()), pa.array(ids, pa.int64())], names=["at", "id"])
        made = pa.table({"block": asked.column("block"), "reply": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), reply)})
        return made.filter(pa.array(np.diff(ends) > 0))

    asked = blocks.select("block", "words").mapInArrow(ask, "part long, block long, at array<int>, words array<string>")
    known = numbered.select((F.crc32(F.col("word").cast("binary")) % ranges).alias("part"), "word", "id")
    return asked.groupBy("part").cogroup(known.groupBy("part")).applyInArrow(answer, "block long, reply array<struct<at:int,id:long>>")


def frequent_phrases(
    docs: DataFrame, run: RunFolder, text_col: str, lang_col: str, least: int, longest: int, trie_phrases: int = TRIE_PHRASES
) -> tuple[DataFrame, DataFrame]:
    """``lang``, ``phrase`` (its words), ``f`` of all phrases of up to ``longest`` words that occur ``least`` times; and ``lang``, ``n`` words."""
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = run.keep_bucketed(_blocks(docs, text_col, lang_col), "words", "block", buckets)
    by_word = blocks.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("x")).groupBy("lang", F.col("x.words").alias("word"))
    totals = run.keep(blocks.select("lang", F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x).alias("n")).groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    single = run.keep(by_word.agg(F.sum("x.counts").alias("f")).where(F.col("f") >= least), "single")
    numbered = _dense_ids(single.select("word").distinct(), run)
    ranges = max(1, -(-int(totals.agg(F.sum("n")).first()[0] or 0) // RANGE_WORDS))
    # Every block learns the numbers of its frequent words.
    reply = _numbers(blocks, numbered, ranges).groupBy("block").agg(F.flatten(F.collect_list("reply")).alias("reply"))
    joined = blocks.select("block", "lang", F.size("words").alias("n"), "codes").join(reply, "block", "left")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for n, cell in zip(batch.column(1).to_pylist(), batch.column(3), strict=True):
                ids = np.full(n + 1, -1, dtype=np.int64)  # number 0 is the sign between pieces
                if cell.is_valid:
                    at, found = (x.to_numpy(zero_copy_only=False) for x in cell.values.flatten())
                    ids[at + 1] = found
                made.append(ids)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(made, pa.list_(pa.int64()))], names=["lang", "codes", "ids"])

    coded = run.keep(joined.select("lang", "n", "codes", "reply").mapInArrow(number, "lang string, codes binary, ids array<bigint>"), "coded")

    frequent = single.join(numbered, "word").select("lang", F.array("id").alias("words"))
    n_words = single.select("word").distinct().count()
    found: list[DataFrame] = []
    for length in range(1, longest + 1):
        frequent = run.keep(frequent, f"phrases{length}")
        total = frequent.count()
        if total == 0:
            break
        shards = -(-total // trie_phrases)
        tries = run.keep(_tries(frequent, shards), f"tries{length}")
        parts: DataFrame | None = None
        for shard in range(shards):
            row = tries.where(F.col("shard") == shard).select("langs", "ids", "ranks", "base", "check").first()
            if row is None:
                continue
            trie = spark.sparkContext.broadcast((list(row.langs), *[bytes(x) for x in row[1:]]))
            counted = _count(coded, trie, length, shards == 1, length < longest, n_words, least, ranges)
            counts = run.keep(counted, f"counts{length}_{shard}")
            trie.unpersist()
            leaves = tries.where(F.col("shard") == shard).select(F.explode("leaves").alias("x")).select("x.*")
            told = counts.join(leaves, "state").select("lang", "words", "word", "n")
            parts = told if parts is None else parts.unionByName(told)
        found.append(parts.where(F.col("word") < 0).select("lang", "words", F.col("n").alias("f")))
        frequent = parts.where(F.col("word") >= 0).select("lang", F.concat("words", F.array("word")).alias("words"))
    if not found:
        return spark.createDataFrame([], "lang string, phrase array<string>, f long"), totals
    phrases = found[0]
    for more in found[1:]:
        phrases = phrases.unionByName(more)
    # Words again as text.
    phrases = run.keep(phrases.withColumn("key", F.monotonically_increasing_id()), "found")
    spelled = phrases.select("key", F.posexplode("words").alias("at", "id")).join(numbered, "id").groupBy("key").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("x"))
    return run.keep(phrases.join(spelled, "key").select("lang", F.col("x.word").alias("phrase"), "f"), "spelled"), totals


def _joined(words: Column) -> Column:
    return F.concat_ws(" ", words)


def collocations(
    docs: DataFrame,
    run: RunFolder,
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = 100,
    longest: int = 5,
    first: int | None = 2000,
    same_percent: int = 100,
    trie_phrases: int = TRIE_PHRASES,
) -> DataFrame:
    """The best phrases of each language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    A phrase of 2 to ``longest`` words inside a piece that occurs ``a >= least``
    times is cut where ``floor(1000 * a * n / (l * r))`` is lowest (ties: the
    shortest first part); ``l`` and ``r`` count the parts and ``n`` all words of the
    language.  It goes if a longer one that holds it has ``same_percent`` percent
    of its count or more.  Each language's ``first`` phrases (all: ``None``) come by
    score, count (both falling) and phrase.

    Null texts have no words, null languages are ``und`` and repeated rows count
    each.  A text of any length is cut in one task, its words are one block.  No
    text with words gives no rows.
    """
    phrases, totals = frequent_phrases(docs, run, text_col, lang_col, least, longest, trie_phrases)
    known = run.keep(phrases.select("lang", _joined(F.col("phrase")).alias("phrase"), F.col("phrase").alias("words"), "f"), "known")
    several = known.where(F.size("words") > 1)
    look = known.select("lang", "phrase", "f")

    cuts = several.select("lang", "phrase", "words", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", _joined(F.slice("words", 1, F.col("k"))).alias("left"), _joined(F.slice("words", F.col("k") + 1, F.size("words"))).alias("right"))
    parts = cuts.join(look.toDF("lang", "left", "l"), ["lang", "left"]).join(look.toDF("lang", "right", "r"), ["lang", "right"]).join(totals, "lang")
    # 4 + 15 + 17 and 17 + 17 digits: products stay exact below 38.
    parts = parts.withColumn(
        "score",
        F.expr(
            "CAST(1000 AS DECIMAL(4,0)) * CAST(a AS DECIMAL(15,0)) * CAST(n AS DECIMAL(17,0))"
            " DIV (CAST(l AS DECIMAL(17,0)) * CAST(r AS DECIMAL(17,0)))"
        ),
    )
    lowest = parts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("x"))

    inner = several.where(F.size("words") > 2).select("lang", "f", "words", F.explode(F.sequence(F.lit(2), F.size("words") - 1)).alias("size"))
    inner = inner.select("lang", "f", "words", "size", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("size") + 1)).alias("at"))
    inner = inner.select("lang", "f", _joined(F.slice("words", F.col("at"), F.col("size"))).alias("phrase"))
    most = inner.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    kept = lowest.join(most, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < same_percent * F.col("a")))
    kept = kept.select("lang", "phrase", "a", "x.l", "x.r", "n", "x.score")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc())
    ranked = kept.withColumn("rank", F.row_number().over(order))
    ranked = ranked if first is None else ranked.where(F.col("rank") <= first)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
