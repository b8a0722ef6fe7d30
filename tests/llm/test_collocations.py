"""Phrase counts and scores against a plain count."""

import collections
import random
import re

import numpy as np
import pytest

from drayline.llm import collocations as module
from drayline.llm.collocations import DoubleArray, collocations, words_of
from drayline.session import RunFolder

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, longest=5, first=2000, percent=100):
    f, n = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\\x0A-\\x0D]", (text or "").translate(LOWER)):
            words = re.findall("[^\\x20\\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    f = {p: c for p, c in f.items() if c >= least}
    longer = collections.defaultdict(int)
    for (lang, p), c in f.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                longer[lang, p[i : i + k]] = max(longer[lang, p[i : i + k]], c)
    out = collections.defaultdict(list)
    for (lang, p), a in f.items():
        if len(p) > 1 and 100 * longer[lang, p] < percent * a:
            score, _, l, r = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
            out[lang].append((-score, -a, " ".join(p).encode(), l, r))
    rows = []
    for lang, found in out.items():
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:first], 1):
            rows.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(rows)


def corpus(seed, n=120):
    rnd = random.Random(seed)
    words = ["New", "york", "CITY", "the", "of", "É", "é", "漢字", "a-b", "x\u00a0y", "\x1c", "z"]
    fixed = ["new york city", "of the new york", "a b c d e f g", "é É"]
    text = lambda: "".join(rnd.choice([*words, *fixed]) + rnd.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r\n", "?!", "\x0b"]) for _ in range(rnd.randrange(0, 40)))
    return [(text(), rnd.choice(["en", "en", "fr", "", None, "und"])) for _ in range(n)]


@pytest.mark.parametrize("seed,least,trie,block", [(1, 3, 1_000_000, 4 << 20), (2, 6, 25, 300), (3, 4, 200, 1), (4, 10_000, 10, 300)])
def test_against_brute_force(spark, run, monkeypatch, seed, least, trie, block):
    monkeypatch.setattr(module, "BLOCK_BYTES", block)
    monkeypatch.setattr(module, "OPEN_BYTES", 3 * block)
    monkeypatch.setattr(module, "HELD_CANDIDATES", 5)
    monkeypatch.setattr(module, "RANGE_WORDS", 70)
    rows = corpus(seed, 40 if trie < 50 else 120)
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    got = sorted(map(tuple, collocations(docs, run, least=least, trie_phrases=trie).collect()))
    assert got == brute(rows, least)


def test_first_and_share(spark, run):
    rows = corpus(9)
    docs = spark.createDataFrame(rows, "text string, lang string")
    got = sorted(map(tuple, collocations(docs, run, least=2, longest=3, first=4, same_percent=60).collect()))
    assert got == brute(rows, 2, 3, 4, 60) and len(got) > 8


def test_products_past_64_bits(spark):
    row = spark.createDataFrame([(10**13, 10**16, 3, 7)], "a long, n long, l long, r long").selectExpr(
        "CAST(1000 AS DECIMAL(4,0)) * CAST(a AS DECIMAL(15,0)) * CAST(n AS DECIMAL(17,0)) % (CAST(l AS DECIMAL(17,0)) * CAST(r AS DECIMAL(17,0))) AS m",
        "CAST(1000 AS DECIMAL(4,0)) * CAST(a AS DECIMAL(15,0)) * CAST(n AS DECIMAL(17,0)) DIV (CAST(a AS DECIMAL(17,0)) * CAST(n * 9 AS DECIMAL(17,0))) AS s",
    )
    assert tuple(row.first()) == (1000 * 10**29 % 21, 111)


def test_words():
    assert words_of("New\tYork, CITY\u00c9.\r\nx") == [b"new", b"york", b"\n", b"city\xc3\x89", b"\n", b"\n", b"\n", b"x"]
    assert words_of("") == [] and words_of(" \t") == []


def test_double_array():
    rng = np.random.default_rng(5)
    for _ in range(20):
        phrases = np.unique(rng.integers(0, 30, (400, 3)), axis=0)
        roots = rng.integers(0, 3, len(phrases))
        trie, ends = DoubleArray.build(roots, phrases, 3, 30)
        assert len(set(ends.tolist())) == len(phrases)
        for root in range(3):
            words = rng.integers(-1, 30, 3000)
            at, states = trie.advance(root, words, 3)
            known = {tuple(p): s for p, s, r in zip(phrases.tolist(), ends.tolist(), roots.tolist(), strict=True) if r == root}
            expected = [(i, known[tuple(words[i : i + 3])]) for i in range(2998) if tuple(words[i : i + 3]) in known]
            assert list(zip(at.tolist(), states.tolist(), strict=True)) == expected


def test_messy_and_empty(spark, run, messy, nothing):
    docs = messy.withColumnRenamed("block", "words").withColumnRenamed("n_bytes", "state")
    rows = [(r.text, r.words) for r in docs.collect()]
    assert sorted(map(tuple, collocations(docs, run, "text", "words", least=2).collect())) == brute(rows, 2)
    other = RunFolder(spark, "test")
    assert collocations(nothing, other, "text", "block").collect() == []
    other.close()


@pytest.mark.parametrize("ranges", [1, 3, 500])
def test_words_are_numbered_in_lists(spark, ranges):
    """A block asks each range once, so what is looked up is no row for each block and word."""
    rnd = random.Random(ranges)
    words = ["é", "漢字", "\x1c", *(f"w{i}" for i in range(200))]
    blocks = [(b << 32, rnd.sample(words, rnd.choice([0, 1, 90, 200]))) for b in range(12)] + [(99, ["nobody", "knows"])]
    ids = {w: i * 7 for i, w in enumerate(words) if i % 3 and w != "nobody"}
    numbered = spark.createDataFrame(list(ids.items()), "word string, id long")
    made = module._numbers(spark.createDataFrame(blocks, "block long, words array<string>"), numbered, ranges)
    replies = [(r["block"], sorted(map(tuple, r["reply"]))) for r in made.collect()]
    assert len(replies) <= len(blocks) * ranges and all(x for _, x in replies)
    got = {b: sorted(x for a, part in replies if a == b for x in part) for b, _ in blocks}
    assert got == {b: sorted((i, ids[w]) for i, w in enumerate(ws) if w in ids) for b, ws in blocks}
    assert "Join" not in made._jdf.queryExecution().executedPlan().toString()
