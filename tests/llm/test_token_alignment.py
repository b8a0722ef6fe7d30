"""Alignment against the libraries on whole texts and a plain count of links."""

import collections
import hashlib
import random

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")
import public_tokenizers  # noqa: E402
import sentencepiece  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from drayline.llm import token_alignment  # noqa: E402
from drayline.llm.token_alignment import align_tokens, byte_alphabet, intervals_to_groups, overlaps  # noqa: E402
from drayline.session import RunFolder  # noqa: E402

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def tokens(text):
    """(id, start, end) of both sides over the whole text, or nothing."""
    if not text:
        return [], []
    a, b = Tokenizer.from_file(BYTES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a.encode_special_tokens = True
    alphabet, out = byte_alphabet(), []
    a_ids = a.encode(" " + text, add_special_tokens=False).ids
    cells = [[(i, bytes(alphabet[c] for c in a.id_to_token(i))) for i in a_ids]]
    cells.append([(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)])
    if any(b"".join(x for _, x in side) != (" " + text).encode() for side in cells):
        return [], []
    for side in cells:
        at, made = 0, []
        for i, raw in side:
            made.append((i, at, at + len(raw)))
            at += len(raw)
        out.append(made)
    return tuple(out)


def brute(texts):
    sides = [tokens(t) for t in texts]
    linked = [[(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]] for a, b in sides]
    held = collections.Counter(p for x in linked for p in set(x))
    most = collections.defaultdict(int)
    for (a, _), n in held.items():
        most[a] = max(most[a], n)
    rows = []
    for (a, b), links in zip(sides, linked, strict=True):
        cuts = sorted({x[2] for x in a} & {x[2] for x in b})
        groups, low = [], 0
        for cut in cuts:
            inside = [",".join(str(x[0]) for x in s if low <= x[1] and x[2] <= cut) for s in (a, b)]
            groups.append("|".join(inside))
            low = cut
        told = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        rows.append((len(a), len(b), len(groups), len(links), sum(held[p] == most[p[0]] for p in links), sum(held[p] for p in links), told))
    return rows


SIGNS = ["word", "Wörter", "the", " ", "  ", "\n", "\n\n", "\t", ".", ",", "'s", "don't", "2024", "漢字", "é", "é", "😀", "<|endoftext|>", "<s>", "<0x41>", " ", "\x00", "\x1c", "\x85", "　", "   x", "aa", "\r\n", "​"]
COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def collected(df):
    return {r.doc_id: tuple(r[c] for c in COLUMNS) for r in df.collect()}


@pytest.mark.parametrize("block_bytes", [1, 300, 6 << 20])
def test_against_whole_texts(spark, run, monkeypatch, block_bytes):
    monkeypatch.setattr(token_alignment, "BLOCK_BYTES", block_bytes)
    rnd = random.Random(7)
    texts = ["".join(rnd.choice(SIGNS) + rnd.choice(["", " "]) for _ in range(rnd.randrange(1, 30))) for _ in range(60)]
    texts += [None, "", " ", "  ", "\n", "a ▁ b", "plain words here", "plain words here", "x" * 300, "one▁two three"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert collected(align_tokens(docs, run, BYTES, PIECES)) == dict(enumerate(brute(texts)))


def test_cache_generations(monkeypatch):
    monkeypatch.setattr(token_alignment, "CACHED_STRETCHES", 5)
    rnd = random.Random(3)
    small, plain = token_alignment.Aligner(BYTES, PIECES), token_alignment.Aligner(BYTES, PIECES)
    for _ in range(60):
        texts = ["".join(rnd.choice(SIGNS) + " " for _ in range(9)) for _ in range(3)]
        got = [[small.known[c] for c in parts] for parts in small.stretches(texts)]
        whole = [plain.align([t])[0] for t in texts]
        for k in (1, 2):
            sign = (b"", b"", b";")[k]
            assert [sign.join(token_alignment.unpack(x)[k] for x in parts) for parts in got] == [token_alignment.unpack(x)[k] if x else b"" for x in whole]


def test_faster_library_gives_the_same_ids():
    aligner = token_alignment.Aligner(BYTES, PIECES)
    rnd = random.Random(11)
    signs = [*map(chr, range(33, 127)), *"ÀÖØöøÿß", "'s", "'LL", "don't", "word", "Word", "12"]
    for _ in range(3000):
        part = " " + " ".join("".join(rnd.choice(signs) for _ in range(rnd.randrange(1, 9))) for _ in range(4))
        assert aligner.ranked.encode_ordinary(part) == aligner.a.encode(part, add_special_tokens=False).ids


def test_groups_and_overlaps():
    start, end, kind = np.array([0, 2, 5, 0, 5]), np.array([2, 5, 6, 5, 6]), np.array([0, 0, 0, 1, 1])
    order, group = intervals_to_groups(start, end, kind)
    assert order.tolist() == [0, 3, 1, 2, 4] and group.tolist() == [0, 0, 0, 1, 1]
    left, right = overlaps(start[:3], end[:3], start[3:], end[3:])
    assert list(zip(left.tolist(), right.tolist(), strict=True)) == [(0, 0), (1, 0), (2, 1)]


def test_messy_and_empty(spark, run, messy, nothing):
    got = align_tokens(messy.withColumnRenamed("block", "n_a"), run, BYTES, PIECES, want_groups=True)
    assert got.columns == ["doc_id", "n_bytes", *COLUMNS, "groups"]
    rows = got.collect()
    texts = [r.text for r in messy.orderBy("n_bytes").collect()]
    by_row = {r.n_bytes: tuple(r[c] for c in COLUMNS) for r in rows if r.n_bytes is not None}
    expected = brute(texts)
    listed = messy.orderBy("n_bytes").collect()
    assert len(rows) == 10 and all(by_row[r.n_bytes] == e for r, e in zip(listed, expected, strict=True) if r.n_bytes is not None)
    other = RunFolder(spark, "test")
    assert align_tokens(nothing, other, BYTES, PIECES).collect() == []
    other.close()


def test_only_a_text_column(spark, run):
    got = align_tokens(spark.createDataFrame([("two words",), (None,)], "text string"), run, BYTES, PIECES, want_groups=True).collect()
    assert sorted((r.n_a, r.groups) for r in got)[0] == (0, "") and len(got) == 2


def test_stretches_and_different_values():
    """Plain splitting finds what the expression for blanks beside white space finds; sorted values are those of a set."""
    import random
    import re

    import numpy as np

    from drayline.llm import token_alignment as module

    other = re.compile(r"  |[^\S ] | [^\S ]|\A | \Z")
    rnd = random.Random(5)
    for _ in range(3000):
        text = "".join(rnd.choice(["a", "é", " ", " ", "\n", " ", "\xa0", "\x1c", "\x85", "漢", "　"]) for _ in range(rnd.randrange(9)))
        expected = module._PLAIN_BLANK.split(text) if other.search(text) else text.split(" ")
        assert module.plain_stretches(text) == expected, repr(text)
        values = np.array([rnd.randrange(6) for _ in range(rnd.randrange(9))], dtype=np.int64)
        assert module._different(values).tolist() == sorted(set(values.tolist()))
