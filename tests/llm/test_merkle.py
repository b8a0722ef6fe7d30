import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from drayline.llm import merkle


def paragraphs(text):
    return re.split(r"(?<=\n)|(?<=[.!?] )", text) if text else []


def tree(text):
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    parts = paragraphs(text)
    codes, sections, open_ = [], [], ""
    for i, part in enumerate(parts):
        code = (xxhash.xxh64_intdigest(part.encode(), 42) << 20 & (1 << 64) - 1) | min(len(part), (1 << 20) - 1)
        codes.append(code)
        open_ += digest(part)
        if code >> 20 & 7 == 0 or i == len(parts) - 1:
            sections.append(digest(open_))
            open_ = ""
    return set(codes), digest("".join(sections))


def near(a, b):
    weigh = lambda s: sum(c & (1 << 20) - 1 for c in s)
    return 2.0 * weigh(a & b) / (weigh(a) + weigh(b)) if weigh(a) + weigh(b) else 1.0


@pytest.mark.parametrize("stretch", [300, 1 << 24])
def test_against_brute_force(spark, run, monkeypatch, stretch):
    monkeypatch.setattr(merkle, "STRETCH_BYTES", stretch)
    texts = ["", None, "One.", "é漢😀. " * 7, "Line one\nline two. And three! Four? " * 9, "a b. c d.\n" * 40, "x" * 500, "a b. c d.\n" * 39 + "new end."]
    rows = [(3 * i % 23, t) for i, t in enumerate(texts * 2)]
    got = sorted(map(tuple, merkle.edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), run).collect()))
    docs = {d: t or "" for d, t in rows}
    ids, expected = sorted(docs, reverse=True), []
    for k, doc in enumerate(ids):
        text, following = docs[doc], docs[ids[(k + 1) % len(ids)]]
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        (a, root), (b, other), (c, _) = tree(text), tree(edited), tree(following)
        expected.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), root, other, near(a, b), near(a, c)))
    assert got == sorted(expected)


def test_branches_locate_edits(spark):
    before = "".join(f"Paragraph {i}.\n" for i in range(100))
    after = before.replace("Paragraph 40.", "Paragraph forty.").replace("Paragraph 77.\n", "")
    df = spark.createDataFrame([(before, after)], "a string, b string")
    df = merkle.with_tree(merkle.with_tree(df, "a", "a_"), "b", "b_")
    row = df.select(merkle.changed_paragraphs("a_", "b_").alias("x"), merkle.changed_paragraphs("b_", "a_").alias("y"), F.size("a_sections").alias("n")).first()
    assert row.x == [40, 77] and row.y == [40] and row.n > 3


def test_messy_and_empty(messy, nothing, run):
    got = merkle.edited_fingerprints(messy, run).collect()
    assert len(got) == 10 and all(r.fingerprint for r in got)
    same = [r.fingerprint for r in got if r.doc_id == 5]
    assert same[0] == same[1] and len({r.fingerprint for r in got if r.doc_id in (1, 2)}) == 1
    assert merkle.edited_fingerprints(nothing, run).collect() == []
    plan = merkle.edited_fingerprints(messy, run)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_texts_without_sentences(spark, run):
    rnd = random.Random(3)
    letters = lambda alphabet, n: "".join(rnd.choice(alphabet) for _ in range(n))
    words = lambda n: " ".join(letters("abcdefghij", rnd.randrange(2, 9)) for _ in range(n))
    han = "".join(map(chr, range(0x4E00, 0x4F00)))
    texts = [words(80), words(3000), letters(han, 900), letters("abcdefgh0123", 4000), "".join(letters(han, 15) + "。" for _ in range(20)), "x" * 5000, "y z " * 800]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in merkle.edited_fingerprints(df, run).collect():
        assert r.near_edited > 0.4 and r.near_next < 0.1, r
    for text, (parts, codes) in zip(texts, ((r.parts, r.codes) for r in merkle.with_tree(df.withColumn("parts", merkle._paragraphs(F.col("text"))), "text", "").orderBy("doc_id").collect()), strict=True):
        assert "".join(parts) == text and max(map(len, parts)) <= merkle.LONGEST
        assert sum(c & merkle.LENGTH_MASK for c in codes) == len(text)  # the cap on a leaf's weight is not reached


def test_an_edit_inside_a_long_paragraph_stays_local(spark):
    rnd = random.Random(4)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randrange(2, 9))) for _ in range(1000)]
    rows = [(" ".join(words), " ".join([*words[:500], "inserted", *words[500:]])), ("".join(words), "".join([*words[:500], "i", *words[500:]]))]
    df = merkle.with_tree(merkle.with_tree(spark.createDataFrame(rows, "a string, b string"), "a", "a_"), "b", "b_")
    for r in df.select(merkle.likeness(F.col("a_codes"), F.col("b_codes")).alias("near"), merkle.changed_paragraphs("a_", "b_").alias("x"), F.size("a_codes").alias("n")).collect():
        assert r.near > 0.9 and 1 <= len(r.x) <= 3 and r.n > 50
