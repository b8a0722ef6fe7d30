import hashlib
import random

import numpy as np
import pytest
from conftest import phrases

from drayline.llm import blocks
from drayline.llm.suffix_dedup import growing_lengths, repeated_spans


def brute(texts, size):
    raw = [(t or "").encode() for t in texts]
    seen = {}
    for b in raw:
        for i in range(len(b) - size + 1):
            seen[b[i : i + size]] = seen.get(b[i : i + size], 0) + 1
    out = []
    for b in raw:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - size + 1):
            if seen[b[i : i + size]] > 1:
                gone[i : i + size] = True
        spans = int((gone[:-1] & ~np.concatenate([[False], gone[:-1]])[:-1]).sum())
        kept = bytes(x for x, g in zip(b, gone, strict=False) if not g)
        out.append((len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("size,base", [(20, None), (20, 5), (7, 7)])
def test_against_brute_force(spark, run, monkeypatch, size, base):
    monkeypatch.setattr(blocks, "RANGE_BYTES", 3000)  # several ranges
    rnd = random.Random(size)
    parts = phrases(size, list("abé d"), 5, 60)
    texts = ["".join(rnd.choice([*parts, "x", f"y {rnd.random()}"]) for _ in range(rnd.randrange(0, 12))) for _ in range(40)]
    texts += [None, "", "a" * 500, "ab" * 30, "q" * 19, "q" * 19, *["same text here which is long enough " * 5] * 3, "same text here which is long enough " * 4]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = repeated_spans(df, run, threshold=size, base=base).orderBy("doc_id").collect()
    assert [(g.n_bytes, g.n_removed, g.n_spans, g.kept_sha256) for g in got] == brute(texts, size)
    for g in got:
        raw = (texts[g.doc_id] or "").encode()
        kept, at = b"", 0
        for a, b in g.spans:
            kept, at = kept + raw[at:a], b
        assert g.kept == (None if texts[g.doc_id] is None else (kept + raw[at:]).decode(errors="ignore"))


def test_a_copy_stands_for_the_others(spark, run):
    passage = "".join(f"w{i} " for i in range(80))
    rows = [(1, passage), (2, passage), (3, "head " + passage + "tail"), (4, "clean " * 10)]
    got = {r.doc_id: r.n_removed for r in repeated_spans(spark.createDataFrame(rows, "doc_id long, text string"), run, want_text=False).collect()}
    assert got == {1: len(passage), 2: len(passage), 3: len(passage) , 4: 0}


def test_lengths():
    assert growing_lengths(50, 200) == [50, 100, 200]
    assert growing_lengths(100, 150) == [100, 150]
    with pytest.raises(ValueError):
        repeated_spans(None, None, threshold=5, base=6)


def test_messy_and_empty(messy, nothing, run, spark):
    got = repeated_spans(messy, run).collect()
    assert len(got) == 10 and "block" in got[0].asDict()
    assert {r.doc_id: r.n_removed for r in got if r.doc_id in (1, 2, 6, 8)} == {1: 0, 2: 0, 6: 25000, 8: 3000}
    from drayline.session import RunFolder

    other = RunFolder(spark, "test")
    assert repeated_spans(nothing, other).collect() == []
    other.close()
