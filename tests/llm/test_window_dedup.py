import hashlib
import random
import re

import pytest

from drayline.llm import blocks
from drayline.llm.window_dedup import repeated_windows
from drayline.session import RunFolder


def brute(rows, size):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    key = lambda d: float("inf") if d is None else d
    least = {}
    for (d, _), w in zip(rows, words, strict=True):
        for i in range(len(w) - size + 1):
            window = tuple(w[i : i + size])
            least[window] = min(least.get(window, float("inf")), key(d))
    out = []
    for (d, _), w in zip(rows, words, strict=True):
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if least[tuple(w[i : i + size])] < key(d):
                gone[i : i + size] = [True] * size
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("size,gram,hot", [(6, 3, 2000), (6, 2, 2), (6, 6, 0), (50, 20, 2000)])
def test_against_brute_force(spark, run, monkeypatch, size, gram, hot):
    monkeypatch.setattr(blocks, "RANGE_BYTES", 3000)
    rnd = random.Random(size)
    parts = [" ".join(rnd.choice(["ab", "é", "cde", "f\x0bg", "h i"]) for _ in range(rnd.randrange(3, 14))) + rnd.choice([" ", "\n", "  "]) for _ in range(6)]
    texts = ["".join(rnd.choice([*parts, "x ", f"y{rnd.random()}\t"]) for _ in range(rnd.randrange(0, 12))) for _ in range(40)]
    texts += [None, "", "a " * 300, "a\n" * 200, " q", *[" ".join(f"same{i}" for i in range(120))] * 3]
    rows = [(None if i % 17 == 5 else i // 2 * 2 if i < 10 else i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = repeated_windows(df, run, window=size, gram=gram, hot_above=hot, want_text=False)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, size)


def test_messy_and_empty(messy, nothing, run, spark):
    got = repeated_windows(messy, run).collect()
    assert len(got) == 10 and {r.n_removed for r in got} == {0}
    assert {r.doc_id: r.kept for r in got}[1] is None and got[0].asDict().keys() >= {"block", "n_bytes", "kept"}
    other = RunFolder(spark, "test")
    assert repeated_windows(nothing, other).collect() == []
    other.close()
