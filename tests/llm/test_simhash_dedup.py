import random
import re

import pytest
import xxhash
from drayline.llm.components import components
from drayline.llm.simhash_dedup import ball, fingerprint_of, keep_one, links, near_duplicates
from drayline.session import RunFolder


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), 42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(monkeypatch):
    from drayline.llm import simhash_dedup

    rnd = random.Random(1)
    texts = ["", " \n", "One", "One two", "É ß\x0bIJ KL", "a\x85b c d e"]
    texts += ["".join(rnd.choice(["Ab", "c", " ", "\n", "é", "zz "]) for _ in range(200)) for _ in range(30)]
    monkeypatch.setattr(simhash_dedup, "STRETCH", 7)  # stretches of long texts
    for text in texts:
        assert fingerprint_of(text.encode()) == brute(text)


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_links_connect_all_within_the_radius(spark, run, radius):
    rnd = random.Random(radius)
    values = set()
    for _ in range(20):
        centre = rnd.getrandbits(64)
        values.add(centre)
        values.update(centre ^ sum(1 << b for b in rnd.sample(range(64), rnd.randrange(0, 6))) for _ in range(6))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    near = links(df, radius)
    assert all(bin((r.a ^ r.b) & (2**64 - 1)).count("1") <= radius for r in near.collect())
    got = {r.vertex: r.component for r in components(near, run).collect()}
    parent = {v: v for v in signed}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in signed:
        for b in signed:
            if a < b and bin((a ^ b) & (2**64 - 1)).count("1") <= radius:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    assert {v: got.get(v, v) for v in signed} == {v: find(v) for v in signed}
    assert len(ball(1)) == 65


def test_components_of_a_long_path_and_a_star(spark, run):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 200)] + [(7, 7), (None, 3)]
    got = {r.vertex: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), run).collect()}
    assert got == {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(200)}


def test_messy_and_empty(messy, nothing, run, spark):
    got = near_duplicates(messy, run).collect()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == 10 and by_id[1].fingerprint == by_id[2].fingerprint == 0 and by_id[3].component_id == 1
    other = RunFolder(spark, "test")
    assert near_duplicates(nothing, other).collect() == []
    other.close()
    third = RunFolder(spark, "test")
    kept = keep_one(messy, third)
    assert kept.columns == messy.columns
    assert sorted((r.doc_id is None, r.doc_id) for r in kept.collect())[:3] == [(False, 1), (False, 5), (False, 6)]
    assert sum(r.doc_id == 5 for r in kept.collect()) == 1
    third.close()
