import numpy as np
import pytest

from drayline.llm import embedding_dedup
from drayline.llm.embedding_dedup import near_duplicates


def brute(rows, threshold):
    good = [i for i, (d, v) in enumerate(rows) if d is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    parent = {d: d for d, _ in rows if d is not None}
    links = dict.fromkeys(range(len(rows)), 0)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in good:
        for j in good:
            a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
            if i != j and len(a) == len(b) and (rows[i][1] == rows[j][1] or a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold):
                links[i] += 1
                x, y = find(rows[i][0]), find(rows[j][0])
                parent[max(x, y)] = min(x, y)
    return sorted(
        (str(d), links[i], str(find(d) if d is not None else None), d is None or find(d) == d) for i, (d, _) in enumerate(rows)
    )


@pytest.mark.parametrize("tile,width", [(4096, 24), (16, 24), (16, 1), (16, 2)])
def test_against_brute_force(spark, run, monkeypatch, tile, width):
    monkeypatch.setattr(embedding_dedup, "STRIP", 5)
    rng = np.random.default_rng(tile + width)
    centres = rng.normal(size=(25, width))
    vectors = [c + rng.normal(size=width) * s for c in centres for s in (0, 0.05, 0.12, 0.3, 1)]
    vectors += [centres[0] + rng.normal(size=width) * 0.01 for _ in range(40)]  # many near copies
    rows = [(1000 - i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    rows += [(5, None), (6, []), (7, [0.0] * width), (8, [None] * width), (9, [float("nan")] * width), (10, [float("inf")] * width)]
    rows += [(2000 + i, [float(x) for x in centres[1]]) for i in range(30)] + [(3000, [2 * float(x) for x in centres[1]]), (3001, [1.0, 0.0, 0.5] * 9)]
    rows += [(None, [1.0] * width)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = near_duplicates(df, run, tile=tile).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in got) == brute(rows, 0.95)


def test_tiles_out_of_reach_are_not_paired(spark):
    tiles = spark.createDataFrame([(i, i * 0.2, i * 0.2 + 0.1, 0.0, 0.05) for i in range(10)], "tile long, x0 double, x1 double, y0 double, y1 double")
    got = {(r.a, r.b) for r in embedding_dedup._pairs(tiles, 0.3163).collect()}
    assert got == {(i, j) for i in range(10) for j in range(i, 10) if (j - i) * 0.2 - 0.1 <= 0.3163}


def test_empty_and_only_bad(spark, run):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, ids string")
    assert near_duplicates(empty, run).collect() == []
    from drayline.session import RunFolder

    other = RunFolder(spark, "test")
    bad = spark.createDataFrame([(1, [0.0, 0.0]), (2, None)], "vec_id long, embedding array<float>")
    assert sorted(map(tuple, near_duplicates(bad, other).collect())) == [(1, 0, 1, True), (2, 0, 2, True)]
    other.close()


def test_components_of_any_finite_size(spark, run):
    shape = [3.0, -1.0, 2.0]
    rows = [(k, [x * size for x in shape]) for k, size in enumerate([1.0, 1e-200, 1e200, 5e307, 1e-320])]
    rows += [(10, [1e-200, 1e-200, 0.0]), (11, [1e-200, 1e-200, 0.0]), (12, [-1.0, -3.0, 2e200]), (13, [-0.0, 0.0, 0.0]), (14, [-0.0, 0.0, 0.0])]
    got = near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), run).collect()
    links = {0: 4, 1: 4, 2: 4, 3: 4, 4: 4, 10: 1, 11: 1}
    assert sorted(map(tuple, got)) == [(d, links.get(d, 0), 0 if d < 5 else 10 if d == 11 else d, d not in (1, 2, 3, 4, 11)) for d, _ in rows]
