"""The pipeline against brute-force versions of its stages, and the registered names."""

import collections
import random

import pytest

pytest.importorskip("public_tokenizers")
import public_tokenizers  # noqa: E402
from test_simhash_dedup import brute as fingerprint  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

import corpus_pipeline  # noqa: E402


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(4)
    words = {"en": ["the", "and", "thing", "rather", "other"], "de": ["der", "und", "nicht", "schön", "werden"]}
    prose = lambda lang, n: " ".join(rnd.choice(words[lang]) + rnd.choice("abcdefgh") for _ in range(n)) + "."
    passage = prose("en", 60)
    out = [(i, prose(lang, rnd.randrange(5, 80)), lang) for i, lang in enumerate(["en", "de"] * 60)]
    out += [(200, None, "en"), (201, "", "de"), (202, "123 456 !!", "en"), (203, " ".join("qxzjk" * 3 for _ in range(60)), None)]
    out += [(300 + i, out[5][1], "de") for i in range(4)]  # copies
    out += [(400, passage + " " + prose("en", 20), "en"), (401, prose("en", 30) + " " + passage, "en"), (402, passage, "en")]
    big = prose("en", 3000)
    out += [(500, big, "en"), (501, big + " one word more", "en")]  # a near copy
    return [(d, t, lang, "src", None if t is None else len(t)) for d, t, lang in out]


def cut(texts, size=200):
    raw = [t.encode() for t in texts]
    seen = collections.Counter(b[i : i + size] for b in raw for i in range(len(b) - size + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - size + 1):
            if seen[b[i : i + size]] > 1:
                gone[i : i + size] = b"\1" * size
        out.append((bytes(x for x, g in zip(b, gone, strict=True) if not g).decode(errors="ignore"), any(gone)))
    return out


def test_against_brute_force(spark, tmp_path, rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    stay = [(r[0], r[1]) for r in rows if r[0] not in (200, 201, 202, 203)]
    prints = {d: fingerprint(t) for d, t in stay}
    parent = {d: d for d, _ in stay}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in parent:
        for b in parent:
            if a < b and bin(prints[a] ^ prints[b]).count("1") <= 2:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    stay = [(d, t) for d, t in stay if find(d) == d]
    assert {300, 301, 302, 303, 501}.isdisjoint(d for d, _ in stay)
    left = [(d, new) for (d, _), (new, touched) in zip(stay, cut([t for _, t in stay]), strict=True) if not touched or new.strip(" ")]
    assert dict(left).get(402) is None  # nothing of it is left

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = {d: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for d, t in left}
    packed, sequences = collections.Counter(), collections.Counter()
    for r in got:
        packed[r.doc_id] += r.length
        sequences[r.sequence_id] += r.length
    assert packed == expected and max(sequences.values()) <= 4096


def test_stages_keep_columns_and_handle_nothing(spark, rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept array<int>, score string, row int"
    empty = spark.createDataFrame([], schema)
    docs = spark.createDataFrame([(*r, [1], 'mine', 7) for r in rows[:20]] + [(None,) * 8] * 2, schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, empty, "").collect() == []
        made = stage(spark, docs, "")
        assert made.columns == docs.columns and made.dtypes == docs.dtypes and made.count() >= 15
        assert made.where("score IS NOT NULL").select("kept", "score", "row").distinct().collect() == [([1], "mine", 7)]
    assert corpus_pipeline.STAGES[-1][1](spark, empty, "").collect() == []
    corpus_pipeline.finish_stages()


def test_pipelines_side_by_side_leave_nothing(spark, tmp_path, rows):
    from concurrent.futures import ThreadPoolExecutor
    from pathlib import Path

    from drayline.session import shared_dir

    schema = "doc_id long, text string, lang string, source string, n_chars long"
    corpus_pipeline.finish_stages()
    tables = {t.name for t in spark.catalog.listTables()}
    for k in range(2):
        spark.createDataFrame(rows[60 * k :], schema).write.parquet(f"{tmp_path}/{k}/documents.parquet")
    folders = lambda: {p.name for p in Path(shared_dir(spark)).iterdir() if not p.name.endswith("-result")}
    before = folders()
    with ThreadPoolExecutor(2) as pool:
        first, second = pool.map(lambda k: corpus_pipeline.run(spark, f"{tmp_path}/{k}").count(), range(2))
    assert first > second > 0
    assert {t.name for t in spark.catalog.listTables()} == tables and folders() == before


def test_registered_names():
    import __spark_entry__ as entry

    numbers = {int(n[2:].split("_")[0]) for n in entry.queries() if n.startswith("op") and n[2].isdigit()}
    assert numbers == set(range(1, 14)) and "pipeline" in entry.queries()
    assert {"op1_suffix_dedup", "op5_embedding_dedup", "op6_window_dedup", "op12_collocations"} <= set(entry.oracle_sql())
