import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from drayline.llm.language_id import END, ORDER, START, UNSEEN, build, fit, grams_of, predict

WORDS = {"aa": ["the", "and", "thing", "rather", "other", "this"], "bb": ["der", "und", "nicht", "schön", "werden", "über"]}


def sentence(rnd, lang, n):
    return " ".join(rnd.choice(WORDS[lang]) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="module")
def labelled(spark):
    rnd = random.Random(1)
    rows = [(i, sentence(rnd, lang, rnd.randrange(1, 60)), lang) for i in range(150) for lang in WORDS]
    rows += [(900, None, "aa"), (901, "no label", None), (902, "", "bb"), (903, "123", "cc")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)


def test_probabilities_against_a_plain_model():
    words = ["the", "then", "than", "the", "hat"]
    grams, counts = np.unique(grams_of(words)[0], axis=0, return_counts=True)
    model = build("aa", grams, counts)
    tables = {ORDER: Counter({tuple(g): int(c) for g, c in zip(grams.tolist(), counts.tolist(), strict=True)})}
    for n in range(ORDER - 1, 0, -1):
        tables[n] = Counter(g[1:] for g in tables[n + 1])

    def probability(gram):
        n = len(gram)
        if n == 0:
            return 1.0 / UNSEEN
        table = tables[n]
        once, twice = (sum(c == k for c in table.values()) for k in (1, 2))
        discount = min(max(once / max(once + 2 * twice, 1), 0.1), 0.95)
        following = {g: c for g, c in table.items() if g[:-1] == gram[:-1]}
        total = sum(following.values())
        if not total:
            return probability(gram[1:])
        return max(table.get(gram, 0) - discount, 0) / total + discount * len(following) / total * probability(gram[1:])

    for word in ("the", "hath", "zebra"):
        rows = grams_of([word])[0]
        assert np.allclose(np.exp(model.log_probabilities(rows)), [probability(tuple(g)) for g in rows.tolist()])
    symbols = {g[-1] for g in tables[1]}
    start = (START,) * (ORDER - 1)
    assert sum(probability((*start, s)) for s in symbols) < 1
    assert END in symbols


def test_accuracy_rejection_and_order(spark, labelled):
    models = fit(labelled)
    assert [m.lang for m in models] == ["aa", "bb"]
    rnd = random.Random(2)
    rows = [(i, sentence(rnd, lang, rnd.randrange(1, 40)), lang) for i in range(60) for lang in WORDS]
    got = predict(spark.createDataFrame(rows, "doc_id long, text string, lang string"), models).collect()
    assert all(r.lang_pred == r.lang and not r.rejected and 0 <= r.score <= 1 for r in got)
    noise = ["".join(rnd.choice("qxzjkvwyçñ") for _ in range(9)) + " " for _ in range(80)]
    odd = predict(spark.createDataFrame([(1, "".join(noise))], "doc_id long, text string"), models).first()
    assert odd.rejected and odd.lang_pred in ("aa", "bb")


def test_sample_is_bounded(labelled):
    few = fit(labelled, sample_docs=5)
    assert len(few) == 2 and all(math.isfinite(m.bound) for m in few)


def test_messy_and_empty(spark, messy, nothing, labelled):
    models = fit(labelled)
    got = predict(messy.withColumnRenamed("block", "lang_pred"), models).collect()
    by_id = defaultdict(list)
    for r in got:
        by_id[r.doc_id].append(r)
    assert len(got) == 10 and all(by_id[i][0].lang_pred == "und" and by_id[i][0].score == 0 and by_id[i][0].rejected for i in (1, 2, 3, 9))
    assert by_id[5][0] == by_id[5][1]
    assert predict(nothing, models).collect() == []
    assert fit(nothing.withColumnRenamed("block", "lang")) == []
    assert {r.lang_pred for r in predict(messy, []).collect()} == {"und"}


def test_languages_of_few_texts(spark, labelled):
    rnd = random.Random(5)
    letters = {"one": "abcdefg", "two": "hijklmn", "six": "opqrstu", "odd": "vwxyz"}
    prose = lambda lang, n: " ".join("".join(rnd.choice(letters[lang]) for _ in range(rnd.randrange(2, 5))) for _ in range(n))
    for trial in range(4):  # whether a text is counted and another calibrates is not left to chance
        rows = [(1, prose("one", 300), "one"), *[(k, prose("two", 300), "two") for k in range(2)], *[(k, prose("six", 300), "six") for k in range(6)]]
        rows += [(7, t, "odd") for t in [prose("odd", 300)] * 2]  # equal texts do not calibrate each other
        rows += [(8 + k, "12 34", "two") for k in range(5)]  # without a letter
        models = fit(labelled.unionByName(spark.createDataFrame(rows, "doc_id long, text string, lang string")))
        assert [m.lang for m in models] == ["aa", "bb", "odd", "one", "six", "two"]
        by_lang = {m.lang: m for m in models}
        assert all(m.centre > 0 and math.isfinite(m.bound) for m in (by_lang["six"], by_lang["two"], by_lang["aa"]))
        assert all(math.isinf(by_lang[x].bound) for x in ("one", "odd"))
        more = spark.createDataFrame([(k, prose(lang, 300), lang) for lang in letters for k in range(3)], "doc_id long, text string, lang string")
        assert all(r.lang_pred == r.lang and not r.rejected for r in predict(more, models).collect())


def test_all_of_few_texts_are_counted(spark):
    rows = [(k, f"{w} {w}", "aa") for k, w in enumerate(["alpha", "beta", "gamma", "delta", "omega"])]
    model = fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))[0]
    grams, counts = np.unique(grams_of([w for _, t, _ in rows for w in t.split()])[0], axis=0, return_counts=True)
    whole = build("aa", grams, counts)
    assert all(np.array_equal(a, b) for a, b in zip(model.keys + model.logp, whole.keys + whole.logp, strict=True))
