"""As-of lookups against brute force, on even and on extremely skewed input."""

import random
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from drayline.operators import chunking
from drayline.operators.asof import Probe, asof_join, asof_lookup, bounded_by_batch

START = datetime(2024, 1, 1)


def at(minutes):
    return START + timedelta(minutes=minutes)


def nearest(pings, key, minute, direction, inclusive):
    """The expected (time, value): largest value among equal times backward, smallest forward."""
    if minute is None:
        return None
    mine = [(m, v) for k, m, v in pings if k == key and k is not None]
    if direction == "backward":
        ok = [p for p in mine if p[0] < minute or (inclusive and p[0] == minute)]
        return max(ok) if ok else None
    ok = [p for p in mine if p[0] > minute or (inclusive and p[0] == minute)]
    return min(ok) if ok else None


def check(spark, pings, probes, rows_per_chunk):
    right = spark.createDataFrame([(k, at(m), v) for k, m, v in pings], "k string, ts timestamp, v int")
    left = spark.createDataFrame(
        [(i, k, None if m is None else at(m)) for i, (k, m) in enumerate(probes)], "id int, k string, t timestamp"
    )
    kinds = [Probe(f"{d}_{i}", "t", d, i) for d in ("backward", "forward") for i in (True, False)]
    found = asof_lookup(left, right, ["k"], "ts", ["v"], kinds, ["id"], tie_break=["v"], rows_per_chunk=rows_per_chunk)
    got = {r["id"]: r for r in found.collect()}
    assert len(got) == len(probes) == found.count()
    for i, (k, m) in enumerate(probes):
        for probe in kinds:
            expected = nearest(pings, k, m, probe.direction, probe.inclusive)
            row = got[i]
            actual = (row[f"{probe.name}_ts"], row[f"{probe.name}_v"])
            assert actual == ((None, None) if expected is None else (at(expected[0]), expected[1])), (probe, k, m)


ping = st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 12), st.integers(0, 3))
order = st.tuples(st.sampled_from(["a", "b", "c", None]), st.one_of(st.none(), st.integers(-1, 13)))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ping, max_size=25), st.lists(order, min_size=1, max_size=10), st.sampled_from([None, 3, 1000]))
def test_against_brute_force(spark, pings, probes, rows_per_chunk):
    check(spark, pings, probes, rows_per_chunk)


@pytest.mark.parametrize("rows_per_chunk", [7, 40, 1000])
def test_one_key_holds_most_rows(spark, rows_per_chunk):
    random.seed(3)
    pings = [("hot", random.randrange(400), random.randrange(5)) for _ in range(300)]
    pings += [(f"k{i % 9}", random.randrange(400), 1) for i in range(60)]
    probes = [("hot", random.randrange(-5, 405)) for _ in range(120)] + [(f"k{i % 11}", random.randrange(400)) for i in range(30)]
    check(spark, pings, probes, rows_per_chunk)


def test_one_instant_holds_most_rows(spark):
    pings = [("hot", 50, i % 7) for i in range(80)] + [("hot", m, 1) for m in (1, 49, 51, 90)] + [("b", 3, 3)]
    probes = [("hot", 50)] * 60 + [("hot", 51), ("hot", 0), ("b", 4)]
    check(spark, pings, probes, 10)


def test_the_hot_key_is_split_over_partitions(spark):
    rows = spark.range(5000).select(F.lit("hot").alias("k"), F.timestamp_seconds("id").alias("ts"))
    plan = chunking.plan_chunks(rows, ["k"], "ts", rows_per_chunk=500)
    sizes = plan.assign(rows, "ts").groupBy(chunking.CHUNK).count().collect()
    assert len(sizes) >= 8 and max(r["count"] for r in sizes) < 1500
    assert chunking.plan_chunks(rows, ["k"], "ts", rows_per_chunk=5000) is None


def test_within_drops_far_answers(spark):
    right = spark.createDataFrame([("a", at(0), 1)], "k string, ts timestamp, v int")
    left = spark.createDataFrame([(1, "a", at(5)), (2, "a", at(50))], "id int, k string, t timestamp")
    found = asof_join(left, right, ["k"], "t", "ts", ["v"], ["id"], within=600)
    assert {r["id"]: r["asof_v"] for r in found.collect()} == {1: 1, 2: None}


def test_a_null_value_of_the_nearest_row_is_kept(spark):
    right = spark.createDataFrame([("a", at(0), 1), ("a", at(1), None)], "k string, ts timestamp, v int")
    left = spark.createDataFrame([(1, "a", at(5))], "id int, k string, t timestamp")
    row = asof_join(left, right, ["k"], "t", "ts", ["v"], ["id"]).first()
    assert row["asof_v"] is None and row["asof_ts"] == at(1)


def test_window_of_an_empty_batch_is_empty(spark):
    series = spark.createDataFrame([("a", at(0))], "k string, ts timestamp")
    batch = spark.createDataFrame([], "s timestamp, e timestamp")
    assert bounded_by_batch(series, batch, "ts", "s", "e").count() == 0


def test_direction_is_checked():
    with pytest.raises(ValueError):
        Probe("x", "t", "sideways")


@pytest.mark.parametrize("rows_per_chunk", [5, 1000])
def test_number_rows(spark, rows_per_chunk):
    data = [("hot", i // 2, i) for i in range(60)] + [("b", 1, 100), ("b", 2, 101)]
    df = spark.createDataFrame(data, "k string, o int, t int")
    got = chunking.number_rows(df, ["k"], "o", ["t"], "n", rows_per_chunk=rows_per_chunk)
    for key in ("hot", "b"):
        mine = sorted(((r["o"], r["t"]) for r in got.where(F.col("k") == key).collect()), reverse=True)
        numbered = [(r["o"], r["t"]) for r in got.where(F.col("k") == key).orderBy("n").collect()]
        assert numbered == mine
        assert [r["n"] for r in got.where(F.col("k") == key).orderBy("n").collect()] == list(range(1, len(mine) + 1))


@pytest.mark.parametrize("rows_per_chunk", [3, 1000])
def test_ordered_values_neighbours(spark, rows_per_chunk):
    data = [("a", v) for v in [5, 1, 9, 9, 9, 2, None]] + [("b", 4)] + [(None, 1), (None, 2)]
    df = spark.createDataFrame(data, "g string, v int")
    got = {(r["g"], r["v"]): (r["n"], r["previous"], r["next"]) for r in chunking.ordered_values(df, ["g"], ["v"], rows_per_chunk).collect()}
    assert got == {
        ("a", 1): (1, None, 2), ("a", 2): (1, 1, 5), ("a", 5): (1, 2, 9), ("a", 9): (3, 5, None),
        ("b", 4): (1, None, None), (None, 1): (1, None, 2), (None, 2): (1, 1, None),
    }


def test_expanding_stats_of_split_keys(spark):
    data = [("hot", i, float(i * i % 17)) for i in range(60)] + [("flat", i, 5.1) for i in range(30)] + [(None, 1, None), (None, 2, 4.0)]
    df = spark.createDataFrame(data, "k string, o int, v double")
    whole, split = (
        {(r["k"], r["o"]): r for r in chunking.expanding_stats(df, ["k"], ["o"], "v", n).collect()} for n in (1000, 8)
    )
    assert whole.keys() == split.keys()
    for key, row in whole.items():
        for name in ("training_avg", "training_stddev"):
            a, b = row[name], split[key][name]
            assert (a is None and b is None) or a == pytest.approx(b, abs=1e-9)
        assert row["training_set_size"] == split[key]["training_set_size"]
    assert split[("flat", 20)]["training_stddev"] == 0.0


def test_each_hot_key_has_cuts_of_its_own(spark):
    """Eight keys in ranges of their own, a ninth that is small, and a null key."""
    rows = spark.range(8000).select((F.col("id") / 1000).cast("int").alias("k"), "id").unionByName(
        spark.range(100).select(F.lit(99).alias("k"), "id")
    ).unionByName(spark.range(3000).select(F.lit(None).cast("int").alias("k"), "id"))
    plan = chunking.plan_chunks(rows, ["k"], "id", rows_per_chunk=500)
    sizes = {(r.k, r[chunking.CHUNK]): r["count"] for r in plan.assign(rows, "id").groupBy("k", chunking.CHUNK).count().collect()}
    assert max(sizes.values()) <= 1000
    assert all(sum(k == key for k, _ in sizes) >= 2 for key in [*range(8), None])
    assert sum(k == 99 for k, _ in sizes) == 1
    assert plan.hot(rows).count() == 11000 and plan.cold(rows).count() == 100


@pytest.mark.parametrize("kind", ["string", "date", "decimal(10,2)", "double"])
def test_any_ordered_type_can_be_cut(spark, kind):
    value = {
        "string": F.lpad(F.col("id").cast("string"), 6, "0"),
        "date": F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")),
    }.get(kind, F.col("id").cast(kind))
    rows = spark.range(900).select(F.lit("a").alias("k"), "id", value.alias("v"))
    for keys in (["k"], []):
        got = chunking.number_rows(rows, keys, "v", ["id"], "n", descending=False, rows_per_chunk=50)
        assert all(r.n == r.id + 1 for r in got.collect())


def test_running_stats_do_not_depend_on_the_split(spark):
    """A constant prefix, nulls, then values far lower: split and unsplit agree, and zero stays zero."""
    value = F.when(F.col("id") < 500, 3.7).when(F.col("id") % 50 == 0, F.lit(None)).otherwise(F.col("id") % 7 - 1e6)
    rows = spark.range(1200).select(F.lit("a").alias("k"), "id", value.cast("double").alias("v"))
    plain = {r.id: r for r in chunking.expanding_stats(rows, ["k"], ["id"], "v").collect()}
    split = {r.id: r for r in chunking.expanding_stats(rows, ["k"], ["id"], "v", rows_per_chunk=60).collect()}
    for i, r in plain.items():
        assert split[i].training_set_size == r.training_set_size
        for c in ("training_avg", "training_stddev"):
            assert (split[i][c] is None) == (r[c] is None)
            assert r[c] is None or abs(split[i][c] - r[c]) <= 1e-9 * max(1.0, abs(r[c]))
    assert all(split[i].training_stddev == 0 for i in range(1, 500))


def test_rows_of_one_order_value_are_split(spark):
    rows = spark.range(2000).select(F.lit("a").alias("k"), F.lit(1).alias("o"), (F.col("id") * 7919 % 2000).alias("t"))
    plan = chunking.plan_chunks(rows, ["k"], ["o", "t"], rows_per_chunk=500)
    sizes = [r["count"] for r in plan.assign(rows, ["o", "t"]).groupBy(chunking.CHUNK).count().collect()]
    assert len(sizes) >= 4 and max(sizes) <= 1000
    for keys in (["k"], []):
        got = chunking.number_rows(rows, keys, "o", ["t"], "n", rows_per_chunk=500).collect()
        assert all(r.n == 2000 - r.t for r in got)


@pytest.mark.parametrize("odd", [["nan"], ["inf"], ["-inf"], ["inf", "-inf"], ["inf", "nan"]])
@pytest.mark.parametrize("at", [0, 5, 33])
def test_values_without_moments_do_not_depend_on_the_split(spark, odd, at):
    values = [float(i % 5) if i % 4 else None for i in range(60)]
    for i, x in enumerate(odd):
        values[at + 9 * i] = float(x)
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate(values)], "k string, o int, v double")
    whole, split = ([tuple(map(str, r[3:])) for r in chunking.expanding_stats(df, ["k"], ["o"], "v", n).orderBy("o").collect()] for n in (1000, 7))
    for a, b in zip(whole, split, strict=True):
        assert [x if x in ("None", "nan", "inf", "-inf") else round(float(x), 9) for x in a] == [x if x in ("None", "nan", "inf", "-inf") else round(float(x), 9) for x in b]
