"""Equality by bucket digests against the plain comparison."""

import random

import pytest
from pyspark.sql import functions as F

from drayline.operators import checks, digests

SCHEMA = "id int, a string, b string, v double, l array<string>"


@pytest.fixture
def pair(spark):
    rng = random.Random(4)
    pick = lambda: rng.choice(["x", "y", "", None])
    data = [(rng.randint(0, 60), pick(), pick(), rng.choice([0.0, 1.5, None, float("nan")]), [pick(), pick()]) for _ in range(300)]
    other = [row for row in data if rng.random() < 0.97] + data[:7]
    return spark.createDataFrame(data, SCHEMA), spark.createDataFrame(other, SCHEMA)


@pytest.mark.parametrize("duplicates", [False, True])
@pytest.mark.parametrize("key", [None, ["id"], ["id", "a"]])
def test_equals_the_plain_comparison(pair, rows, key, duplicates):
    for buckets in (1, 16, 4096):
        got = digests.equality_by_digest(*pair, key=key, keep_duplicates=duplicates, buckets=buckets)
        expected = checks.equality(*pair, keep_duplicates=duplicates)
        text = F.col("v").cast("string")  # NaN is not equal to itself on this side
        assert rows(got.withColumn("v", text)) == rows(expected.withColumn("v", text))


def test_nulls_in_other_places_differ(spark, rows):
    one = spark.createDataFrame([(1, None, "x", None, [None, "x"])], SCHEMA)
    moved = [(1, "x", None, None, [None, "x"]), (1, None, "x", None, ["x", None])]
    for row in moved:
        other = spark.createDataFrame([row], SCHEMA)
        assert digests.equality_by_digest(one, other, key=["id"]).count() == 2


def test_equal_tables_in_any_order_send_no_rows(pair, spark):
    same = pair[0].repartition(7, F.rand(3))
    listed = digests.differing_buckets(*[digests.bucket_digests(x, ["id"], 8) for x in (pair[0], same)])
    assert listed.isEmpty()
    found = digests.equality_by_digest(pair[0], same, key=["id"], buckets=8)
    assert found.isEmpty()
    # Below the final comparison rows meet the list of buckets in a broadcast join, without an exchange of their own.
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 2 and "SortMergeJoin" not in plan.split("BroadcastHashJoin")[0]


def test_empty_and_other_types(spark, pair, rows):
    none = pair[0].limit(0)
    assert digests.equality_by_digest(none, none).isEmpty()
    assert digests.equality_by_digest(pair[0], none, keep_duplicates=True).count() == 300
    wide = pair[0].withColumn("id", F.col("id").cast("bigint"))
    assert digests.equality_by_digest(pair[0], wide).isEmpty()
    zero = spark.createDataFrame([(0.0,)], "v double"), spark.createDataFrame([(-0.0,)], "v double")
    assert digests.equality_by_digest(*zero).isEmpty()
