from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from drayline.functions import Period
from drayline.operators import latest, reshape


def test_pivot_counts_and_names(spark, rows):
    df = spark.createDataFrame([("S", "red"), ("S", "blue"), ("S", "blue's"), ("M", "red")], "size string, color string")
    wide = reshape.pivot(df, ["size"], "color", ["red", "blue", "blue's"], quote_identifiers=False)
    assert wide.columns == ["size", "red", "blue", "blues"]
    assert rows(wide) == [("M", 1, 0, 0), ("S", 1, 1, 1)]


def test_unpivot_booleans_as_text(spark, rows):
    df = spark.createDataFrame(
        [(123, date(2017, 1, 1), "active", True, "n1"), (567, date(2017, 3, 1), "churned", None, "n2")],
        "customer_id int, created_at date, status string, is_updated boolean, name string",
    )
    long = reshape.unpivot(df, ["customer_id", "created_at"], ["name"], "prop", "val")
    assert rows(long, "customer_id", "prop", "val") == [
        (123, "is_updated", "true"), (123, "status", "active"), (567, "is_updated", None), (567, "status", "churned"),
    ]


def test_union_of_different_columns(spark, rows):
    a = spark.createDataFrame([(1, "drew", 7)], "id int, name string, favorite_number int")
    b = spark.createDataFrame([(2, "green", 9)], "id int, favorite_color string, favorite_number int")
    both = reshape.union_relations({"a": a, "b": b})
    assert both.columns == ["_source_relation", "id", "name", "favorite_number", "favorite_color"]
    assert rows(both) == [("a", 1, "drew", 7, None), ("b", 2, None, 9, "green")]
    assert reshape.union_relations({"a": a, "b": b}, include=["ID"], source_column_name=None).columns == ["id"]
    with pytest.raises(ValueError):
        reshape.union_relations({"a": a}, include=["id"], exclude=["name"])
    with pytest.raises(ValueError):
        reshape.union_relations({"a": a}, include=["nothing"])


def test_except_both_ways(spark, rows):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "x int")
    b = spark.createDataFrame([(2,), (3,), (None,)], "x int")
    assert rows(reshape.except_both_ways(a, b)) == [("a_minus_b", 1), ("b_minus_a", 3)]
    assert rows(reshape.except_both_ways(a, b, keep_duplicates=True)) == [("a_minus_b", 1), ("a_minus_b", 1), ("b_minus_a", 3)]


def test_star_and_nullcheck(spark, rows):
    df = spark.createDataFrame([("", "b", 3), ("a", "", None)], "field_1 string, field_2 string, field_3 int")
    assert reshape.star(df, ["FIELD_3"], suffix="_x").columns == ["field_1_x", "field_2_x"]
    with pytest.raises(ValueError):
        reshape.star(df, df.columns)
    assert rows(reshape.nullcheck(df)) == [(None, "b", 3), ("a", None, None)]


def test_column_values(spark):
    df = spark.createDataFrame([(v,) for v in "aababcc" + "a"], "field string")
    assert reshape.get_column_values(df, "field") == ["a", "b", "c"]
    assert reshape.get_column_values(df, "field", max_records=1) == ["a"]
    assert reshape.get_column_values(df, "field", where="field > 'z'", default=["none"]) == ["none"]
    assert reshape.get_column_values(None, "field", default=[]) == []
    with pytest.raises(ValueError):
        reshape.get_column_values(None, "field")
    with pytest.raises(ValueError):
        reshape.get_column_values(df, "field", fetch_limit=2)


def test_values_for_the_caller(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n int, s string")
    assert reshape.get_single_value(df.agg(F.max("n"))) == 2
    assert reshape.get_single_value(df.where("n > 5"), default=0) == 0
    assert reshape.get_query_results_as_dict(df.orderBy("n")) == {"n": (1, 2), "s": ("a", "b")}


def test_series_and_spines(spark, rows):
    assert [r[0] for r in rows(reshape.generate_series(spark, 3))] == [1, 2, 3]
    with pytest.raises(ValueError):
        reshape.generate_series(spark, 0)
    days = reshape.date_spine(spark, "day", date(2018, 1, 1), date(2018, 1, 10))
    assert days.columns == ["date_day"] and days.count() == 9
    assert days.agg(F.max("date_day")).first()[0] == date(2018, 1, 9)
    assert reshape.date_spine(spark, "month", "2024-01-15", "2024-04-01").count() == 3
    assert reshape.date_spine(spark, "hour", "2024-01-01", "2024-01-01 03:00:00").count() == 3
    assert reshape.date_spine(spark, "day", "2024-01-02", "2024-01-01").count() == 0


@pytest.mark.parametrize(
    "bucket, end, count",
    [
        (Period("day", 1), datetime(2024, 1, 8), 7),
        (Period("day", 2), datetime(2024, 1, 8), 3),  # the seventh day alone is no bucket
        (Period("hour", 5), datetime(2024, 1, 2), 4),
        (Period("week", 1), datetime(2024, 1, 22, 23), 3),
        (Period("month", 1), datetime(2024, 3, 31), 2),
        (Period("day", 1), datetime(2023, 1, 1), 0),
    ],
)
def test_bucket_spine_has_complete_buckets_only(spark, bucket, end, count):
    spine = reshape.bucket_spine(spark, datetime(2024, 1, 1), end, bucket)
    assert spine.count() == count


def test_deduplicate_keeps_rows_with_nulls(spark, rows):
    df = spark.createDataFrame([(1, "play", 1), (1, "play", 2), (2, None, 1)], "user_id int, event string, version int")
    kept = latest.deduplicate(df, ["user_id"], [F.col("version").desc()])
    assert rows(kept) == [(1, "play", 2), (2, None, 1)]


def test_latest_per_key_prunes_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = latest.latest_per_key(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    before, after = plan.index("WindowGroupLimit"), plan.rindex("WindowGroupLimit")
    assert before != after and "Exchange" in plan[before:after]
