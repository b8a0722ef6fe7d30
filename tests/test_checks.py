from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from drayline.functions import Period
from drayline.operators import checks


def test_accepted_range(spark, rows):
    df = spark.createDataFrame([(-1,), (0,), (11,), (None,)], "id int")
    assert rows(checks.accepted_range(df, "id", 0, 10)) == [(-1,), (11,)]
    assert rows(checks.accepted_range(df, "id", min_value=-1, inclusive=False)) == [(-1,)]
    assert checks.accepted_range(df, "id", min_value=-1, max_value=11).isEmpty()
    with pytest.raises(ValueError):
        checks.accepted_range(df, "id")


def test_column_checks(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, " "), (None, ""), (2, None)], "id int, s string")
    assert rows(checks.unique(df, "id")) == [(1, 2)]
    assert rows(checks.not_null(df, "id"), "s") == [("",)]
    assert rows(checks.not_empty_string(df, "s"), "s") == [("",), (" ",)]
    assert rows(checks.not_empty_string(df, "s", trim_whitespace=False), "s") == [("",)]
    assert rows(checks.accepted_values(df, "s", ["a", ""])) == [(" ", 1)]
    assert rows(checks.not_accepted_values(df, "s", ["a", "z"])) == [("a",)]


def test_at_least_one_and_not_constant(spark, rows):
    df = spark.createDataFrame([(1, None, 1), (1, None, 1), (2, "x", 1), (2, "y", 2)], "g int, field string, c int")
    assert rows(checks.at_least_one(df, "field", ["g"]), "g") == [(1,)]
    assert checks.at_least_one(df, "field").isEmpty()
    assert rows(checks.not_constant(df, "c", ["g"]), "g") == [(1,)]
    assert checks.not_constant(df, "c").isEmpty()
    assert checks.not_constant(df.where("g = 1"), "field").isEmpty()  # only nulls: no distinct value


def test_not_null_proportion(spark, rows):
    df = spark.createDataFrame([(1, i) if i else (None, i) for i in range(10)], "point_9 int, i int")
    assert checks.not_null_proportion(df, "point_9", 0.9).isEmpty()
    assert rows(checks.not_null_proportion(df, "point_9", 0.95)) == [(0.9,)]
    assert rows(checks.not_null_proportion(df, "point_9", 0, 0.5)) == [(0.9,)]


def test_expression(spark, rows):
    df = spark.createDataFrame([(0.0, 1.0), (1.0, 0.0), (0.5, None)], "col_a double, col_b double")
    assert checks.expression_is_true(df, "col_a + col_b = 1").isEmpty()
    assert rows(checks.expression_is_true(df, "= 0.5", "col_a"), "col_a") == [(0.0,), (1.0,)]


def test_recency(spark, rows):
    df = spark.createDataFrame([("a", datetime(2024, 1, 1, 12)), ("b", datetime(2024, 1, 3))], "g string, ts timestamp")
    as_of = datetime(2024, 1, 3, 6)
    assert rows(checks.recency(df, "ts", as_of, Period("day", 1), group_by=["g"]), "g") == [("a",)]
    assert checks.recency(df, "ts", as_of, Period("day", 1)).isEmpty()
    assert checks.recency(df, "ts", as_of, Period("day", 2), True, ["g"]).isEmpty()  # compares dates


@pytest.mark.parametrize("rows_per_chunk", [2, 1000])
def test_sequential_values(spark, rows, rows_per_chunk):
    df = spark.createDataFrame([(1, 2), (2, 4), (2, 6), (2, 8), (2, 10), (2, 10), (2, None)], "col_a int, even int")
    found = checks.sequential_values(df, "even", 2, rows_per_chunk=rows_per_chunk)
    assert found.columns == ["even", "previous_even"]
    assert rows(found) == [(10, 10)]
    assert len(rows(checks.sequential_values(df, "even", 1, rows_per_chunk=rows_per_chunk))) == 5
    stamps = spark.createDataFrame([(datetime(2021, 1, 1, h),) for h in (0, 1, 2, 4)], "t timestamp")
    found = checks.sequential_values(stamps, "t", 1, "hour", rows_per_chunk=rows_per_chunk)
    assert rows(found) == [(datetime(2021, 1, 1, 4), datetime(2021, 1, 1, 2))]


@pytest.mark.parametrize("rows_per_chunk", [2, 1000])
def test_ranges(spark, rows, rows_per_chunk):
    def bad(data, schema="lower_bound int, upper_bound int", **options):
        df = spark.createDataFrame(data, schema)
        lower, upper = options.pop("lower", "lower_bound"), options.pop("upper", "upper_bound")
        found = checks.mutually_exclusive_ranges(df, lower, upper, rows_per_chunk=rows_per_chunk, **options)
        return rows(found, "lower_bound", "upper_bound")

    assert bad([(0, 1), (1, 2), (2, 4)], gaps="not_allowed") == []
    assert bad([(0, 1), (1, 2), (3, 4)], gaps="not_allowed") == [(1, 2)]
    assert bad([(0, 1), (1, 2), (3, 4)], gaps="required") == [(0, 1)]
    assert bad([(0, 2), (1, 3)]) == [(0, 2)]
    assert bad([(0, 1), (0, 1)]) == [(0, 1)]  # the first copy overlaps the second
    assert bad([(None, 1), (2, 2), (3, 4)]) == [(None, 1), (2, 2)]
    assert bad([(2, 2), (3, 4)], zero_length_range_allowed=True) == []
    subscriptions = [
        (1, date(2019, 1, 1), date(2019, 2, 1)), (1, date(2019, 3, 3), date(2019, 4, 1)),
        (2, date(2019, 5, 6), date(2019, 7, 2)), (2, date(2019, 7, 3), None),
    ]
    options = {"lower": "valid_from", "partition_by": "subscription_id", "gaps": "required"}
    schema = "subscription_id int, valid_from date, valid_to date"
    assert bad(subscriptions, schema, upper="valid_to", **options) == [(date(2019, 7, 3), None)]
    assert bad(subscriptions, schema, upper="coalesce(valid_to, date '2099-01-01')", **options) == []
    with pytest.raises(ValueError):
        bad([(0, 1)], gaps="sometimes")


def test_relationships(spark, rows):
    a = spark.createDataFrame([(1,), (2,), (4,), (None,)], "id int")
    b = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    assert rows(checks.relationships(a, "id", b, "id")) == [(4,)]
    assert checks.relationships_where(a, "id", b, "id", from_condition="id <> 4").isEmpty()
    assert rows(checks.relationships_where(a, "id", b, "id", to_condition="id > 1")) == [(1,), (4,)]


def test_two_tables(spark, rows):
    a = spark.createDataFrame([(1,), (1,), (2,)], "same_name int")
    b = spark.createDataFrame([(1, 2), (2, 2), (2, 1)], "same_name int, different_name int")
    assert len(rows(checks.cardinality_equality(a, "same_name", b, "same_name"))) == 4
    assert checks.cardinality_equality(b, "same_name", b.select(F.col("different_name")), "different_name").isEmpty()
    assert checks.equality(a, b, ["same_name"]).isEmpty()
    differences = checks.equality(a, b.where("same_name = 2"), ["same_name"])
    assert rows(differences) == [("a_minus_b", 1)]
    assert rows(checks.equality_failures(differences)) == [(2,)]  # one row, and one more on this side
    assert rows(checks.equal_rowcount(a, b)) == [(3, 3, 0)]
    assert rows(checks.fewer_rows_than(a, b)) == [(3, 3, 1)]
    assert rows(checks.fewer_rows_than(a, b.limit(2))) == [(3, 2, 1)]
    assert rows(checks.fewer_rows_than(a.limit(1), b)) == [(1, 3, 0)]
    grouped = checks.equal_rowcount(a, b, ["same_name"])
    assert rows(grouped) == [(1, 1, 2, 1, 1), (2, 2, 1, 2, 1)]


@pytest.mark.parametrize(
    "text, schema, valid",
    [
        ('"abc"', {"type": "string", "minLength": 3, "maxLength": 5}, True),
        ('"abcdef"', {"type": "string", "minLength": 3, "maxLength": 5}, False),
        ("12", {"type": "string"}, False),
        ("12", {"type": "integer", "minimum": 12}, True),
        ("12.5", {"type": "integer"}, False),
        ("12.5", {"type": "number", "maximum": 12}, False),
        ("true", {"type": "boolean"}, True),
        ('"b"', {"type": "string", "enum": ["a", "b"]}, True),
        ('"c"', {"type": "string", "enum": ["a", "b"]}, False),
        ('"a1"', {"type": "string", "pattern": "^[a-z]+$"}, False),
        ('{"a": 1}', {"type": "object", "required": ["a"]}, True),
        ('{"b": 1}', {"type": "object", "required": ["a"]}, False),
        ('{"a": "x"}', {"type": "object", "properties": {"a": {"type": "integer"}}}, False),
        ('{"a": 3}', {"type": "object", "properties": {"a": {"type": "integer"}}}, True),
        ("{broken", {"type": "object"}, False),
        ("[1]", {"type": "object"}, False),
    ],
)
def test_json_conformance(spark, text, schema, valid):
    df = spark.createDataFrame([(text,)], "j string")
    assert checks.json_conformance(df, "j", schema).isEmpty() is valid


def test_source_freshness(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1),)], "t timestamp")

    def status(as_of):
        return checks.source_freshness(df, "t", as_of, Period("hour", 1), Period("hour", 3)).first()["status"]

    assert [status(datetime(2024, 1, 1, h)) for h in (0, 2, 4)] == ["pass", "warn", "error"]
    assert checks.source_freshness(df.limit(0), "t", datetime(2024, 1, 1), Period("hour", 1)).first()["status"] == "warn"


def test_user_checks(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, "bb")], "id int, s string")
    assert rows(checks.python_check(df, lambda d, n: d.where(F.length("s") > n), args={"n": 1}), "id") == [(2,)]
    assert rows(checks.row_check(df, lambda batch: batch["s"].str.len() < 2), "id") == [(2,)]


def test_run_checks_and_store_failures(spark, rows):
    df = spark.createDataFrame([(1,), (1,), (None,)], "id int")
    declared = [
        checks.Check("u", lambda d: checks.unique(d, "id"), column="id"),
        checks.Check("n", lambda d: checks.not_null(d, "id"), "warn"),
        checks.Check("r", lambda d: checks.accepted_range(d, "id", 0)),
        checks.Check("sum", lambda d: checks.unique(d, "id"), failure_count=F.sum("n_records")),
    ]
    found = checks.run_checks(df, declared, "t", datetime(2024, 1, 1))
    assert rows(found, "test_name", "status", "failures") == [("n", "warn", 1), ("r", "pass", 0), ("sum", "fail", 2), ("u", "fail", 1)]
    stored = checks.failing_rows(checks.not_null(df, "id"), "res1")
    assert rows(stored) == [("res1", '{"id":null}')]
    with pytest.raises(ValueError):
        checks.Check("x", lambda d: d, "fatal")


def test_run_and_store(spark, tmp_path, rows):
    df = spark.createDataFrame([(1,), (1,), (None,), (-5,)], "id int")
    declared = [
        checks.Check("u", lambda d: checks.unique(d, "id")),
        checks.Check("n", severity="warn", failing=lambda: F.col("id").isNull()),
        checks.Check("ok", failing=lambda: F.col("id") > 9),
        checks.Check("r", failing=lambda: ~F.col("id").between(0, 9)),
    ]
    for _ in range(2):
        found = checks.run_and_store(df, declared, "t", str(tmp_path), datetime(2024, 1, 1))
    assert rows(found, "test_name", "status", "failures") == [("n", "warn", 1), ("ok", "pass", 0), ("r", "fail", 1), ("u", "fail", 1)]
    assert spark.read.parquet(str(tmp_path / "results")).count() == 8
    kept = spark.read.parquet(str(tmp_path / "failures" / "t"))
    assert rows(kept.select("result_row").distinct()) == [('{"id":-5}',), ('{"id":1,"n_records":2}',), ('{"id":null}',)]
    with pytest.raises(ValueError):
        checks.Check("neither")


@pytest.mark.parametrize(
    "text, schema, valid",
    [
        ("true", {"enum": [True]}, True),
        ("1", {"enum": [True]}, False),
        ("null", {"enum": [None]}, True),
        ('"1"', {"enum": [1]}, False),
        ("1.0", {"enum": [1]}, True),
        ('{"a":[1,2]}', {"const": {"a": [1, 2]}}, True),
        ("5.0", {"type": "integer"}, True),
        ("5.5", {"type": "integer"}, False),
        ("1e3", {"type": "integer"}, True),
        ("null", {"type": ["string", "null"]}, True),
        ('{"a":{"b":[{"c":1},{"c":"x"}]}}', {"properties": {"a": {"properties": {"b": {"items": {"properties": {"c": {"type": "integer"}}}}}}}}, False),
        ('{"a":{"b":[{"c":1},{"c":2}]}}', {"properties": {"a": {"properties": {"b": {"items": {"required": ["c"], "properties": {"c": {"type": "integer"}}}}}}}}, True),
        ("[1,2,3]", {"type": "array", "minItems": 2, "maxItems": 3, "uniqueItems": True, "items": {"maximum": 3}}, True),
        ("[1,1]", {"uniqueItems": True}, False),
        ("[1,4]", {"items": {"exclusiveMaximum": 4}}, False),
        ('{"a":1,"z":2}', {"properties": {"a": {}}, "additionalProperties": False}, False),
        ('{"a":1,"z":2}', {"properties": {"a": {}}, "additionalProperties": {"type": "number"}}, True),
        ('{"a b":null}', {"required": ["a b"], "properties": {"a b": {"type": "null"}}}, True),
        ('"abc"', {"minimum": 5}, True),
        ("6", {"multipleOf": 0.1}, True),
        ("7", {"anyOf": [{"type": "string"}, {"minimum": 7}], "not": {"const": 8}}, True),
        ("7", {"oneOf": [{"type": "number"}, {"minimum": 7}]}, False),
        ("{broken", {}, False),
    ],
)
def test_json_conformance_by_type_and_depth(spark, text, schema, valid):
    df = spark.createDataFrame([(text,), (None,)], "j string")
    assert checks.json_conformance(df, "j", schema).isEmpty() is valid


@pytest.mark.parametrize(
    "text, schema, valid",
    [
        ("1000000000.5", {"multipleOf": 1}, False),
        ("1000000000", {"multipleOf": 1}, True),
        ("0.3", {"multipleOf": 0.1}, True),
        ("0.35", {"multipleOf": 0.1}, False),
        ("1e300", {"multipleOf": 10}, True),
        ("9007199254740993", {"enum": [9007199254740992]}, False),
        ("9007199254740993", {"const": 9007199254740993}, True),
        ("9007199254740993.5", {"type": "integer"}, False),
        ("9007199254740993", {"maximum": 9007199254740992}, False),
        ("9007199254740993", {"exclusiveMinimum": 9007199254740992}, True),
        ("0.1", {"enum": [0.1]}, True),
        ("1.0", {"const": 1}, True),
        ("-0.0", {"const": 0}, True),
        ("1e300", {"minimum": 1e299}, True),
        ("123456789012345678901234567890", {"type": "integer", "minimum": 123456789012345678901234567000}, True),
    ],
)
def test_json_numbers_are_exact(spark, text, schema, valid):
    df = spark.createDataFrame([(text,)], "j string")
    assert checks.json_conformance(df, "j", schema).isEmpty() is valid


def test_json_conformance_refuses_what_it_does_not_know(spark):
    df = spark.createDataFrame([("1",)], "j string")
    for schema in ({"type": "date"}, {"format": "email"}):
        with pytest.raises(ValueError):
            checks.json_conformance(df, "j", schema)


@pytest.mark.parametrize("limit", [1 << 12, 4])
def test_repeated_values_are_told_row_by_row(spark, monkeypatch, limit):
    from drayline.operators import reshape

    monkeypatch.setattr(reshape, "COPIES_PER_ROW", limit)
    df = spark.createDataFrame([("a", 0), ("b", 1), ("c", 37), ("d", 16), ("e", None)], "k string, n int")
    got = {r.k: r["count"] for r in reshape.repeat_rows(df, F.col("n")).groupBy("k").count().collect()}
    assert got == {"b": 1, "c": 37, "d": 16}


def test_a_value_repeated_ten_million_times(spark):
    df = spark.range(10_000_000).select(F.lit(7).cast("bigint").alias("v")).unionByName(spark.range(7).withColumnRenamed("id", "v"))
    assert checks.sequential_values(df, "v").agg(F.count("*"), F.min("previous_v")).first()[:] == (9_999_999, 7)
