import hashlib
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from drayline import functions as fn


def one(spark, column, **values):
    frame = spark.range(1)
    for name, (value, kind) in values.items():
        frame = frame.withColumn(name, F.lit(value).cast(kind))
    return frame.select(column.alias("x")).first()["x"]


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


@pytest.mark.parametrize(
    "fields, expected",
    [((1, 2, 3), 6), ((1, None, 3), 4), ((None, None, 2), 2), ((None, None, None), 0)],
)
def test_safe_add(spark, fields, expected):
    a, b, c = fields
    assert one(spark, fn.safe_add(["a", "b", "c"]), a=(a, "int"), b=(b, "int"), c=(c, "int")) == expected


@pytest.mark.parametrize(
    "fields, expected", [((3, 2, 1), 0), ((4, None, 3), 1), ((None, None, 2), -2), ((None, None, None), 0)]
)
def test_safe_subtract(spark, fields, expected):
    a, b, c = fields
    assert one(spark, fn.safe_subtract(["a", "b", "c"]), a=(a, "int"), b=(b, "int"), c=(c, "int")) == expected


@pytest.mark.parametrize("function", [fn.safe_add, fn.safe_subtract])
def test_one_list_of_fields(function):
    with pytest.raises(TypeError):
        function("a")
    with pytest.raises(ValueError):
        function([])


@pytest.mark.parametrize(
    "a, b, expected",
    [(6, 0, None), (10, 5, 2), (None, None, None), (None, 0, None), (17, None, None), (0, 0, None), (None, 9, None), (0, 5, 0)],
)
def test_safe_divide(spark, a, b, expected):
    assert one(spark, fn.safe_divide("a", "b"), a=(a, "int"), b=(b, "int")) == expected


@pytest.mark.parametrize(
    "amount, bucket",
    [(190000.0, 0), (290000.0, 1), (320000.0, 2), (399999.99, 2), (400000.0, 3), (470000.0, 3), (510000.0, 4), (600000.0, 5), (610000.0, 5)],
)
def test_width_bucket(spark, amount, bucket):
    assert one(spark, fn.width_bucket(F.lit(amount), 200000.0, 600000.0, 4)) == bucket


@pytest.mark.parametrize(
    "value, places, expected",
    [(0.285, 2, 0.28), (1.005, 2, 1.0), (2.5, 0, 3.0), (-2.5, 0, -3.0), (7.25, 1, 7.3), (0.0, 3, 0.0), (None, 1, None)],
)
def test_round_to_rounds_the_double(spark, value, places, expected):
    assert one(spark, fn.round_to("v", places), v=(value, "double")) == expected


def test_exact_sum_and_mean_do_not_depend_on_order(spark):
    values = [0.1, 0.2, 0.3, 12345.6, 0.7, 1e6 + 0.1] * 50
    results = set()
    for parts in (1, 3, 7):
        frame = spark.createDataFrame([(v,) for v in values], "v double").repartition(parts)
        results.add(tuple(frame.agg(fn.exact_sum("v", 1), fn.exact_mean("v", 1), fn.exact_mean("v", 1, 0), fn.exact_sum("v", 1, 0)).first()))
    assert len(results) == 1
    assert results.pop()[0] == pytest.approx(sum(values))


def test_exact_mean_of_nothing_is_null(spark):
    frame = spark.createDataFrame([(None,)], "v double")
    assert frame.agg(fn.exact_mean("v", 2, 1)).first()[0] is None


def test_percentages(spark):
    assert one(spark, fn.percent(F.lit(1), F.lit(3))) == 33.333
    assert one(spark, fn.not_percent(F.lit(1), F.lit(3))) == 66.667
    assert one(spark, fn.percent(F.lit(1), F.lit(0))) is None


def test_min_max_propagate_null(spark):
    assert one(spark, fn.arithmetic_min(F.lit(2), F.lit(5))) == 2
    assert one(spark, fn.arithmetic_max(F.lit(2), F.lit(5))) == 5
    assert one(spark, fn.arithmetic_min(F.lit(2), F.lit(None).cast("int"))) is None


def test_surrogate_key_tells_null_from_empty(spark):
    null = "_dbt_utils_surrogate_key_null_"
    assert one(spark, fn.surrogate_key(["a", "b"]), a=("x", "string"), b=("y", "string")) == md5("x-y")
    assert one(spark, fn.surrogate_key(["a", "b"]), a=("x", "string"), b=(None, "string")) == md5(f"x-{null}")
    assert one(spark, fn.surrogate_key(["a"], nulls_as_empty=True), a=(None, "string")) == md5("")
    assert one(spark, fn.metric_id(["a", "b"]), a=("x", "string"), b=(None, "string")) == md5("x-")


@pytest.mark.parametrize(
    "url, host, path",
    [
        ("shop.example.org?utm_source=a&utm_medium=b", "shop.example.org", ""),
        ("http://example.com/2018/01/tips/", "example.com", "2018/01/tips/"),
        ("https://www.example.com/a/b", "www.example.com", "a/b"),
        ("https://www.example.com/a/b?x=1", "www.example.com", "a/b"),
        ("android-app://m.example.com/", "m.example.com", None),
        ("docs.example.com/index.js?q=1", "docs.example.com", "index.js"),
    ],
)
def test_url_host_and_path(spark, url, host, path):
    assert one(spark, fn.get_url_host(F.lit(url))) == host
    if path is not None:
        assert one(spark, fn.get_url_path(F.lit(url))) == path


def test_url_parameter(spark):
    url = F.lit("http://example.com/p?utm_medium=organic&utm_source=site")
    assert one(spark, fn.get_url_parameter(url, "utm_medium")) == "organic"
    assert one(spark, fn.get_url_parameter(url, "utm_source")) == "site"
    assert one(spark, fn.get_url_parameter(url, "utm_term")) is None


def test_haversine(spark):
    paris_amsterdam = [F.lit(48.864716), F.lit(2.349014), F.lit(52.379189), F.lit(4.899431)]
    assert round(one(spark, fn.haversine_distance(*paris_amsterdam, unit="km"))) == 430
    assert round(one(spark, fn.haversine_distance(*paris_amsterdam))) == 267
    with pytest.raises(ValueError):
        fn.haversine_distance(*paris_amsterdam, unit="m")


def test_great_circle(spark):
    same = [F.lit(-25.4), F.lit(-49.2)] * 2
    assert one(spark, fn.great_circle_distance(*same)) == 0.0
    quarter = one(spark, fn.great_circle_distance(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(90.0)))
    assert quarter == pytest.approx(6371.01 * 3.141592653589793 / 2)
    pole = one(spark, fn.great_circle_distance(F.lit(90.0), F.lit(0.0), F.lit(-90.0), F.lit(0.0)))
    assert pole == pytest.approx(6371.01 * 3.141592653589793)
    assert one(spark, fn.great_circle_distance(F.lit(None).cast("double"), F.lit(0.0), F.lit(0.0), F.lit(1.0))) is None


def test_minutes_truncate_seconds(spark):
    a, b = datetime(2024, 1, 1, 10, 0, 0, 900000), datetime(2024, 1, 1, 10, 1, 31)
    assert one(spark, fn.minutes_between(fn.moment(a), fn.moment(b))) == 1.5  # 90.1 s counts as 90


def test_date_parts(spark):
    start, end = F.lit(date(2024, 1, 31)), F.lit(date(2024, 3, 1))
    assert one(spark, fn.date_diff_parts("month", start, end)) == 2  # boundaries, not whole months
    assert one(spark, fn.date_diff_parts("day", start, end)) == 30
    assert one(spark, fn.date_add_parts("month", 1, start)) == date(2024, 2, 29)
    with pytest.raises(ValueError):
        fn.time_add("fortnight", 1, start)


def test_calendar(spark):
    at = fn.moment(datetime(2024, 1, 3, 7, 5))
    assert one(spark, fn.day_of_week(at)) == "Wednesday"
    assert one(spark, fn.hour_of_day(at)) == "7"
    assert one(spark, fn.hour_of_week(at)) == "Wednesday07"
    assert one(spark, fn.to_char(at)) == "2024-01-03 07:05:00"


def test_periods():
    assert fn.Period("week", 2).convert("day") == fn.Period("day", 14)
    assert fn.Period("month", 1).convert("day") == fn.Period("day", 30)
    assert fn.Period("day", 10).convert("week") == fn.Period("week", 1)
    for bad in (("year", 1), ("day", -1), ("day", 1.5)):
        with pytest.raises(ValueError):
            fn.Period(*bad)


def test_lenient_timestamps(spark):
    expected = datetime(2024, 1, 2, 3, 4, 5)
    for text in ("2024-01-02 03:04:05", "2024-01-02T03:04:05", "2024-01-02T03:04:05Z"):
        assert one(spark, fn.cast_to_timestamp(F.lit(text))) == expected
    assert one(spark, fn.cast_to_timestamp(F.lit("soon"))) is None
    frame = spark.createDataFrame([("x",), (None,)], "a string")
    assert not fn.column_casts_to_timestamp(frame, "a")
    assert fn.column_casts_to_timestamp(spark.createDataFrame([(None,), ("2024-01-01",)], "a string"), "a")


def test_text(spark):
    assert one(spark, fn.contains_text(F.lit("Blue Car"), "blue")) is True
    assert one(spark, fn.contains_text(F.lit("Blue Car"), "blue", case_sensitive=True)) is False
    assert one(spark, fn.concat_with_separator(["a", "b"]), a=("x", "string"), b=(None, "int")) == "x; NULL"
    assert one(spark, fn.empty_to_null(F.lit(""))) is None
    assert fn.slugify("  A-b c!") == "_a_b_c"
    assert fn.slugify("1st Place") == "_1st_place"
