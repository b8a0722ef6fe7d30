"""Scalar functions applied to whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from drayline import functions as fn
from drayline.functions import casting, text
from drayline.plans import derived
from drayline.registry import ctes
from drayline.registry.base import Tables, query, r, with_ctes

_SPARSE = "CASE WHEN l_linenumber % 3 > 0 THEN l_quantity END AS a, CASE WHEN l_linenumber % 2 = 0 THEN l_tax END AS b, l_discount AS c"


def _sparse(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey",
        F.when(F.col("l_linenumber") % 3 > 0, F.col("l_quantity")).alias("a"),
        F.when(F.col("l_linenumber") % 2 == 0, F.col("l_tax")).alias("b"),
        F.col("l_discount").alias("c"),
    )


@query(
    "safe_arithmetic",
    f"SELECT l_orderkey, coalesce(a, 0) + coalesce(b, 0) + coalesce(c, 0) AS added, coalesce(a, 0) - coalesce(b, 0) - coalesce(c, 0) AS subtracted, "
    f"a / nullif(b, 0) AS divided FROM (SELECT l_orderkey, {_SPARSE} FROM lineitem)",
)
def safe_arithmetic(t: Tables) -> DataFrame:
    """A null counts as zero in sums and gives null in quotients, as a zero divisor does."""
    fields = ["a", "b", "c"]
    return _sparse(t).select(
        "l_orderkey",
        fn.safe_add(fields).alias("added"),
        fn.safe_subtract(fields).alias("subtracted"),
        fn.safe_divide("a", "b").alias("divided"),
    )


@query(
    "min_max_of_two",
    f"SELECT l_orderkey, CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN least(a, b) END AS low, "
    f"CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN greatest(a, b) END AS high FROM (SELECT l_orderkey, {_SPARSE} FROM lineitem)",
)
def min_max_of_two(t: Tables) -> DataFrame:
    return _sparse(t).select("l_orderkey", fn.arithmetic_min("a", "b").alias("low"), fn.arithmetic_max("a", "b").alias("high"))


@query(
    "width_bucket",
    "SELECT p_partkey, CASE WHEN p_retailprice < 1000 THEN 0 WHEN p_retailprice >= 1800 THEN 9 "
    "ELSE CAST(floor((p_retailprice - 1000) / 100) AS INT) + 1 END AS bucket FROM part",
)
def width_bucket(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", fn.width_bucket("p_retailprice", 1000, 1800, 8).cast("int").alias("bucket"))


@query(
    "rounding",
    f"SELECT l_orderkey, l_linenumber, {r('l_extendedprice * l_discount', 2)} AS at_2, {r('l_extendedprice / 7', 0)} AS at_0, "
    "-floor(l_extendedprice / 3 * 10 + 0.5) / 10 AS negative FROM lineitem",
)
def rounding(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        fn.round_to(F.col("l_extendedprice") * F.col("l_discount"), 2).alias("at_2"),
        fn.round_to(F.col("l_extendedprice") / 7, 0).alias("at_0"),
        fn.round_to(-F.col("l_extendedprice") / 3, 1).alias("negative"),
    )


@query(
    "percentages",
    f"SELECT l_returnflag, {r('count(*) FILTER (l_tax = 0) / count(*) * 100', 3)} AS share, "
    f"{r('100 - count(*) FILTER (l_tax = 0) / count(*) * 100', 3)} AS rest FROM lineitem GROUP BY 1",
)
def percentages(t: Tables) -> DataFrame:
    untaxed = F.count_if(F.col("l_tax") == 0)
    return t.lineitem.groupBy("l_returnflag").agg(
        fn.percent(untaxed, F.count(F.lit(1))).alias("share"), fn.not_percent(untaxed, F.count(F.lit(1))).alias("rest")
    )


@query(
    "exact_means",
    "SELECT l_suppkey, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / 100 AS total, "
    "floor(CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / (count(*) * 10) + 0.5) / 10 AS mean FROM lineitem GROUP BY 1",
)
def exact_means(t: Tables) -> DataFrame:
    """Totals and means that do not depend on the order of the rows."""
    return t.lineitem.groupBy("l_suppkey").agg(
        fn.exact_sum("l_extendedprice", 2).alias("total"), fn.exact_mean("l_extendedprice", 2, 1).alias("mean")
    )


@query(
    "surrogate_keys",
    "SELECT c_custkey, md5(CAST(c_custkey AS VARCHAR) || '-' || coalesce(nm, '_dbt_utils_surrogate_key_null_') || '-' || c_mktsegment) AS row_key, "
    "md5(coalesce(nm, '') || '-' || c_mktsegment) AS metric_key FROM (SELECT *, CASE WHEN c_custkey % 4 > 0 THEN c_name END AS nm FROM customer)",
)
def surrogate_keys(t: Tables) -> DataFrame:
    rows = t.customer.withColumn("nm", F.when(F.col("c_custkey") % 4 > 0, F.col("c_name")))
    return rows.select(
        "c_custkey",
        fn.surrogate_key(["c_custkey", "nm", "c_mktsegment"]).alias("row_key"),
        fn.metric_id(["nm", "c_mktsegment"]).alias("metric_key"),
    )


_BARE = "replace(replace(url, 'http://', ''), 'https://', '')"


@query(
    "url_parts",
    f"SELECT page_id, split_part(split_part(replace({_BARE}, 'android-app://', ''), '/', 1), '?', 1) AS host, "
    f"split_part(substr({_BARE}, coalesce(nullif(strpos({_BARE}, '/'), 0), strpos({_BARE}, '?') - 1) + 1), '?', 1) AS path, "
    "nullif(split_part(split_part(url, 'page=', 2), '&', 1), '') AS page FROM pages",
)
def url_parts(t: Tables) -> DataFrame:
    return t.pages.select(
        "page_id",
        fn.get_url_host("url").alias("host"),
        fn.get_url_path("url").alias("path"),
        fn.get_url_parameter("url", "page").alias("page"),
    )


@query(
    "text_functions",
    "SELECT p_partkey, p_type ILIKE '%steel%' AS any_case, p_type LIKE '%steel%' AS exact_case, "
    "coalesce(CASE WHEN p_size > 10 THEN p_brand END, 'NULL') || '; ' || CAST(p_size AS VARCHAR) AS joined, CAST(length(p_name) AS INT) AS n FROM part",
)
def text_functions(t: Tables) -> DataFrame:
    brand = F.when(F.col("p_size") > 10, F.col("p_brand"))
    return t.part.select(
        "p_partkey",
        fn.contains_text("p_type", "steel").alias("any_case"),
        fn.contains_text("p_type", "steel", case_sensitive=True).alias("exact_case"),
        fn.concat_with_separator([brand, "p_size"]).alias("joined"),
        F.length("p_name").alias("n"),
    )


_HAVERSINE = (
    "2 * 3961 * asin(sqrt(pow(sin(radians((b.latitude - a.latitude) / 2)), 2) + "
    "cos(radians(a.latitude)) * cos(radians(b.latitude)) * pow(sin(radians((b.longitude - a.longitude) / 2)), 2)))"
)


@query(
    "haversine_distances",
    with_ctes(
        ["pings"],
        f"SELECT a.truck_id, a.event_ts, {r(_HAVERSINE, 6)} AS miles, {r(_HAVERSINE + ' * 1.60934', 6)} AS km "
        "FROM pings a, (SELECT CAST(-25.44 AS DOUBLE) AS latitude, CAST(-49.27 AS DOUBLE) AS longitude) b",
    ),
)
def haversine_distances(t: Tables) -> DataFrame:
    """Distance of every position from the city centre."""
    centre = [F.lit(-25.44), F.lit(-49.27)]
    return derived.pings(t.events).select(
        "truck_id",
        "event_ts",
        fn.round_to(fn.haversine_distance("latitude", "longitude", *centre), 6).alias("miles"),
        fn.round_to(fn.haversine_distance("latitude", "longitude", *centre, unit="km"), 6).alias("km"),
    )


@query(
    "great_circle_distances",
    with_ctes(
        ["pings"],
        f"SELECT a.truck_id, a.event_ts, {r(ctes._distance('a', 'b'), 6)} AS km "
        "FROM pings a, (SELECT CAST(-25.44 AS DOUBLE) AS latitude, CAST(-49.27 AS DOUBLE) AS longitude) b",
    ),
)
def great_circle_distances(t: Tables) -> DataFrame:
    distance = fn.great_circle_distance("latitude", "longitude", F.lit(-25.44), F.lit(-49.27))
    return derived.pings(t.events).select("truck_id", "event_ts", fn.round_to(distance, 6).alias("km"))


@query(
    "time_arithmetic",
    "SELECT event_id, ts + INTERVAL 36 HOUR AS later, date_sub('minute', TIMESTAMP '2024-01-01', ts) AS minutes, "
    "date_trunc('hour', ts) AS hour_start, date_diff('day', DATE '2023-12-31', CAST(ts AS DATE)) AS days, "
    "date_diff('month', DATE '2023-06-15', CAST(ts AS DATE)) AS months, CAST(CAST(ts AS DATE) + INTERVAL 2 MONTH AS DATE) AS in_two_months FROM events",
)
def time_arithmetic(t: Tables) -> DataFrame:
    ts = F.col("ts")
    return t.events.select(
        "event_id",
        fn.time_add("hour", 36, ts).cast("timestamp_ntz").alias("later"),
        fn.time_diff("minute", F.lit("2024-01-01").cast("timestamp_ntz"), ts).alias("minutes"),
        fn.time_trunc("hour", ts).cast("timestamp_ntz").alias("hour_start"),
        fn.date_diff_parts("day", F.lit("2023-12-31").cast("date"), ts).alias("days"),
        fn.date_diff_parts("month", F.lit("2023-06-15").cast("date"), ts).alias("months"),
        fn.date_add_parts("month", 2, ts.cast("date")).alias("in_two_months"),
    )


@query(
    "calendar_parts",
    "SELECT event_id, dayname(ts) AS weekday, CAST(hour(ts) AS VARCHAR) AS hour_of_day, dayname(ts) || strftime(ts, '%H') AS hour_of_week, "
    "strftime(ts, '%Y-%m-%d %H:%M:%S') AS shown FROM events",
)
def calendar_parts(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id",
        fn.day_of_week("ts").alias("weekday"),
        fn.hour_of_day("ts").alias("hour_of_day"),
        fn.hour_of_week("ts").alias("hour_of_week"),
        fn.to_char("ts").alias("shown"),
    )


@query(
    "epoch_and_minutes",
    "SELECT event_id, date_trunc('millisecond', ts) AS restored, "
    "floor(date_sub('second', TIMESTAMP '2024-01-01', ts) / 60.0 * 10 + 0.5) / 10 AS minutes FROM events",
)
def epoch_and_minutes(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id",
        fn.epoch_ms_to_timestamp(F.unix_millis(F.col("ts").cast("timestamp"))).cast("timestamp_ntz").alias("restored"),
        fn.minutes_between(F.lit("2024-01-01").cast("timestamp_ntz"), "ts").alias("minutes"),
    )


@query(
    "safe_casts",
    "SELECT p_partkey, TRY_CAST(txt AS INTEGER) AS num, TRY_CAST(CASE WHEN p_partkey % 3 = 2 THEN 'soon' ELSE '2024-01-0' || (p_partkey % 9 + 1) || "
    "CASE WHEN p_partkey % 3 = 0 THEN 'T10:30:00' ELSE ' 10:30:00' END END AS TIMESTAMP) AS ts FROM "
    "(SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size AS VARCHAR) ELSE 'n/a' END AS txt FROM part)",
)
def safe_casts(t: Tables) -> DataFrame:
    key = F.col("p_partkey")
    number = F.when(key % 2 == 0, F.col("p_size").cast("string")).otherwise("n/a")
    day = F.concat(F.lit("2024-01-0"), (key % 9 + 1).cast("string"))
    time = F.when(key % 3 == 2, "soon").otherwise(
        F.concat(day, F.when(key % 3 == 0, F.lit("T10:30:00")).otherwise(F.lit(" 10:30:00")))
    )
    return t.part.select(
        "p_partkey", fn.safe_cast(number, "int").alias("num"), fn.cast_to_timestamp(time).cast("timestamp_ntz").alias("ts")
    )


@query(
    "typed_nulls",
    "SELECT o_orderkey, CAST(NULL AS DOUBLE) AS missing_number, CAST(NULL AS DATE) AS missing_day, o_orderdate <= CAST(now() AS DATE) AS is_past FROM orders",
)
def typed_nulls(t: Tables) -> DataFrame:
    """Nulls of a type, and the present instant."""
    return t.orders.select(
        "o_orderkey",
        casting.null_as("double").alias("missing_number"),
        casting.null_as("date").alias("missing_day"),
        (F.col("o_orderdate").cast("date") <= casting.as_of_timestamp().cast("date")).alias("is_past"),
    )


@query(
    "slugified_pivot",
    "SELECT o_custkey, count(*) FILTER (o_orderpriority = '1-URGENT') AS _1_urgent, count(*) FILTER (o_orderpriority = '4-NOT SPECIFIED') AS _4_not_specified FROM orders GROUP BY 1",
)
def slugified_pivot(t: Tables) -> DataFrame:
    """Column names made from values."""
    values = ["1-URGENT", "4-NOT SPECIFIED"]
    counts = [F.count(F.when(F.col("o_orderpriority") == v, 1)).alias(text.slugify(v)) for v in values]
    return t.orders.groupBy("o_custkey").agg(*counts)
