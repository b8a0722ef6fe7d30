"""Data-quality checks on whole tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from drayline.functions import Period
from drayline.operators import checks, digests
from drayline.plans import activity, derived, marts
from drayline.registry import ctes
from drayline.registry.base import Tables, query, with_ctes
from drayline.registry.fleet import trip_rows


@query("check_unique", "SELECT l_orderkey, count(*) AS n_records FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def check_unique(t: Tables) -> DataFrame:
    return checks.unique(t.lineitem, "l_orderkey")


@query(
    "check_not_null",
    "SELECT o.event_id FROM events o LEFT JOIN labels l ON o.event_id = l.doc_id WHERE l.quality IS NULL",
)
def check_not_null(t: Tables) -> DataFrame:
    labelled = t.events.join(t.labels, F.col("event_id") == F.col("doc_id"), "left")
    return checks.not_null(labelled, "quality").select("event_id")


@query(
    "check_accepted_range",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE NOT (l_quantity >= 2) OR NOT (l_quantity <= 48)",
)
def check_accepted_range(t: Tables) -> DataFrame:
    return checks.accepted_range(t.lineitem, "l_quantity", 2, 48).select("l_orderkey", "l_linenumber", "l_quantity")


@query("check_accepted_range_exclusive", "SELECT c_custkey FROM customer WHERE NOT (c_acctbal > 0)")
def check_accepted_range_exclusive(t: Tables) -> DataFrame:
    return checks.accepted_range(t.customer, "c_acctbal", min_value=0, inclusive=False).select("c_custkey")


@query(
    "check_accepted_values",
    "SELECT event_type AS value_field, count(*) AS n_records FROM events WHERE event_type NOT IN ('click', 'view') GROUP BY 1",
)
def check_accepted_values(t: Tables) -> DataFrame:
    return checks.accepted_values(t.events, "event_type", ["click", "view"])


@query(
    "check_not_accepted_values",
    "SELECT DISTINCT c_mktsegment AS value_field FROM customer WHERE c_mktsegment IN ('BUILDING', 'SPACE')",
)
def check_not_accepted_values(t: Tables) -> DataFrame:
    return checks.not_accepted_values(t.customer, "c_mktsegment", ["BUILDING", "SPACE"])


@query(
    "check_relationships",
    "SELECT o_custkey AS from_id FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)",
)
def check_relationships(t: Tables) -> DataFrame:
    return checks.relationships(t.orders, "o_custkey", t.customer.where(F.col("c_acctbal") > 0), "c_custkey")


@query(
    "check_relationships_where",
    "SELECT l_partkey AS from_id FROM lineitem WHERE l_quantity > 20 AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 25)",
)
def check_relationships_where(t: Tables) -> DataFrame:
    return checks.relationships_where(t.lineitem, "l_partkey", t.part, "p_partkey", "l_quantity > 20", "p_size < 25")


@query(
    "check_at_least_one",
    "SELECT user_id, count(v) AS filler_column FROM (SELECT user_id, CASE WHEN user_id % 3 = 0 AND event_type = 'none' OR user_id % 3 > 0 THEN value END AS v FROM events) GROUP BY 1 HAVING count(v) = 0",
)
def check_at_least_one(t: Tables) -> DataFrame:
    rows = t.events.withColumn("v", F.when(F.col("user_id") % 3 > 0, F.col("value")))
    return checks.at_least_one(rows, "v", ["user_id"])


@query(
    "check_not_constant",
    "SELECT c_nationkey, CAST(1 AS BIGINT) AS filler_column FROM (SELECT c_nationkey, c_nationkey % 3 = 0 OR c_custkey % 50 < 49 AS flag FROM customer) GROUP BY 1 HAVING count(DISTINCT flag) = 1",
)
def check_not_constant(t: Tables) -> DataFrame:
    rows = t.customer.select("c_nationkey", ((F.col("c_nationkey") % 3 == 0) | (F.col("c_custkey") % 50 < 49)).alias("flag"))
    return checks.not_constant(rows, "flag", ["c_nationkey"])


@query(
    "check_not_empty_string",
    "SELECT c_custkey FROM customer WHERE trim(CASE WHEN c_custkey % 10 = 0 THEN '  ' ELSE c_name END) = ''",
)
def check_not_empty_string(t: Tables) -> DataFrame:
    rows = t.customer.withColumn("c_name", F.when(F.col("c_custkey") % 10 == 0, "  ").otherwise(F.col("c_name")))
    return checks.not_empty_string(rows, "c_name").select("c_custkey")


@query(
    "check_not_null_proportion",
    "SELECT o_orderpriority, count(v) / count(*) AS not_null_proportion FROM (SELECT o_orderpriority, CASE WHEN o_orderkey % 4 > 0 THEN 1 END AS v FROM orders) GROUP BY 1 HAVING count(v) / count(*) < 0.75 OR count(v) / count(*) > 0.76",
)
def check_not_null_proportion(t: Tables) -> DataFrame:
    rows = t.orders.withColumn("v", F.when(F.col("o_orderkey") % 4 > 0, 1))
    return checks.not_null_proportion(rows, "v", 0.75, 0.76, ["o_orderpriority"])


@query(
    "check_unique_combination",
    "SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def check_unique_combination(t: Tables) -> DataFrame:
    return checks.unique_combination_of_columns(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("check_expression", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE NOT (l_discount + l_tax < 0.15)")
def check_expression(t: Tables) -> DataFrame:
    return checks.expression_is_true(t.lineitem, "l_discount + l_tax < 0.15D").select("l_orderkey", "l_linenumber")


@query("check_column_expression", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE NOT (l_quantity > 3)")
def check_column_expression(t: Tables) -> DataFrame:
    return checks.expression_is_true(t.lineitem, "> 3", "l_quantity").select("l_orderkey", "l_linenumber")


@query(
    "check_recency",
    "SELECT user_id, max(ts) AS most_recent, TIMESTAMP '2024-01-30 12:00:00' AS threshold FROM events GROUP BY 1 HAVING max(ts) < TIMESTAMP '2024-01-30 12:00:00'",
)
def check_recency(t: Tables) -> DataFrame:
    return checks.recency(t.events, "ts", datetime(2024, 1, 31), Period("hour", 12), group_by=["user_id"])


@query(
    "check_recency_by_date",
    "SELECT event_type, CAST(max(ts) AS DATE) AS most_recent, DATE '2024-02-01' AS threshold FROM events GROUP BY 1 HAVING CAST(max(ts) AS DATE) < DATE '2024-02-01'",
)
def check_recency_by_date(t: Tables) -> DataFrame:
    return checks.recency(t.events, "ts", datetime(2024, 2, 3, 9), Period("day", 2), True, ["event_type"])


_SEQUENCE = (
    "SELECT o_custkey, o_orderkey, previous_o_orderkey FROM (SELECT o_custkey, o_orderkey, "
    "lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS previous_o_orderkey FROM orders) WHERE NOT (o_orderkey = previous_o_orderkey + 1)"
)


@query("check_sequential_values", _SEQUENCE)
def check_sequential_values(t: Tables) -> DataFrame:
    return checks.sequential_values(t.orders, "o_orderkey", group_by=["o_custkey"])


@query(
    "check_sequential_values_ungrouped",
    "SELECT l_orderkey, previous_l_orderkey FROM (SELECT l_orderkey, lag(l_orderkey) OVER (ORDER BY l_orderkey) AS previous_l_orderkey FROM lineitem) WHERE NOT (l_orderkey = previous_l_orderkey + 1)",
)
def check_sequential_values_ungrouped(t: Tables) -> DataFrame:
    """A table without groups, cut into chunks of a thousand values; repeated values included."""
    return checks.sequential_values(t.lineitem, "l_orderkey", rows_per_chunk=1000)


@query(
    "check_sequential_timestamps",
    "SELECT user_id, day, previous_day FROM (SELECT user_id, day, lag(day) OVER (PARTITION BY user_id ORDER BY day) AS previous_day FROM "
    "(SELECT DISTINCT user_id, date_trunc('day', ts) AS day FROM events)) WHERE NOT (day = previous_day + INTERVAL 1 DAY)",
)
def check_sequential_timestamps(t: Tables) -> DataFrame:
    """Users with a day missing between two days."""
    days = t.events.select("user_id", F.date_trunc("day", "ts").alias("day")).distinct()
    found = checks.sequential_values(days, "day", 1, "day", ["user_id"])
    return found.select("user_id", F.col("day").cast("timestamp_ntz").alias("day"), F.col("previous_day").cast("timestamp_ntz").alias("previous_day"))


def _ranges_sql(partition: str | None, operator: str, zero: str) -> str:
    by = f"PARTITION BY {partition}" if partition else ""
    head = f"{partition} AS partition_by_col, " if partition else ""
    names = ("partition_by_col, " if partition else "") + "lower_bound, upper_bound, next_lower_bound"
    return (
        f"SELECT {names} FROM (SELECT {head}a AS lower_bound, b AS upper_bound, "
        f"lead(a) OVER ({by} ORDER BY a, b) AS next_lower_bound, row_number() OVER ({by} ORDER BY a DESC, b DESC) = 1 AS is_last "
        "FROM (SELECT o_custkey, o_orderkey * 10 AS a, o_orderkey * 10 + o_orderkey % 400 AS b FROM orders)) "
        f"WHERE NOT (coalesce(lower_bound {zero} upper_bound, false) AND coalesce(upper_bound {operator} next_lower_bound, is_last, false))"
    )


def _ranges(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    return t.orders.select("o_custkey", (key * 10).alias("a"), (key * 10 + key % 400).alias("b"))


@query("check_ranges_allowed", _ranges_sql("o_custkey", "<=", "<"))
def check_ranges_allowed(t: Tables) -> DataFrame:
    found = checks.mutually_exclusive_ranges(_ranges(t), "a", "b", "o_custkey")
    return found.select("partition_by_col", "lower_bound", "upper_bound", "next_lower_bound")


@query("check_ranges_required", _ranges_sql("o_custkey", "<", "<="))
def check_ranges_required(t: Tables) -> DataFrame:
    found = checks.mutually_exclusive_ranges(_ranges(t), "a", "b", "o_custkey", "required", True)
    return found.select("partition_by_col", "lower_bound", "upper_bound", "next_lower_bound")


@query("check_ranges_ungrouped", _ranges_sql(None, "=", "<"))
def check_ranges_ungrouped(t: Tables) -> DataFrame:
    """The whole table as one sequence without gaps, cut into chunks."""
    found = checks.mutually_exclusive_ranges(_ranges(t), "a", "b", gaps="not_allowed", rows_per_chunk=1000)
    return found.select("lower_bound", "upper_bound", "next_lower_bound")


_A = "SELECT c_nationkey, c_mktsegment FROM customer WHERE c_acctbal > 0"
_B = "SELECT c_nationkey, c_mktsegment FROM customer WHERE c_custkey % 40 = 0"


def _two(t: Tables) -> tuple[DataFrame, DataFrame]:
    columns = ["c_nationkey", "c_mktsegment"]
    return t.customer.where(F.col("c_acctbal") > 0).select(*columns), t.customer.where(F.col("c_custkey") % 40 == 0).select(*columns)


@query(
    "check_equality",
    f"SELECT 'a_minus_b' AS which_diff, * FROM ({_A} EXCEPT {_B}) UNION ALL SELECT 'b_minus_a', * FROM ({_B} EXCEPT {_A})",
)
def check_equality(t: Tables) -> DataFrame:
    return checks.equality(*_two(t))


@query(
    "check_equality_digests",
    f"SELECT 'a_minus_b' AS which_diff, * FROM ({_A} EXCEPT ALL {_B}) UNION ALL SELECT 'b_minus_a', * FROM ({_B} EXCEPT ALL {_A})",
)
def check_equality_digests(t: Tables) -> DataFrame:
    """The same by digests of buckets: rows are compared where these differ."""
    return digests.equality_by_digest(*_two(t), keep_duplicates=True)


@query(
    "check_lineitem_digests",
    "WITH b AS (SELECT * EXCLUDE (l_discount), CASE WHEN l_orderkey % 1000 = 7 THEN NULL ELSE l_discount END AS l_discount FROM lineitem "
    "WHERE l_orderkey % 1000 <> 11) SELECT 'a_minus_b' AS which_diff, l_orderkey, l_linenumber, l_discount FROM lineitem "
    "WHERE l_orderkey % 1000 = 11 OR (l_orderkey % 1000 = 7 AND l_discount IS NOT NULL) "
    "UNION ALL SELECT 'b_minus_a', l_orderkey, l_linenumber, l_discount FROM b WHERE l_orderkey % 1000 = 7 AND l_discount IS NULL",
)
def check_lineitem_digests(t: Tables) -> DataFrame:
    """A large table against a copy with some orders lost and some values emptied."""
    order = F.col("l_orderkey") % 1000
    copy = t.lineitem.where(order != 11).withColumn("l_discount", F.when(order == 7, None).otherwise(F.col("l_discount")))
    found = digests.equality_by_digest(t.lineitem, copy, key=["l_orderkey"], keep_duplicates=True)
    return found.select("which_diff", "l_orderkey", "l_linenumber", "l_discount")


@query(
    "check_equality_with_duplicates",
    f"SELECT 'a_minus_b' AS which_diff, * FROM ({_A} EXCEPT ALL {_B}) UNION ALL SELECT 'b_minus_a', * FROM ({_B} EXCEPT ALL {_A})",
)
def check_equality_with_duplicates(t: Tables) -> DataFrame:
    return checks.equality(*_two(t), keep_duplicates=True)


@query(
    "check_equality_failures",
    f"SELECT count(*) + abs(count(*) FILTER (w = 'a') - count(*) FILTER (w = 'b')) AS failures FROM (SELECT 'a' AS w, * FROM ({_A} EXCEPT {_B}) UNION ALL SELECT 'b', * FROM ({_B} EXCEPT {_A}))",
)
def check_equality_failures(t: Tables) -> DataFrame:
    return checks.equality_failures(checks.equality(*_two(t)))


@query(
    "check_cardinality_equality",
    "WITH a AS (SELECT c_nationkey AS value, count(*) AS num_rows FROM customer GROUP BY 1), b AS (SELECT s_nationkey AS value, count(*) AS num_rows FROM supplier GROUP BY 1) "
    "SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT 'b_minus_a', * FROM (SELECT * FROM b EXCEPT SELECT * FROM a)",
)
def check_cardinality_equality(t: Tables) -> DataFrame:
    return checks.cardinality_equality(t.customer, "c_nationkey", t.supplier, "s_nationkey")


_COUNTS = (
    "SELECT a.k AS nation_a, b.k AS nation_b, a.n AS {a}, b.n AS {b} FROM (SELECT c_nationkey + 3 AS k, count(*) AS n FROM customer GROUP BY 1) a "
    "FULL JOIN (SELECT s_nationkey AS k, count(*) AS n FROM supplier GROUP BY 1) b ON a.k = b.k"
)


def _nations(t: Tables) -> tuple[DataFrame, DataFrame]:
    a = t.customer.select((F.col("c_nationkey") + 3).alias("nation"))
    return a, t.supplier.select(F.col("s_nationkey").alias("nation"))


@query(
    "check_equal_rowcount",
    f"SELECT *, abs(count_a - count_b) AS diff_count FROM ({_COUNTS.format(a='count_a', b='count_b')})",
)
def check_equal_rowcount(t: Tables) -> DataFrame:
    return checks.equal_rowcount(*_nations(t), ["nation"])


@query(
    "check_fewer_rows_than",
    f"SELECT *, CASE WHEN count_our_model > count_comparison_model THEN count_our_model - count_comparison_model "
    f"WHEN count_our_model = count_comparison_model THEN 1 ELSE 0 END AS row_count_delta FROM ({_COUNTS.format(a='count_our_model', b='count_comparison_model')})",
)
def check_fewer_rows_than(t: Tables) -> DataFrame:
    return checks.fewer_rows_than(*_nations(t), ["nation"])


@query(
    "check_fewer_rows_total",
    "SELECT (SELECT count(*) FROM orders) AS count_our_model, (SELECT count(*) FROM lineitem) AS count_comparison_model, CAST(0 AS BIGINT) AS row_count_delta",
)
def check_fewer_rows_total(t: Tables) -> DataFrame:
    return checks.fewer_rows_than(t.orders, t.lineitem)


@query(
    "check_failed_row_count",
    "SELECT count(*) AS failures FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)",
)
def check_failed_row_count(t: Tables) -> DataFrame:
    return checks.failed_row_count(checks.unique_combination_of_columns(t.lineitem, ["l_orderkey", "l_linenumber"]))


@query("check_json", "SELECT event_id FROM events WHERE CAST(json_extract_string(props, '$.k') AS INT) > 50")
def check_json(t: Tables) -> DataFrame:
    """Properties must be an object whose ``k`` is an integer up to 50."""
    schema = {"type": "object", "required": ["k"], "properties": {"k": {"type": "integer", "maximum": 50}}}
    return checks.json_conformance(t.events, "props", schema).select("event_id")


@query(
    "check_json_string",
    "SELECT p_partkey FROM part WHERE p_partkey % 7 = 0 OR NOT length(p_brand) BETWEEN 3 AND 8",
)
def check_json_string(t: Tables) -> DataFrame:
    """A JSON string of three to eight characters; a bare number is not a string."""
    text = F.when(F.col("p_partkey") % 7 == 0, "12").otherwise(F.concat(F.lit('"'), "p_brand", F.lit('"')))
    rows = t.part.select("p_partkey", text.alias("doc"))
    return checks.json_conformance(rows, "doc", {"type": "string", "minLength": 3, "maxLength": 8}).select("p_partkey")


@query(
    "check_source_freshness",
    "SELECT 'events' AS unique_id, max(ts) AS max_loaded_at, TIMESTAMP '2024-01-31 12:00:00' AS snapshotted_at, "
    "CAST(date_sub('second', max(ts), TIMESTAMP '2024-01-31 12:00:00') AS DOUBLE) AS max_loaded_at_time_ago_in_s, "
    "CASE WHEN max(ts) < TIMESTAMP '2024-01-29 12:00:00' THEN 'error' WHEN max(ts) < TIMESTAMP '2024-01-31 06:00:00' THEN 'warn' ELSE 'pass' END AS status FROM events",
)
def check_source_freshness(t: Tables) -> DataFrame:
    found = checks.source_freshness(t.events, "ts", datetime(2024, 1, 31, 12), Period("hour", 6), Period("day", 2), name="events")
    return found.withColumn("max_loaded_at", F.col("max_loaded_at").cast("timestamp_ntz")).withColumn(
        "snapshotted_at", F.col("snapshotted_at").cast("timestamp_ntz")
    )


@query(
    "check_python",
    "SELECT l_returnflag, floor(sum(l_discount) / count(*) * 1e4 + 0.5) / 1e4 AS mean_discount FROM lineitem WHERE l_quantity > 10 GROUP BY 1 HAVING sum(l_discount) / count(*) > 0.04",
)
def check_python(t: Tables) -> DataFrame:
    """A user function as a check, with a filter and arguments."""

    def too_generous(rows: DataFrame, limit: float) -> DataFrame:
        mean = F.avg("l_discount")
        grouped = rows.groupBy("l_returnflag").agg(mean.alias("m")).where(F.col("m") > limit)
        return grouped.select("l_returnflag", (F.floor(F.col("m") * 1e4 + 0.5) / 1e4).alias("mean_discount"))

    return checks.python_check(t.lineitem, too_generous, "l_quantity > 10", {"limit": 0.04})


@query("check_python_rows", "SELECT c_custkey, c_name FROM customer WHERE right(c_name, 1) = '7' AND c_nationkey < 20")
def check_python_rows(t: Tables) -> DataFrame:
    """A row rule in Python over Arrow batches."""
    rows = t.customer.select("c_custkey", "c_name", "c_nationkey")
    return checks.row_check(rows, lambda batch: ~batch["c_name"].str.endswith("7"), "c_nationkey < 20").select("c_custkey", "c_name")


@query(
    "stored_failing_rows",
    "SELECT 'r1' AS test_result_id, l_orderkey AS k FROM lineitem WHERE l_quantity > 49",
)
def stored_failing_rows(t: Tables) -> DataFrame:
    """All violating rows as JSON, read back by key."""
    bad = checks.accepted_range(t.lineitem, "l_quantity", max_value=49)
    rows = checks.failing_rows(bad, "r1", sample=None)
    return rows.select("test_result_id", F.get_json_object("result_row", "$.l_orderkey").cast("bigint").alias("k"))


@query(
    "mart_checks",
    with_ctes(
        ctes.FLEET[: ctes.FLEET.index("fleet_days")] + ["otd_days", "otd_mart", "heatmap"],
        "SELECT 'order_trips' AS table_name, 'unique_order_id' AS test_name, CAST(sum(CASE WHEN n > 1 THEN 1 ELSE 0 END) AS BIGINT) AS failures, 'pass' AS status FROM (SELECT count(*) AS n FROM trips GROUP BY order_id) "
        "UNION ALL SELECT 'order_trips', 'not_null_order_id', count(*), 'pass' FROM trips WHERE order_id IS NULL "
        "UNION ALL SELECT 'order_trips', 'not_null_truck_id', count(*), 'pass' FROM trips WHERE truck_id IS NULL "
        "UNION ALL SELECT 'order_trips', 'not_null_total_distance_km', count(*), CASE WHEN count(*) > 0 THEN 'warn' ELSE 'pass' END FROM trips WHERE total_distance_km IS NULL "
        "UNION ALL SELECT 'order_trips', 'not_null_total_duration_min', count(*), 'pass' FROM trips WHERE total_duration_min IS NULL "
        "UNION ALL SELECT 'order_trips', 'accepted_range_total_duration_min', count(*), 'pass' FROM trips WHERE total_duration_min NOT BETWEEN 0 AND 120 "
        "UNION ALL SELECT 'truck_activity', 'not_null_truck_id', count(*), 'pass' FROM activity WHERE truck_id IS NULL "
        "UNION ALL SELECT 'truck_activity', 'not_null_activity_date', count(*), 'pass' FROM activity WHERE activity_date IS NULL "
        "UNION ALL SELECT 'truck_activity', 'not_null_trips_completed', count(*), 'pass' FROM activity WHERE trips_completed IS NULL "
        "UNION ALL SELECT 'otd', 'not_null_district', count(*), 'pass' FROM otd_mart WHERE district IS NULL "
        "UNION ALL SELECT 'otd', 'not_null_total_orders', count(*), 'pass' FROM otd_mart WHERE total_orders IS NULL "
        "UNION ALL SELECT 'district_heatmap', 'not_null_origin_district', count(*), 'pass' FROM heatmap WHERE origin_district IS NULL "
        "UNION ALL SELECT 'district_heatmap', 'not_null_order_count', count(*), 'pass' FROM heatmap WHERE order_count IS NULL",
    ),
)
def mart_checks(t: Tables) -> DataFrame:
    """The declared column tests on trips, truck-days and marts."""
    trips = trip_rows(t)
    days = activity.truck_activity(trips, derived.registry(t.events), derived.pings(t.events))
    built = {
        "order_trips": trips,
        "truck_activity": days,
        "otd": marts.otd(trips),
        "district_heatmap": marts.district_heatmap(trips),
    }
    results = None
    for table, df in built.items():
        rows = checks.run_checks(df, checks.mart_checks()[table], table, datetime(2024, 2, 1))
        results = rows if results is None else results.unionByName(rows)
    return results.select("table_name", "test_name", "failures", "status")
