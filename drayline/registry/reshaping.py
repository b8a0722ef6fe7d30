"""Columns, pivots, unions, spines, deduplication."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, functions as F

from drayline.functions import Period
from drayline.operators import latest, reshape
from drayline.registry.base import Tables, query


@query("star_except", "SELECT c_custkey AS x_c_custkey_y, c_acctbal AS x_c_acctbal_y FROM customer")
def star_except(t: Tables) -> DataFrame:
    return reshape.star(t.customer, ["C_NAME", "c_nationkey", "c_mktsegment"], "x_", "_y")


@query("columns_ignoring", "SELECT c_custkey, c_mktsegment FROM customer")
def columns_ignoring(t: Tables) -> DataFrame:
    return t.customer.select(*reshape.columns_ignoring(t.customer, "c_na", ".*bal$"))


@query(
    "nullcheck_table",
    "SELECT c_custkey, nullif(CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_name END, '') AS c_name, c_mktsegment FROM customer",
)
def nullcheck_table(t: Tables) -> DataFrame:
    name = F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.col("c_name"))
    return reshape.nullcheck(t.customer.select("c_custkey", name.alias("c_name"), "c_mktsegment"))


@query(
    "pivot_counts",
    "SELECT l_returnflag, count(*) FILTER (l_linestatus = 'O') AS \"n_O_\", count(*) FILTER (l_linestatus = 'F') AS \"n_F_\" "
    "FROM lineitem GROUP BY 1",
)
def pivot_counts(t: Tables) -> DataFrame:
    return reshape.pivot(t.lineitem, ["l_returnflag"], "l_linestatus", ["O", "F"], prefix="n_", suffix="_")


@query(
    "pivot_distinct",
    "SELECT o_orderstatus, count(DISTINCT CASE WHEN o_orderpriority = '1-URGENT' THEN o_custkey END) AS _1_urgent, "
    "count(DISTINCT CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN o_custkey END) AS _4_not_specified FROM orders GROUP BY 1",
)
def pivot_distinct(t: Tables) -> DataFrame:
    """Another aggregate, a column as value, null otherwise, clean column names."""
    return reshape.pivot(
        t.orders, ["o_orderstatus"], "o_orderpriority", ["1-URGENT", "4-NOT SPECIFIED"],
        agg="count", distinct=True, then_value="o_custkey", else_value="null", quote_identifiers=False,
    )


@query(
    "pivot_thresholds",
    "SELECT p_brand, max(CASE WHEN p_size >= 10 THEN p_retailprice ELSE 0 END) AS size_10, "
    "max(CASE WHEN p_size >= 40 THEN p_retailprice ELSE 0 END) AS size_40 FROM part GROUP BY 1",
)
def pivot_thresholds(t: Tables) -> DataFrame:
    return reshape.pivot(
        t.part, ["p_brand"], "p_size", [10, 40], agg="max", cmp=">=", then_value="p_retailprice", else_value="0.0D", prefix="size_"
    )


@query(
    "unpivot",
    "SELECT c_custkey, field, val FROM (SELECT c_custkey, c_name, c_mktsegment, "
    "CASE WHEN c_nationkey > 10 THEN 'true' ELSE 'false' END AS far FROM customer) "
    "UNPIVOT INCLUDE NULLS (val FOR field IN (c_name, c_mktsegment, far))",
)
def unpivot(t: Tables) -> DataFrame:
    rows = t.customer.select("c_custkey", "c_acctbal", "c_name", "c_mktsegment", (F.col("c_nationkey") > 10).alias("far"))
    return reshape.unpivot(rows, ["c_custkey"], ["c_acctbal"], "field", "val")


@query(
    "union_relations",
    "SELECT 'customer' AS _source_relation, c_name AS name, c_nationkey AS nation, c_mktsegment AS segment, "
    "CAST(NULL AS DOUBLE) AS balance FROM customer UNION ALL "
    "SELECT 'supplier', s_name, s_nationkey, NULL, s_acctbal FROM supplier",
)
def union_relations(t: Tables) -> DataFrame:
    customers = t.customer.select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"))
    suppliers = t.supplier.select(
        F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance"), F.lit(1).alias("skipped")
    )
    return reshape.union_relations({"customer": customers, "supplier": suppliers}, exclude=["SKIPPED"])


@query(
    "union_relations_filtered",
    "SELECT CAST(c_custkey AS VARCHAR) AS id, c_nationkey AS nation FROM customer WHERE c_nationkey < 5 UNION ALL "
    "SELECT CAST(s_suppkey AS VARCHAR), s_nationkey FROM supplier WHERE s_nationkey < 5",
)
def union_relations_filtered(t: Tables) -> DataFrame:
    """Included columns only, another type, a filter, no source column."""
    a = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation"), "c_name")
    b = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("nation"), "s_name")
    return reshape.union_relations(
        {"a": a, "b": b}, include=["id", "nation"], column_override={"id": "string"}, source_column_name=None, where="nation < 5"
    )


@query(
    "union_distinct",
    "SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier",
)
def union_distinct(t: Tables) -> DataFrame:
    return reshape.union_distinct(
        t.customer.select(F.col("c_nationkey").alias("nation")), t.supplier.select(F.col("s_nationkey").alias("nation"))
    )


@query(
    "except_both_ways",
    "SELECT 'a_minus_b' AS which_diff, * FROM (SELECT c_nationkey, c_mktsegment FROM customer EXCEPT SELECT c_nationkey + 3, c_mktsegment FROM customer) "
    "UNION ALL SELECT 'b_minus_a', * FROM (SELECT c_nationkey + 3, c_mktsegment FROM customer EXCEPT SELECT c_nationkey, c_mktsegment FROM customer)",
)
def except_both_ways(t: Tables) -> DataFrame:
    """Segments by nation against the same three nations on."""
    here = t.customer.select("c_nationkey", "c_mktsegment")
    return reshape.except_both_ways(here, here.withColumn("c_nationkey", (F.col("c_nationkey") + 3).cast(here.schema["c_nationkey"].dataType)))


@query(
    "column_values",
    "SELECT o_orderpriority AS value, count(*) AS n FROM orders WHERE o_totalprice > 1000 GROUP BY 1 "
    "ORDER BY n DESC, value LIMIT 3",
)
def column_values(t: Tables) -> DataFrame:
    """The three most frequent values."""
    return reshape.column_values(t.orders, "o_orderpriority", "o_totalprice > 1000", 3)


@query(
    "pivot_by_column_values",
    "SELECT l_returnflag, count(*) FILTER (l_linestatus = 'F') AS \"F\", count(*) FILTER (l_linestatus = 'O') AS \"O\" "
    "FROM lineitem GROUP BY 1",
)
def pivot_by_column_values(t: Tables) -> DataFrame:
    """The values to pivot by are read from the table first."""
    return reshape.pivot(t.lineitem, ["l_returnflag"], "l_linestatus", reshape.get_column_values(t.lineitem, "l_linestatus"))


@query("group_by_first", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2")
def group_by_first(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_returnflag", "l_linestatus", "l_quantity")
    return reshape.group_by_first(rows, 2).agg(F.count(F.lit(1)).alias("n"))


@query(
    "single_value_share",
    "SELECT o_orderkey, floor(o_totalprice / (SELECT max(o_totalprice) FROM orders) * 1e6 + 0.5) / 1e6 AS share FROM orders",
)
def single_value_share(t: Tables) -> DataFrame:
    """A scalar read first, then used as a literal."""
    largest = reshape.get_single_value(t.orders.agg(F.max("o_totalprice")), 1.0)
    return t.orders.select("o_orderkey", (F.floor(F.col("o_totalprice") / largest * 1e6 + 0.5) / 1e6).alias("share"))


@query(
    "generate_series",
    "SELECT generated_number, s_name FROM (SELECT unnest(generate_series(1, (SELECT count(*) FROM supplier))) AS generated_number) "
    "LEFT JOIN supplier ON s_suppkey = generated_number",
)
def generate_series(t: Tables) -> DataFrame:
    """The numbers up to the size of a table, matched to its keys."""
    numbers = reshape.generate_series(t.spark, t.supplier.count())
    return numbers.join(t.supplier, F.col("generated_number") == F.col("s_suppkey"), "left").select("generated_number", "s_name")


@query(
    "date_spine_gap_fill",
    "SELECT CAST(d AS DATE) AS date_day, (SELECT count(*) FROM events WHERE CAST(ts AS DATE) = CAST(d AS DATE) AND event_type = 'error') AS n "
    "FROM (SELECT unnest(generate_series(TIMESTAMP '2023-12-25', TIMESTAMP '2024-02-04', INTERVAL 1 DAY)) AS d)",
)
def date_spine_gap_fill(t: Tables) -> DataFrame:
    """Every day of a range with its events, 0 where there are none."""
    days = reshape.date_spine(t.spark, "day", date(2023, 12, 25), date(2024, 2, 5))
    counts = (
        t.events.where(F.col("event_type") == "error")
        .groupBy(F.col("ts").cast("date").alias("date_day"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return days.join(counts, "date_day", "left").select("date_day", F.coalesce("n", F.lit(0)).alias("n"))


@query(
    "date_spine_months",
    "SELECT CAST(d AS DATE) AS date_month, (SELECT count(*) FROM orders WHERE date_trunc('month', o_orderdate) = d) AS n "
    "FROM (SELECT unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-01', INTERVAL 1 MONTH)) AS d)",
)
def date_spine_months(t: Tables) -> DataFrame:
    months = reshape.date_spine(t.spark, "month", "1995-01-01", "2002-01-01")
    counts = t.orders.groupBy(F.date_trunc("month", "o_orderdate").cast("date").alias("date_month")).agg(F.count(F.lit(1)).alias("n"))
    return months.join(counts, "date_month", "left").select("date_month", F.coalesce("n", F.lit(0)).alias("n"))


@query(
    "bucket_spine_gap_fill",
    "SELECT b AS bucket_start, b + INTERVAL 6 HOUR AS bucket_end, "
    "(SELECT count(*) FROM events WHERE event_type = 'view' AND ts >= b AND ts < b + INTERVAL 6 HOUR) AS n FROM "
    "(SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30 18:00:00', INTERVAL 6 HOUR)) AS b)",
)
def bucket_spine_gap_fill(t: Tables) -> DataFrame:
    """Complete six-hour buckets only: the last, cut short, is left out."""
    spine = reshape.bucket_spine(t.spark, datetime(2024, 1, 1), datetime(2024, 1, 31, 3), Period("hour", 6))
    bucket = F.window(F.col("ts").cast("timestamp"), "6 hours")["start"]
    counts = (
        t.events.where(F.col("event_type") == "view").groupBy(bucket.alias("bucket_start")).agg(F.count(F.lit(1)).alias("n"))
    )
    joined = spine.join(counts, "bucket_start", "left")
    return joined.select(
        F.col("bucket_start").cast("timestamp_ntz").alias("bucket_start"),
        F.col("bucket_end").cast("timestamp_ntz").alias("bucket_end"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


@query(
    "deduplicate",
    "SELECT event_id, user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type "
    "ORDER BY ts DESC, event_id) AS rn FROM events) WHERE rn = 1",
)
def deduplicate(t: Tables) -> DataFrame:
    rows = latest.deduplicate(t.events, ["user_id", "event_type"], [F.col("ts").desc(), F.col("event_id")])
    return rows.select("event_id", "user_id", "event_type")


@query(
    "distinct_on",
    "SELECT DISTINCT ON (o_custkey) o_custkey, o_orderkey, o_totalprice FROM orders ORDER BY o_custkey, o_totalprice DESC, o_orderkey",
)
def distinct_on(t: Tables) -> DataFrame:
    rows = latest.first_per_key(t.orders, ["o_custkey"], [F.col("o_totalprice").desc(), F.col("o_orderkey")])
    return rows.select("o_custkey", "o_orderkey", "o_totalprice")


@query(
    "top_three_per_group",
    "SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS rn FROM events) WHERE rn <= 3",
)
def top_three_per_group(t: Tables) -> DataFrame:
    rows = latest.top_n_per_key(t.events, ["user_id"], [F.col("value").desc(), F.col("event_id")], 3)
    return rows.select("user_id", "event_id", "value")


@query("latest_row", "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 1")
def latest_row(t: Tables) -> DataFrame:
    return latest.latest_row(t.orders, [F.col("o_orderdate").desc(), F.col("o_orderkey")]).select("o_orderkey", "o_orderdate")


@query("distinct_values", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def distinct_values(t: Tables) -> DataFrame:
    return t.lineitem.select("l_returnflag", "l_linestatus").distinct()


@query(
    "most_frequent_value",
    "SELECT o_custkey, o_orderpriority FROM (SELECT o_custkey, o_orderpriority, row_number() OVER (PARTITION BY o_custkey "
    "ORDER BY count(*) DESC, o_orderpriority) AS rn FROM orders GROUP BY 1, 2) WHERE rn = 1",
)
def most_frequent_value(t: Tables) -> DataFrame:
    return latest.most_frequent(t.orders, ["o_custkey"], "o_orderpriority")


@query(
    "semi_join_two_keys",
    "SELECT l_orderkey, l_partkey, l_suppkey FROM lineitem WHERE (l_partkey, l_suppkey) IN "
    "(SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45)",
)
def semi_join_two_keys(t: Tables) -> DataFrame:
    """Membership of a pair in a subquery."""
    returned = t.lineitem.where((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 45))
    return t.lineitem.join(returned.select("l_partkey", "l_suppkey"), ["l_partkey", "l_suppkey"], "left_semi").select(
        "l_orderkey", "l_partkey", "l_suppkey"
    )


@query(
    "full_outer_counts",
    "SELECT coalesce(a.k, b.k) AS k, a.n AS n_customers, b.n AS n_suppliers FROM "
    "(SELECT c_nationkey + 2 AS k, count(*) AS n FROM customer GROUP BY 1) a FULL JOIN "
    "(SELECT s_nationkey AS k, count(*) AS n FROM supplier GROUP BY 1) b ON a.k = b.k",
)
def full_outer_counts(t: Tables) -> DataFrame:
    a = t.customer.groupBy((F.col("c_nationkey") + 2).alias("k")).agg(F.count(F.lit(1)).alias("n_customers"))
    b = t.supplier.groupBy(F.col("s_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("n_suppliers"))
    return a.join(b, "k", "full_outer")
