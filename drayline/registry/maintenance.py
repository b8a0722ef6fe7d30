"""Incremental loading and table maintenance."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, functions as F

from drayline.operators import incremental
from drayline.registry.base import Tables, query
from drayline.session import cut_lineage, shared_dir
from drayline.sources import tables
from drayline.sources.tables import PartitionedTable, SnapshotTable, partition_for_series, with_key_bucket

_BALANCE = "CASE WHEN c_custkey % 3 = 0 THEN c_acctbal * 2 ELSE c_acctbal END"


def _old_customers(t: Tables) -> DataFrame:
    return t.customer.where(F.col("c_custkey") % 4 != 1).select("c_custkey", "c_name", "c_acctbal")


def _new_customers(t: Tables) -> DataFrame:
    changed = t.customer.where((F.col("c_custkey") % 3 == 0) | (F.col("c_custkey") % 4 == 1))
    balance = F.when(F.col("c_custkey") % 3 == 0, F.col("c_acctbal") * 2).otherwise(F.col("c_acctbal"))
    return changed.select("c_custkey", "c_name", balance.alias("c_acctbal"), "c_mktsegment")


@query(
    "high_watermark_rows",
    "SELECT event_id, ts FROM events WHERE ts > (SELECT max(ts) FROM events WHERE event_id % 3 = 0 AND ts < TIMESTAMP '2024-01-20')",
)
def high_watermark_rows(t: Tables) -> DataFrame:
    stored = t.events.where((F.col("event_id") % 3 == 0) & (F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz")))
    return incremental.after_watermark(t.events, stored, "ts").select("event_id", "ts")


@query(
    "reprocess_last_day",
    "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= "
    "(SELECT max(o_orderdate) FROM orders WHERE o_orderdate < TIMESTAMP '1999-06-01')",
)
def reprocess_last_day(t: Tables) -> DataFrame:
    stored = t.orders.where(F.col("o_orderdate") < F.lit("1999-06-01").cast("timestamp_ntz"))
    return incremental.after_watermark(t.orders, stored, "o_orderdate", inclusive=True).select("o_orderkey", "o_orderdate")


_MERGED = (
    f"SELECT c_custkey, c_name, {_BALANCE} AS c_acctbal, "
    "CASE WHEN c_custkey % 3 = 0 OR c_custkey % 4 = 1 THEN c_mktsegment END AS c_mktsegment FROM customer"
)


@query("merge_upsert_sync_columns", _MERGED)
def merge_upsert_sync_columns(t: Tables) -> DataFrame:
    """Updates and inserts with a column the target lacks."""
    return incremental.merge_upsert(_old_customers(t), _new_customers(t), ["c_custkey"])


@query(
    "merge_upsert_append_columns",
    f"SELECT c_custkey, c_name, {_BALANCE} AS c_acctbal, "
    "CASE WHEN c_custkey % 3 = 0 OR c_custkey % 4 = 1 THEN c_mktsegment END AS c_mktsegment, "
    "CASE WHEN NOT (c_custkey % 3 = 0 OR c_custkey % 4 = 1) THEN 'kept' END AS origin FROM customer",
)
def merge_upsert_append_columns(t: Tables) -> DataFrame:
    """New columns are added, the target's own survive."""
    stored = _old_customers(t).withColumn("origin", F.lit("kept"))
    return incremental.merge_upsert(stored, _new_customers(t), ["c_custkey"], "append_new_columns")


@query(
    "merge_composite_key",
    "SELECT l_orderkey, l_suppkey, CAST(sum(l_quantity) AS DOUBLE) AS quantity, "
    "max(l_shipdate) >= TIMESTAMP '2000-01-01' AS refreshed FROM lineitem GROUP BY 1, 2",
)
def merge_composite_key(t: Tables) -> DataFrame:
    """Totals per (order, supplier); those with a recent line are recomputed."""
    totals = t.lineitem.groupBy("l_orderkey", "l_suppkey").agg(
        F.sum("l_quantity").alias("quantity"), F.max("l_shipdate").alias("last")
    )
    recent = F.col("last") >= F.lit("2000-01-01").cast("timestamp_ntz")
    stored = totals.select("l_orderkey", "l_suppkey", F.when(recent, 0.0).otherwise(F.col("quantity")).alias("quantity"), F.lit(False).alias("refreshed"))
    batch = totals.where(recent).select("l_orderkey", "l_suppkey", "quantity", F.lit(True).alias("refreshed"))
    return incremental.merge_upsert(stored, batch, ["l_orderkey", "l_suppkey"])


@query(
    "merge_keep_last_values",
    "SELECT c_custkey, CASE WHEN c_custkey % 6 = 1 THEN NULL ELSE c_name END AS c_name, c_custkey % 2 = 1 AS is_deleted "
    "FROM customer",
)
def merge_keep_last_values(t: Tables) -> DataFrame:
    """Delete events carry the key only; the stored name survives where there was one."""
    key = F.col("c_custkey")
    stored = t.customer.select(
        "c_custkey", F.when(key % 6 == 1, None).otherwise(F.col("c_name")).alias("c_name"), F.lit(False).alias("is_deleted")
    )
    deletes = t.customer.where(key % 2 == 1).select(
        "c_custkey", F.lit(None).cast("string").alias("c_name"), F.lit(True).alias("is_deleted")
    )
    return incremental.merge_keep_last(stored, deletes, ["c_custkey"], F.col("is_deleted"), ["c_name"])


@query(
    "append_absent_events",
    "SELECT event_id, user_id, ts FROM events WHERE event_id % 2 = 0 AND event_id % 3 <> 0",
)
def append_absent_events(t: Tables) -> DataFrame:
    """Rows already stored are left out; the stored side is limited to the batch's time range."""
    rows = t.events.select("event_id", "user_id", "ts")
    stored = rows.where(F.col("event_id") % 3 == 0)
    batch = rows.where(F.col("event_id") % 2 == 0)
    return incremental.append_absent(stored, batch, ["user_id", "ts"], range_col="ts")


@query(
    "sync_all_columns",
    "SELECT c_custkey, CAST(NULL AS VARCHAR) AS c_phone, c_name FROM customer",
)
def sync_all_columns(t: Tables) -> DataFrame:
    """Columns follow the source: one gone, one new."""
    target = t.customer.select("c_custkey", "c_name", "c_acctbal")
    shape = t.customer.select("c_custkey", F.lit("x").alias("c_phone"), "c_name").limit(0)
    return incremental.sync_all_columns(target, shape)


@query(
    "lookback_rows",
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '1998-12-25'",
)
def lookback_rows(t: Tables) -> DataFrame:
    dated = t.orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    return incremental.within_lookback(dated, "day", date(1999, 1, 1), 7)


@query(
    "context_rows",
    "SELECT o_custkey, day, n FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY day DESC) AS rn FROM "
    "(SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1, 2) "
    "WHERE day < DATE '1999-01-01') WHERE rn <= 6",
)
def context_rows(t: Tables) -> DataFrame:
    """The last six stored days per customer before a refresh."""
    days = t.orders.groupBy("o_custkey", F.col("o_orderdate").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return incremental.context_rows(days, ["o_custkey"], "day", date(1999, 1, 1), 6)


@query(
    "delete_and_insert",
    "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey % 10 <> 0 AND c_mktsegment <> 'BUILDING' "
    "UNION ALL SELECT c_custkey + 1000000, 'new ' || c_name, 0 FROM customer WHERE c_custkey % 10 = 0",
)
def delete_and_insert(t: Tables) -> DataFrame:
    """Rows with a listed or missing key go, new rows come."""
    key = F.col("c_custkey")
    stored = t.customer.select(
        F.when(F.col("c_mktsegment") != "BUILDING", key).alias("c_custkey"), "c_name", "c_acctbal"
    )
    tenth = t.customer.where(key % 10 == 0)
    new = tenth.select((key + 1000000).alias("c_custkey"), F.concat(F.lit("new "), "c_name").alias("c_name"), F.lit(0.0).alias("c_acctbal"))
    return incremental.delete_and_insert(stored, new, tenth.select("c_custkey"), "c_custkey")


def _hashed(df: DataFrame, changed) -> DataFrame:
    rows = df.select("p_partkey", "p_brand", F.when(changed, F.col("p_size") + 1).otherwise(F.col("p_size")).alias("p_size"))
    return rows.withColumn("metadata_hash", incremental.row_hash(["p_partkey", "p_brand", "p_size"]))


@query(
    "hash_diff",
    """WITH old AS (SELECT p_partkey, p_brand, p_size FROM part WHERE p_partkey % 9 <> 0),
    new AS (SELECT p_partkey, p_brand, p_size + CASE WHEN p_partkey % 8 = 0 THEN 1 ELSE 0 END AS p_size FROM part WHERE p_partkey % 13 <> 0)
    SELECT 'add' AS action, * FROM (SELECT * FROM new EXCEPT SELECT * FROM old)
    UNION ALL SELECT 'remove', * FROM (SELECT * FROM old EXCEPT SELECT * FROM new)""",
)
def hash_diff(t: Tables) -> DataFrame:
    stored = _hashed(t.part.where(F.col("p_partkey") % 9 != 0), F.lit(False))
    current = _hashed(t.part.where(F.col("p_partkey") % 13 != 0), F.col("p_partkey") % 8 == 0)
    return incremental.diff_by_hash(stored, current).drop("metadata_hash")


@query(
    "hash_sync",
    "SELECT p_partkey, p_brand, p_size + CASE WHEN p_partkey % 8 = 0 THEN 1 ELSE 0 END AS p_size FROM part WHERE p_partkey % 13 <> 0",
)
def hash_sync(t: Tables) -> DataFrame:
    stored = _hashed(t.part.where(F.col("p_partkey") % 9 != 0), F.lit(False))
    current = _hashed(t.part.where(F.col("p_partkey") % 13 != 0), F.col("p_partkey") % 8 == 0)
    return incremental.apply_hash_diff(stored, current).drop("metadata_hash")


@query(
    "insert_if_absent",
    "SELECT l_orderkey, l_linenumber, min(l_extendedprice) AS price FROM lineitem "
    "WHERE l_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber = 7) GROUP BY 1, 2",
)
def insert_if_absent(t: Tables) -> DataFrame:
    """Two sources with overlapping keys; keys already stored are skipped."""
    rows = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("price"))
    returned = t.lineitem.where(F.col("l_returnflag") == "R").select("l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("price"))
    full = rows.where(F.col("l_linenumber") == 7).select("l_orderkey").distinct()
    stored = rows.join(full, "l_orderkey", "left_semi")
    return incremental.insert_if_absent(stored, [rows, returned], ["l_orderkey", "l_linenumber"], [F.col("price").asc()])


@query(
    "day_ranges",
    "SELECT CAST(d AS DATE) AS range_start, CAST(d AS DATE) + 1 AS range_end FROM (SELECT unnest(generate_series("
    "date_trunc('day', least((SELECT min(ts) FROM events), (SELECT min(o_orderdate) FROM orders))), "
    "date_trunc('day', greatest((SELECT max(ts) FROM events), (SELECT max(o_orderdate) FROM orders))) + INTERVAL 7 DAY, "
    "INTERVAL 1 DAY)) AS d)",
)
def day_ranges(t: Tables) -> DataFrame:
    """Daily partitions that cover two tables, and a week more."""
    return incremental.day_ranges([t.events.select("ts"), t.orders.select(F.col("o_orderdate").alias("ts"))], "ts")


@query(
    "drop_exact_duplicates",
    "SELECT DISTINCT l_returnflag, l_linestatus, l_quantity FROM lineitem WHERE l_quantity <= 45 UNION ALL "
    "SELECT l_returnflag, l_linestatus, NULL FROM lineitem WHERE l_quantity > 45",
)
def drop_exact_duplicates(t: Tables) -> DataFrame:
    """One of each; rows with a null stay as they are."""
    quantity = F.when(F.col("l_quantity") <= 45, F.col("l_quantity")).alias("l_quantity")
    return incremental.drop_exact_duplicates(t.lineitem.select("l_returnflag", "l_linestatus", quantity))


@query(
    "delete_where",
    "SELECT c_custkey, bal FROM (SELECT c_custkey, CASE WHEN c_custkey % 5 > 0 THEN c_acctbal END AS bal FROM customer) "
    "WHERE NOT coalesce(bal < 1000, false)",
)
def delete_where(t: Tables) -> DataFrame:
    """A row for which the predicate is unknown is kept."""
    rows = t.customer.select("c_custkey", F.when(F.col("c_custkey") % 5 > 0, F.col("c_acctbal")).alias("bal"))
    return incremental.delete_where(rows, "bal < 1000")


# --- stored tables ------------------------------------------------------------------


@query("snapshot_table_merge", _MERGED)
def snapshot_table_merge(t: Tables) -> DataFrame:
    """Write, merge, read back: versions side by side."""
    table = SnapshotTable(t.spark, f"{shared_dir(t.spark)}/snapshot_table_merge-{_run()}")
    table.merge(_old_customers(t), ["c_custkey"])
    table.merge(_new_customers(t), ["c_custkey"])
    return table.read()


@query("partitioned_table_merge", f"SELECT c_custkey, c_name, {_BALANCE} AS c_acctbal FROM customer")
def partitioned_table_merge(t: Tables) -> DataFrame:
    """Only partitions with a changed key are rewritten."""
    folder = shared_dir(t.spark)
    table = PartitionedTable(t.spark, f"{folder}/partitioned_table_merge-{_run()}", ["_key_bucket"], folder)
    table.overwrite(with_key_bucket(_old_customers(t), ["c_custkey"], 8))
    table.merge(with_key_bucket(_new_customers(t).drop("c_mktsegment"), ["c_custkey"], 8), ["c_custkey"])
    return table.read().drop("_key_bucket")


@query(
    "partitioned_table_moves",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'MOVED' ELSE o_orderpriority END AS o_orderpriority FROM orders",
)
def partitioned_table_moves(t: Tables) -> DataFrame:
    """Keys that change their partition leave no stale row behind."""
    folder = shared_dir(t.spark)
    table = PartitionedTable(t.spark, f"{folder}/partitioned_table_moves-{_run()}", ["o_orderpriority"], folder)
    rows = t.orders.select("o_orderkey", "o_orderpriority")
    table.overwrite(rows)
    moved = rows.where(F.col("o_orderkey") % 5 == 0).withColumn("o_orderpriority", F.lit("MOVED"))
    table.merge(moved, ["o_orderkey"], keys_may_move=True)
    return table.read()


_FIRST, _LAST, _MIDDLE = (f"o_orderkey % 5 = {p} AND o_orderkey % 3 = {k}" for p, k in ((0, 0), (4, 1), (2, 2)))


@query(
    "partitioned_schema_change",
    "SELECT o_orderkey, '0' || CAST(o_orderkey % 5 AS VARCHAR) AS part, "
    f"CASE WHEN {_FIRST} THEN CAST(o_orderkey * 7 AS VARCHAR) WHEN {_LAST} THEN '-1' WHEN {_MIDDLE} THEN 'late' END AS extra, "
    f"CASE WHEN {_MIDDLE} THEN CAST(1 AS BIGINT) END AS v FROM orders",
)
def partitioned_schema_change(t: Tables) -> DataFrame:
    """Columns that come, go, come back and change type by merges into the first, the last and a middle partition."""
    folder = shared_dir(t.spark)
    table = PartitionedTable(t.spark, f"{folder}/partitioned_schema_change-{_run()}", ["part"], folder)
    rows = t.orders.select("o_orderkey", F.concat(F.lit("0"), (F.col("o_orderkey") % 5).cast("string")).alias("part"))
    table.overwrite(rows.withColumn("v", F.col("o_orderkey")))
    table.merge(rows.where(_FIRST).withColumns({"v": F.lit(0).cast("long"), "extra": (F.col("o_orderkey") * 7).cast("long")}), ["o_orderkey"])
    table.merge(rows.where(_LAST).withColumn("extra", F.lit(-1).cast("long")), ["o_orderkey"])
    table.merge(rows.where(_MIDDLE).withColumns({"extra": F.lit("late"), "v": F.lit(1).cast("long")}), ["o_orderkey"])
    return table.read()


_CODES = ["01", "1", "1e3", "true", "2024-01-01", " x", "a/b=c", "NULL"]


@query(
    "partitioned_text_values",
    "SELECT o_orderkey, CASE o_orderkey % 9 "
    + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(_CODES))
    + " END AS code, CASE WHEN o_orderkey % 4 = 1 THEN 'new' ELSE 'old' END AS state FROM orders",
)
def partitioned_text_values(t: Tables) -> DataFrame:
    """Texts that look like numbers, dates or paths stay what they are as partition values, merges included."""
    folder = shared_dir(t.spark)
    table = PartitionedTable(t.spark, f"{folder}/partitioned_text_values-{_run()}", ["code"], folder)
    code = F.element_at(F.array(*[F.lit(c) for c in _CODES], F.lit(None)), (F.col("o_orderkey") % 9 + 1).cast("int"))
    rows = t.orders.select("o_orderkey", code.alias("code"))
    table.overwrite(rows.where("o_orderkey % 2 = 0 OR o_orderkey % 4 = 3").withColumn("state", F.lit("old")))
    table.merge(rows.where("o_orderkey % 4 = 1").withColumn("state", F.lit("new")), ["o_orderkey"])
    return table.read()


@query(
    "series_by_day",
    "SELECT user_id, CAST(ts AS DATE) AS event_date, count(*) AS n FROM events GROUP BY 1, 2",
)
def series_by_day(t: Tables) -> DataFrame:
    """A time series stored by day, read back through its partition column."""
    path = f"{shared_dir(t.spark)}/series_by_day-{_run()}"
    partition_for_series(t.events, "user_id", "ts", path)
    stored = t.spark.read.parquet(path)
    return stored.groupBy("user_id", "event_date").agg(F.count(F.lit(1)).alias("n"))


@query(
    "table_from_query",
    "SELECT c_mktsegment, o_orderpriority, count(*) AS orders, CAST(round(sum(CAST(o_totalprice AS DECIMAL(15,2)) ), 2) AS DOUBLE) AS total "
    "FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2",
)
def table_from_query(t: Tables) -> DataFrame:
    """A catalog table made from a join of orders and customers, partitioned, and read back by name."""
    name = f"made_{_run()}"
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    tables.create_table_as(joined.select("o_orderkey", "o_totalprice", "o_orderpriority", "c_mktsegment"), name, partition_by=["c_mktsegment"])
    grouped = t.spark.table(name).groupBy("c_mktsegment", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("orders"), F.sum(F.col("o_totalprice").cast("decimal(15,2)")).cast("double").alias("total")
    )
    stored = cut_lineage(grouped, "table")
    tables.drop_relation(t.spark, name)
    return stored


@query("inserted_rows", "SELECT o_orderkey, o_orderstatus FROM orders")
def inserted_rows(t: Tables) -> DataFrame:
    """All orders appended in two parts by the executors, in files of at most 700 rows."""
    path = f"{shared_dir(t.spark)}/inserted_rows-{_run()}"
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    for rest in (0, 1):
        tables.append_rows(rows.where(F.col("o_orderkey") % 2 == rest), path, chunk_size=700)
    return t.spark.read.schema(rows.schema).parquet(path)


@query("seed_rows", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def seed_rows(t: Tables) -> DataFrame:
    """A table written as CSV and read back as a seed with its types."""
    path = f"{shared_dir(t.spark)}/seed-{_run()}"
    rows = t.customer.select("c_custkey", "c_name", "c_acctbal")
    rows.write.option("header", True).csv(path)
    return tables.read_seed(t.spark, path, rows.schema)


@query("typed_empty_union", "SELECT o_orderkey, o_orderstatus, CAST(NULL AS TIMESTAMP) AS loaded_at FROM orders")
def typed_empty_union(t: Tables) -> DataFrame:
    """An empty table of declared columns gives a union its missing column, typed."""
    kind = t.orders.schema["o_orderkey"].dataType.simpleString()
    empty = incremental.typed_empty(t.spark, [("o_orderkey", kind), ("o_orderstatus", "string"), ("loaded_at", "timestamp_ntz")])
    return empty.unionByName(t.orders.select("o_orderkey", "o_orderstatus"), allowMissingColumns=True)


@query("replaced_rows", "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey % 4 = 1")
def replaced_rows(t: Tables) -> DataFrame:
    """All rows of a stored table replaced, its columns kept."""
    table = SnapshotTable(t.spark, f"{shared_dir(t.spark)}/replaced_rows-{_run()}")
    table.overwrite(_old_customers(t))
    table.replace_rows(t.customer.where(F.col("c_custkey") % 4 == 1))
    return table.read()


@query("full_refresh", "SELECT c_custkey, c_name, c_acctbal, c_custkey % 8 AS part FROM customer WHERE c_custkey % 4 <> 1")
def full_refresh(t: Tables) -> DataFrame:
    """A full refresh forgets what incremental merges have stored."""
    folder = shared_dir(t.spark)
    table = PartitionedTable(t.spark, f"{folder}/full_refresh-{_run()}", ["part"], folder)
    part = (F.col("c_custkey") % 8).alias("part")
    table.merge(t.customer.select("c_custkey", "c_name", "c_acctbal", part), ["c_custkey"])
    table.merge(_old_customers(t).select("*", part), ["c_custkey"], full_refresh=True)
    return table.read()


def _run() -> str:
    return uuid.uuid4().hex
