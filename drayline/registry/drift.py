"""Schema snapshots and changes, with the number of rows each column is found in.

The states compared are those of given tables; each query also reads the
table, so that a column counts only as far as it holds data.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from drayline.operators import schema_drift
from drayline.registry.base import Tables, query
from drayline.schemas import ddl

AS_OF = datetime(2024, 2, 1)
BEFORE = datetime(2024, 1, 1)
TABLE = "shop.public.customer"


def _changed(t: Tables) -> DataFrame:
    """The customer table after a migration: retyped key, renamed column, one gone, one new."""
    return t.customer.select(
        F.col("c_custkey").cast("string").alias("C_CUSTKEY"), "c_name", "c_nationkey",
        F.col("c_acctbal").alias("balance"), F.length("c_mktsegment").alias("segment_length"),
    )


def _filled(df: DataFrame) -> DataFrame:
    """Non-null rows per column, in one pass."""
    counts = df.agg(*[F.count(F.col(c)).alias(c.lower()) for c in df.columns])
    return counts.unpivot([], [c.lower() for c in df.columns], "column_name", "n_filled")


@query(
    "schema_snapshot",
    " UNION ALL ".join(
        f"SELECT upper('{TABLE}.{c}') AS full_column_name, '{k}' AS data_type, md5('{TABLE}-{c}-{k}') AS column_state_id, false AS is_new, count({c}) AS n_filled FROM customer"
        for c, k in (("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"), ("c_mktsegment", "string"))
    ),
)
def schema_snapshot(t: Tables) -> DataFrame:
    found = schema_drift.columns_snapshot(t.spark, TABLE, t.customer.schema, None, AS_OF)
    return found.join(_filled(t.customer), "column_name").select(
        "full_column_name", "data_type", "column_state_id", "is_new", "n_filled"
    )


@query(
    "schema_changes",
    "SELECT 'type_changed' AS change, 'c_custkey' AS column_name, 'bigint' AS pre_data_type, 'string' AS data_type, count(c_custkey) AS n_filled FROM customer UNION ALL "
    "SELECT 'column_removed', 'c_acctbal', 'double', NULL, NULL UNION ALL SELECT 'column_removed', 'c_mktsegment', 'string', NULL, NULL UNION ALL "
    "SELECT 'column_added', 'balance', NULL, 'double', count(c_acctbal) FROM customer UNION ALL "
    "SELECT 'column_added', 'segment_length', NULL, 'int', count(c_mktsegment) FROM customer",
)
def schema_changes(t: Tables) -> DataFrame:
    """Names are compared without case."""
    store = schema_drift.columns_snapshot(t.spark, TABLE, t.customer.schema, None, BEFORE)
    now = _changed(t)
    current = schema_drift.columns_snapshot(t.spark, TABLE, now.schema, store, AS_OF)
    found = schema_drift.schema_changes(current, store, TABLE)
    named = found.withColumn("column_name", F.lower("column_name"))
    return named.join(_filled(now), "column_name", "left").select("change", "column_name", "pre_data_type", "data_type", "n_filled")


@query(
    "schema_changes_from_baseline",
    "SELECT 'type_changed' AS change, 'c_nationkey' AS column_name, 'The type of \"c_nationkey\" was changed from bigint to int' AS description, count(c_nationkey) AS n_filled FROM customer UNION ALL "
    "SELECT 'column_removed', 'c_phone', 'The column \"c_phone\" was removed', NULL UNION ALL "
    "SELECT 'column_added', 'c_mktsegment', 'The column \"c_mktsegment\" was added', count(c_mktsegment) FROM customer",
)
def schema_changes_from_baseline(t: Tables) -> DataFrame:
    baseline = [("C_CUSTKEY", "bigint"), ("c_name", None), ("c_nationkey", "bigint"), ("c_acctbal", "double"), ("c_phone", "string")]
    changes = schema_drift.baseline_changes(t.spark, TABLE, t.customer.schema, baseline, AS_OF, fail_on_added=True)
    found = schema_drift.change_results(changes, AS_OF)
    return found.join(_filled(t.customer), "column_name", "left").select(
        F.col("test_sub_type").alias("change"), "column_name", F.col("test_results_description").alias("description"), "n_filled"
    )


@query(
    "consumer_contracts",
    "SELECT 'board' AS consumer, 'c_phone column missing in the model' AS error, (SELECT count(*) FROM customer) AS n_rows UNION ALL "
    "SELECT 'report', 'different data type for the column c_nationkey string vs int', (SELECT count(*) FROM customer)",
)
def consumer_contracts(t: Tables) -> DataFrame:
    contracts = t.spark.createDataFrame(
        [
            ("board", "http://board", TABLE, "C_NAME", "string"),
            ("board", "http://board", TABLE, "c_phone", None),
            ("report", "http://report", TABLE, "c_nationkey", "string"),
            ("report", "http://report", TABLE, "c_acctbal", ""),
        ],
        ddl("consumer string, url string, full_table_name string, column_name string, data_type string"),
    )
    found = schema_drift.contract_violations(contracts, schema_drift.schema_rows(t.spark, TABLE, t.customer.schema))
    size = t.customer.count()
    return found.select("consumer", "error", F.lit(size).cast("bigint").alias("n_rows"))
