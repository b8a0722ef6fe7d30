"""Schema snapshots, changes between them, baselines and consumer contracts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from drayline.functions import as_of_timestamp, metric_id, moment
from drayline.operators.latest import latest_per_key
from drayline.schemas import ddl

_CHANGE_COLUMNS = ["full_table_name", "change", "column_name", "data_type", "pre_data_type", "detected_at"]


def schema_rows(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    """One row per column of a schema."""
    rows = [(table, f.name, f.dataType.simpleString()) for f in schema.fields]
    return spark.createDataFrame(rows, ddl("full_table_name string, column_name string, data_type string"))


def _last_snapshot(store: DataFrame, table: str) -> DataFrame:
    """The newest stored state of a table.

    A join on the newest time; the time is one row.
    """
    own = store.where(F.lower("full_table_name") == table.lower())
    newest = own.agg(F.max("detected_at").alias("detected_at"))
    return own.join(F.broadcast(newest), "detected_at", "left_semi").select(*store.columns)


def columns_snapshot(
    spark: SparkSession, table: str, schema: T.StructType, store: DataFrame | None, as_of: datetime | Column
) -> DataFrame:
    """Present column states of a table; ``is_new`` marks columns the last snapshot lacks."""
    full_column = F.upper(F.concat_ws(".", "full_table_name", "column_name"))
    current = schema_rows(spark, table, schema).withColumn("full_column_name", full_column)
    if store is None:
        flagged = current.withColumn("is_new", F.lit(False))
    else:
        known = _last_snapshot(store, table)
        columns = known.select("full_column_name", F.lit(True).alias("_known_column")).distinct()
        tables = known.select("full_table_name", F.lit(True).alias("_known_table")).distinct()
        flagged = (
            current.join(columns, "full_column_name", "left")
            .join(tables, "full_table_name", "left")
            .withColumn("is_new", F.col("_known_table").isNotNull() & F.col("_known_column").isNull())
        )
    return flagged.select(
        metric_id(["full_table_name", "column_name", "data_type"]).alias("column_state_id"),
        "full_column_name",
        "full_table_name",
        "column_name",
        "data_type",
        "is_new",
        as_of_timestamp(as_of).alias("detected_at"),
    )


def append_snapshot(store: DataFrame | None, snapshot: DataFrame) -> DataFrame:
    """Snapshot store after a run; a column state found several times in the run counts once."""
    latest = latest_per_key(snapshot, ["column_state_id"], ["detected_at"])
    return latest if store is None else store.unionByName(latest)


def _changes(current: DataFrame, previous: DataFrame, include_added: bool) -> DataFrame:
    """Type changes, removals and additions; a table that is gone altogether reports nothing."""
    keyed_now = current.withColumn("_t", F.lower("full_table_name")).withColumn("_c", F.lower("column_name"))
    keyed_then = previous.withColumn("_t", F.lower("full_table_name")).withColumn("_c", F.lower("column_name"))
    now, then = keyed_now.alias("now"), keyed_then.alias("then")
    same = (F.col("now._t") == F.col("then._t")) & (F.col("now._c") == F.col("then._c"))
    retyped = (
        now.join(then, same)
        .where(F.lower("now.data_type") != F.lower("then.data_type"))
        .select(
            "now.full_table_name", F.lit("type_changed").alias("change"), "now.column_name",
            "now.data_type", F.col("then.data_type").alias("pre_data_type"), "then.detected_at",
        )
    )
    removed = (
        keyed_then.join(keyed_now.select("_t", "_c"), ["_t", "_c"], "left_anti")
        .join(keyed_now.select("_t"), "_t", "left_semi")
        .select(
            "full_table_name", F.lit("column_removed").alias("change"), "column_name",
            F.lit(None).cast("string").alias("data_type"), F.col("data_type").alias("pre_data_type"), "detected_at",
        )
    )
    result = retyped.unionByName(removed)
    if include_added:
        added = current.where("is_new").select(
            "full_table_name", F.lit("column_added").alias("change"), "column_name", "data_type",
            F.lit(None).cast("string").alias("pre_data_type"), "detected_at",
        )
        result = result.unionByName(added)
    return result.select(*_CHANGE_COLUMNS)


def schema_changes(current: DataFrame, store: DataFrame, table: str, include_added: bool = True) -> DataFrame:
    """Changes of a snapshot against the last stored one."""
    return _changes(current, _last_snapshot(store, table), include_added)


def baseline_changes(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    baseline: list[tuple[str, str | None]],
    as_of: datetime,
    fail_on_added: bool = False,
    enforce_types: bool = False,
) -> DataFrame:
    """Changes against a declared list of (column, type).

    With ``enforce_types`` every declared column needs a type; additions count
    only with ``fail_on_added``.
    """
    if not baseline:
        raise ValueError("the baseline is empty")
    untyped = [name for name, kind in baseline if not kind]
    if enforce_types and untyped:
        raise ValueError(f"columns without a declared type: {untyped}")
    declared = spark.createDataFrame(
        [(table, name.lower(), kind) for name, kind in baseline],
        ddl("full_table_name string, column_name string, data_type string"),
    ).withColumn("detected_at", as_of_timestamp(as_of))
    present = schema_rows(spark, table, schema).withColumn("column_name", F.lower("column_name"))
    known = declared.select("column_name", F.lit(True).alias("_declared"))
    current = (
        present.join(known, "column_name", "left")
        .withColumn("is_new", F.col("_declared").isNull())
        .withColumn("detected_at", as_of_timestamp(as_of))
    )
    return _changes(current, declared, include_added=fail_on_added)


def change_results(changes: DataFrame, as_of: datetime, execution_id: str = "", test_id: str = "") -> DataFrame:
    """Result rows with a description per change; the sentences are fixed values."""
    name = F.col("column_name")
    text = (
        F.when(F.col("change") == "column_added", F.concat(F.lit('The column "'), name, F.lit('" was added')))
        .when(F.col("change") == "column_removed", F.concat(F.lit('The column "'), name, F.lit('" was removed')))
        .otherwise(
            F.concat(
                F.lit('The type of "'), name, F.lit('" was changed from '), F.col("pre_data_type"),
                F.lit(" to "), F.col("data_type"),
            )
        )
    )
    issue = metric_id(["full_table_name", "column_name", "change", "detected_at"])
    table = F.upper("full_table_name")
    part = lambda i: F.try_element_at(F.split(table, r"\."), F.lit(i))
    described = changes.distinct().select(
        issue.alias("data_issue_id"),
        part(-3).alias("database_name"),
        part(-2).alias("schema_name"),
        part(-1).alias("table_name"),
        "column_name",
        F.lit("schema_change").alias("test_type"),
        F.col("change").alias("test_sub_type"),
        text.alias("test_results_description"),
    )
    return described.select(
        metric_id(["data_issue_id", F.lit(execution_id)]).alias("id"),
        F.lit(execution_id).alias("test_execution_id"),
        F.lit(test_id).alias("test_unique_id"),
        "data_issue_id",
        moment(as_of).alias("detected_at"),
        "database_name", "schema_name", "table_name", "column_name",
        "test_type", "test_sub_type", "test_results_description",
    )


def contract_violations(contracts: DataFrame, columns: DataFrame) -> DataFrame:
    """Columns that consumers rely on but that are missing or of another type.

    ``contracts``: ``consumer, url, full_table_name, column_name, data_type``
    (type optional). ``columns``: as from :func:`schema_rows`.
    """
    have = columns.select(
        F.upper("full_table_name").alias("_t"), F.upper("column_name").alias("_c"),
        F.lower("data_type").alias("_type"),
    )
    wanted = contracts.withColumn("_t", F.upper("full_table_name")).withColumn("_c", F.upper("column_name"))
    joined = wanted.join(have, ["_t", "_c"], "left")
    declared = F.nullif(F.col("data_type"), F.lit(""))
    error = F.when(
        F.col("_type").isNull(), F.concat(F.col("column_name"), F.lit(" column missing in the model"))
    ).when(
        F.lower(declared) != F.col("_type"),
        F.concat(F.lit("different data type for the column "), F.col("column_name"), F.lit(" "), declared, F.lit(" vs "), F.col("_type")),
    )
    return joined.select("consumer", "url", error.alias("error")).where(F.col("error").isNotNull())


