"""Views over run logs: node runs, jobs, alerts, test results."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from drayline.functions import as_of_timestamp
from drayline.operators.chunking import ROWS_PER_CHUNK, number_rows
from drayline.operators.incremental import merge_upsert



def _with_node(runs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Runs joined to their nodes; the materialization of the run wins over the declared one."""
    extra = [c for c in nodes.columns if c not in ("unique_id", *runs.columns)]
    joined = runs.alias("r").join(nodes.alias("n"), F.col("r.unique_id") == F.col("n.unique_id"))
    columns = [F.col(f"r.{c}") for c in runs.columns if c != "materialization"]
    if "materialization" in runs.columns and "materialization" in nodes.columns:
        columns.append(F.coalesce("r.materialization", "n.materialization").alias("materialization"))
    elif "materialization" in runs.columns:
        columns.append(F.col("r.materialization"))
    return joined.select(*columns, *[F.col(f"n.{c}") for c in extra])


def model_run_results(runs: DataFrame, models: DataFrame, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Model runs, numbered from the newest, flagged in the first and last invocation of their day.

    The first and last invocation of a day come from a grouped aggregate, which
    combines on the map side, and are joined back; a window per day would sort
    a whole day's runs in one task.
    """
    joined = _with_node(runs, models)
    at = F.struct("generated_at", "model_execution_id", "invocation_id")
    day = F.date_trunc("day", "generated_at")
    days = joined.groupBy(day.alias("_day")).agg(F.min(at).alias("_first"), F.max(at).alias("_last"))
    numbered = number_rows(
        joined, ["unique_id"], "generated_at", ["model_execution_id"], "model_invocation_reverse_index",
        rows_per_chunk=rows_per_chunk,
    )
    return (
        numbered.withColumn("_day", day)
        .join(days, "_day", "left")
        .withColumn("is_the_first_invocation_of_the_day", F.col("invocation_id").eqNullSafe(F.col("_first.invocation_id")))
        .withColumn("is_the_last_invocation_of_the_day", F.col("invocation_id").eqNullSafe(F.col("_last.invocation_id")))
        .drop("_day", "_first", "_last")
    )


def node_run_results(runs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Seed or snapshot runs with their node's attributes."""
    return _with_node(runs, nodes)


def job_run_results(invocations: DataFrame) -> DataFrame:
    """Start, end and duration in seconds per job run."""
    grouped = (
        invocations.where(F.col("job_id").isNotNull())
        .groupBy("job_name", "job_id", "job_run_id")
        .agg(F.min("run_started_at").alias("run_started_at"), F.max("run_completed_at").alias("run_completed_at"))
    )
    return grouped.select(
        F.col("job_name").alias("name"),
        F.col("job_id").alias("id"),
        F.col("job_run_id").alias("run_id"),
        "run_started_at",
        "run_completed_at",
        F.timestamp_diff("SECOND", F.col("run_started_at"), F.col("run_completed_at")).alias("run_execution_time"),
    )


def latest_full_refresh(runs: DataFrame, unique_id: str) -> DataFrame:
    """When a node was last rebuilt from scratch: at most one row, ``generated_at``."""
    rebuilt = runs.where((F.col("unique_id") == unique_id) & F.col("full_refresh"))
    return rebuilt.select("generated_at").orderBy(F.col("generated_at").desc()).limit(1)


def _failing(df: DataFrame, passing: str, disabled: bool, skip_warnings: bool, skip_skipped: bool) -> DataFrame:
    status = F.lower("status")
    keep = status != passing
    if skip_warnings:
        keep = keep & (status != "warn")
    if skip_skipped:
        keep = keep & (status != "skipped")
    return df.where(F.lit(False)) if disabled else df.where(keep)


def result_alerts(
    results: DataFrame, kind: str, disabled: bool = False, skip_warnings: bool = False, skip_skipped: bool = False
) -> DataFrame:
    """Failing results of one kind: ``data_test``, ``anomaly_detection`` or ``schema_change``."""
    chosen = results.where(F.col("test_type") == kind)
    renamed = _failing(chosen, "pass", disabled, skip_warnings, skip_skipped).withColumnsRenamed(
        {
            "id": "alert_id", "test_type": "alert_type", "test_sub_type": "sub_type",
            "test_results_description": "alert_description", "test_results_query": "alert_results_query",
        }
    )
    return renamed




def model_alerts(
    model_runs: DataFrame, snapshot_runs: DataFrame, disabled: bool = False, skip_skipped: bool = False
) -> DataFrame:
    """Model and snapshot runs that did not succeed."""
    both = model_runs.unionByName(snapshot_runs, allowMissingColumns=True)
    kept = [
        c for c in (
            "unique_id", "database_name", "materialization", "path", "original_path", "schema_name", "message",
            "owner", "tags", "alias", "status", "full_refresh",
        ) if c in both.columns
    ]
    return _failing(both, "success", disabled, False, skip_skipped).select(
        F.col("model_execution_id").alias("alert_id"), F.col("generated_at").cast("timestamp").alias("detected_at"), *kept
    )


def source_freshness_alerts(
    results: DataFrame, sources: DataFrame, disabled: bool = False, skip_warnings: bool = False
) -> DataFrame:
    """Sources that were not fresh, with the source's attributes."""
    extra = [c for c in sources.columns if c not in results.columns]
    joined = results.join(sources.select("unique_id", *extra), "unique_id")
    renamed = joined.withColumnsRenamed({"source_freshness_execution_id": "alert_id", "generated_at": "detected_at"})
    return _failing(renamed, "pass", disabled, skip_warnings, False)


def sampled_result_rows(violations: DataFrame, result_id: str, as_of: datetime | None = None, sample: int = 5) -> DataFrame:
    """The first violating rows as JSON, in the order of their JSON text: the same in every run."""
    moment = as_of_timestamp(as_of)
    text = F.to_json(F.struct(*violations.columns), {"ignoreNullFields": "false"}).alias("result_row")
    return violations.select(text).orderBy("result_row").limit(sample).select(
        F.lit(result_id).alias("test_result_id"),
        "result_row",
        moment.alias("detected_at"),
        moment.alias("created_at"),
    )




def artifact_hashes(artifacts: dict[str, DataFrame]) -> DataFrame:
    """Hash of every stored artifact with the table that holds it."""
    result = None
    for name, df in artifacts.items():
        part = df.select(F.lit(name).alias("artifacts_model"), "metadata_hash")
        result = part if result is None else result.unionByName(part)
    return result


def merge_run_log(store: DataFrame | None, rows: DataFrame, key: str) -> DataFrame:
    """Run log after new rows: upsert by execution id, new columns appended."""
    return rows if store is None else merge_upsert(store, rows, [key], "append_new_columns")
