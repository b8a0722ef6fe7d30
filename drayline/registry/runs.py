"""Run-log views over logs derived from the event table: every event is one node run."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from drayline.operators import incremental, runlog
from drayline.registry.base import Tables, query

_STATUS = {"signup": "success", "view": "success", "click": "success", "purchase": "skipped", "error": "error"}


def _status(column: str = "event_type"):
    status = F.lit(None).cast("string")
    for kind, name in _STATUS.items():
        status = F.when(F.col(column) == kind, name).otherwise(status)
    return status


_STATUS_SQL = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _STATUS.items()) + " END"


def _node_runs(t: Tables) -> DataFrame:
    return t.events.select(
        F.col("event_id").cast("string").alias("model_execution_id"),
        F.concat(F.lit("model."), F.col("user_id") % 40).alias("unique_id"),
        F.concat(F.lit("run-"), F.floor(F.col("event_id") / 7)).alias("invocation_id"),
        F.col("ts").alias("generated_at"),
        _status().alias("status"),
        F.col("value").alias("execution_time"),
        F.when(F.col("event_id") % 2 == 0, "incremental").alias("materialization"),
    )


def _nodes(t: Tables) -> DataFrame:
    """Thirty of the forty nodes are registered."""
    return t.events.where(F.col("user_id") % 40 < 30).select(
        F.concat(F.lit("model."), F.col("user_id") % 40).alias("unique_id"),
        F.concat(F.lit("schema_"), F.col("user_id") % 40 % 4).alias("schema_name"),
        F.lit("table").alias("materialization"),
    ).distinct()


_RUNS_SQL = (
    "runs AS (SELECT event_id, 'model.' || (user_id % 40) AS unique_id, user_id % 40 AS node, 'run-' || (event_id // 7) AS invocation_id, ts AS generated_at, "
    f"{_STATUS_SQL} AS status, value AS execution_time FROM events WHERE user_id % 40 < 30)"
)


_MODEL_RUNS = (
    f"WITH {_RUNS_SQL} SELECT CAST(event_id AS VARCHAR) AS model_execution_id, 'schema_' || (node % 4) AS schema_name, CASE WHEN event_id % 2 = 0 THEN 'incremental' ELSE 'table' END AS materialization, "
    "CAST(row_number() OVER (PARTITION BY unique_id ORDER BY generated_at DESC) AS INT) AS model_invocation_reverse_index, "
    "invocation_id = first_value(invocation_id) OVER w AS is_the_first_invocation_of_the_day, invocation_id = last_value(invocation_id) OVER w AS is_the_last_invocation_of_the_day "
    "FROM runs WINDOW w AS (PARTITION BY date_trunc('day', generated_at) ORDER BY generated_at ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
)
_MODEL_RUN_COLUMNS = [
    "model_execution_id", "schema_name", "materialization", "model_invocation_reverse_index",
    "is_the_first_invocation_of_the_day", "is_the_last_invocation_of_the_day",
]


@query("model_run_results", _MODEL_RUNS)
def model_run_results(t: Tables) -> DataFrame:
    return runlog.model_run_results(_node_runs(t), _nodes(t)).select(*_MODEL_RUN_COLUMNS)


@query("model_run_results_split_keys", _MODEL_RUNS)
def model_run_results_split_keys(t: Tables) -> DataFrame:
    """The same with every model treated as too large for one task."""
    return runlog.model_run_results(_node_runs(t), _nodes(t), rows_per_chunk=100).select(*_MODEL_RUN_COLUMNS)


@query(
    "model_run_results_one_instant",
    f"WITH {_RUNS_SQL} SELECT CAST(event_id AS VARCHAR) AS model_execution_id, "
    "CAST(row_number() OVER (PARTITION BY unique_id ORDER BY CAST(event_id AS VARCHAR) DESC) AS INT) AS model_invocation_reverse_index FROM runs",
)
def model_run_results_one_instant(t: Tables) -> DataFrame:
    """All runs at one instant: what is too large for one task is cut by the run's id."""
    runs = _node_runs(t).withColumn("generated_at", F.lit("2024-01-01").cast("timestamp"))
    found = runlog.model_run_results(runs, _nodes(t), rows_per_chunk=50)
    return found.select("model_execution_id", "model_invocation_reverse_index")


@query(
    "seed_run_results",
    f"WITH {_RUNS_SQL} SELECT CAST(event_id AS VARCHAR) AS model_execution_id, status, 'schema_' || (node % 4) AS schema_name FROM runs",
)
def seed_run_results(t: Tables) -> DataFrame:
    """Runs of nodes that are not registered drop out."""
    return runlog.node_run_results(_node_runs(t), _nodes(t)).select("model_execution_id", "status", "schema_name")


@query(
    "job_run_results",
    "SELECT 'job ' || (user_id % 10) AS name, CAST(user_id % 10 AS VARCHAR) AS id, CAST(date_trunc('hour', ts) AS VARCHAR) AS run_id, min(ts) AS run_started_at, max(ts) AS run_completed_at, "
    "date_sub('second', min(ts), max(ts)) AS run_execution_time FROM events WHERE user_id % 10 > 0 GROUP BY ALL",
)
def job_run_results(t: Tables) -> DataFrame:
    job = F.col("user_id") % 10
    invocations = t.events.select(
        F.when(job > 0, job.cast("string")).alias("job_id"),
        F.concat(F.lit("job "), job).alias("job_name"),
        F.date_trunc("hour", "ts").cast("string").alias("job_run_id"),
        F.col("ts").alias("run_started_at"),
        F.col("ts").alias("run_completed_at"),
    )
    return runlog.job_run_results(invocations)


def _results(t: Tables) -> DataFrame:
    """Test results: three kinds, some passing, warning or failing."""
    third = F.col("event_id") % 3
    return t.events.select(
        F.col("event_id").cast("string").alias("id"),
        F.when(third == 0, "data_test").when(third == 1, "anomaly_detection").otherwise("schema_change").alias("test_type"),
        F.col("event_type").alias("test_sub_type"),
        F.concat(F.lit("saw "), "event_type").alias("test_results_description"),
        F.lit("select 1").alias("test_results_query"),
        F.when(F.col("event_type") == "view", "pass").when(F.col("event_type") == "click", "Warn").otherwise("FAIL").alias("status"),
    )


@query(
    "alerts_data_tests",
    "SELECT CAST(event_id AS VARCHAR) AS alert_id, event_type AS sub_type, 'saw ' || event_type AS alert_description FROM events WHERE event_id % 3 = 0 AND event_type <> 'view'",
)
def alerts_data_tests(t: Tables) -> DataFrame:
    return runlog.result_alerts(_results(t), "data_test").select("alert_id", "sub_type", "alert_description")


@query(
    "alerts_anomalies",
    "SELECT CAST(event_id AS VARCHAR) AS alert_id FROM events WHERE event_id % 3 = 1 AND event_type NOT IN ('view', 'click')",
)
def alerts_anomalies(t: Tables) -> DataFrame:
    """Warnings are left out on demand."""
    return runlog.result_alerts(_results(t), "anomaly_detection", skip_warnings=True).select("alert_id")


@query(
    "alerts_schema_changes",
    "SELECT CAST(event_id AS VARCHAR) AS alert_id, 'schema_change' AS alert_type FROM events WHERE event_id % 3 = 2 AND event_type <> 'view'",
)
def alerts_schema_changes(t: Tables) -> DataFrame:
    return runlog.result_alerts(_results(t), "schema_change").select("alert_id", "alert_type")


@query(
    "alerts_models",
    f"WITH {_RUNS_SQL} SELECT CAST(event_id AS VARCHAR) AS alert_id, generated_at AS detected_at, status FROM runs WHERE status NOT IN ('success', 'skipped') "
    "UNION ALL SELECT 's' || event_id, generated_at, status FROM runs WHERE status NOT IN ('success', 'skipped') AND event_id % 5 = 0",
)
def alerts_models(t: Tables) -> DataFrame:
    """Failed model and snapshot runs."""
    models = runlog.model_run_results(_node_runs(t), _nodes(t))
    snapshots = runlog.node_run_results(_node_runs(t).where(F.col("model_execution_id") % 5 == 0), _nodes(t))
    snapshots = snapshots.withColumn("model_execution_id", F.concat(F.lit("s"), "model_execution_id"))
    found = runlog.model_alerts(models, snapshots, skip_skipped=True)
    return found.select("alert_id", F.col("detected_at").cast("timestamp_ntz").alias("detected_at"), "status")


@query(
    "alerts_source_freshness",
    "SELECT user_id AS alert_id, 'source.' || user_id AS unique_id, max(ts) AS max_loaded_at, 'schema_' || (user_id % 4) AS schema_name FROM events WHERE user_id % 40 < 30 "
    "GROUP BY user_id HAVING max(ts) < TIMESTAMP '2024-01-30 12:00:00'",
)
def alerts_source_freshness(t: Tables) -> DataFrame:
    """Each user's events as one source; those not loaded for half a day are late."""
    newest = t.events.groupBy("user_id").agg(F.max("ts").alias("max_loaded_at"))
    late = F.col("max_loaded_at") < F.lit("2024-01-30 12:00:00").cast("timestamp_ntz")
    results = newest.select(
        F.col("user_id").alias("source_freshness_execution_id"),
        F.concat(F.lit("source."), "user_id").alias("unique_id"),
        "max_loaded_at",
        F.col("max_loaded_at").alias("generated_at"),
        F.when(late, "error").otherwise("pass").alias("status"),
    )
    sources = t.events.where(F.col("user_id") % 40 < 30).select(
        F.concat(F.lit("source."), "user_id").alias("unique_id"), F.concat(F.lit("schema_"), F.col("user_id") % 4).alias("schema_name")
    ).distinct()
    found = runlog.source_freshness_alerts(results, sources)
    return found.select("alert_id", "unique_id", "max_loaded_at", "schema_name")


@query(
    "sampled_result_rows",
    "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity > 49 ORDER BY "
    "'{\"l_orderkey\":' || l_orderkey || ',\"l_linenumber\":' || l_linenumber || '}' LIMIT 5",
)
def sampled_result_rows(t: Tables) -> DataFrame:
    """Five of the violating rows, as JSON."""
    bad = t.lineitem.where(F.col("l_quantity") > 49).select("l_orderkey", "l_linenumber")
    rows = runlog.sampled_result_rows(bad, "r1")
    return rows.select(*[F.get_json_object("result_row", f"$.{c}").cast("bigint").alias(c) for c in bad.columns])


@query(
    "artifact_hashes",
    "SELECT 'models' AS artifacts_model, md5('{\"r_regionkey\":' || r_regionkey || ',\"r_name\":\"' || r_name || '\"}') AS metadata_hash FROM region UNION ALL "
    "SELECT 'tests', md5('{\"n_nationkey\":' || n_nationkey || '}') FROM nation",
)
def artifact_hashes(t: Tables) -> DataFrame:
    models = t.region.withColumn("metadata_hash", incremental.row_hash(["r_regionkey", "r_name"]))
    tests = t.nation.withColumn("metadata_hash", incremental.row_hash(["n_nationkey"]))
    return runlog.artifact_hashes({"models": models, "tests": tests})


@query(
    "run_log_merge",
    f"SELECT CAST(event_id AS VARCHAR) AS model_execution_id, CASE WHEN event_id % 4 = 0 THEN 'rerun' ELSE {_STATUS_SQL} END AS status, CASE WHEN event_id % 4 = 0 THEN user_id END AS rows_affected FROM events",
)
def run_log_merge(t: Tables) -> DataFrame:
    """Repeated runs replace their entry and bring a new column."""
    stored = _node_runs(t).select("model_execution_id", "status")
    again = t.events.where(F.col("event_id") % 4 == 0).select(
        F.col("event_id").cast("string").alias("model_execution_id"), F.lit("rerun").alias("status"), F.col("user_id").alias("rows_affected")
    )
    return runlog.merge_run_log(stored, again, "model_execution_id")


@query(
    "latest_full_refresh",
    "SELECT max(ts) AS generated_at FROM events WHERE user_id % 40 = 7 AND event_type = 'signup'",
)
def latest_full_refresh(t: Tables) -> DataFrame:
    """Every signup counts as a rebuild of its node."""
    runs = t.events.select(
        F.concat(F.lit("model."), F.col("user_id") % 40).alias("unique_id"),
        F.col("ts").alias("generated_at"),
        (F.col("event_type") == "signup").alias("full_refresh"),
    )
    return runlog.latest_full_refresh(runs, "model.7")
