from datetime import datetime

import pytest
from pyspark.sql import functions as F

from drayline.operators import incremental, runlog, schema_drift
from drayline.schemas import ddl

BEFORE, NOW = datetime(2024, 1, 1), datetime(2024, 2, 1)
OLD = ddl("id int, name string, nick string")
NEW = ddl("ID string, first_name string, age int, nick string")


def test_changes_between_snapshots(spark, rows):
    store = schema_drift.columns_snapshot(spark, "db.s.t", OLD, None, BEFORE)
    assert store.where("is_new").isEmpty()
    current = schema_drift.columns_snapshot(spark, "db.s.t", NEW, store, NOW)
    changes = schema_drift.schema_changes(current, store, "DB.S.T")
    assert rows(changes, "change", "column_name") == [
        ("column_added", "age"), ("column_added", "first_name"), ("column_removed", "name"), ("type_changed", "ID"),
    ]
    results = {r["column_name"]: r for r in schema_drift.change_results(changes, NOW).collect()}
    assert results["ID"]["test_results_description"] == 'The type of "ID" was changed from int to string'
    assert results["age"]["test_results_description"] == 'The column "age" was added'
    assert results["name"]["database_name"] == "DB" and results["name"]["table_name"] == "T"
    assert schema_drift.schema_changes(current, store.unionByName(current), "db.s.t").where("change <> 'column_added'").isEmpty()


def test_a_table_that_is_gone_reports_nothing(spark):
    store = schema_drift.columns_snapshot(spark, "db.s.t", OLD, None, BEFORE)
    assert schema_drift.schema_changes(store.limit(0), store, "db.s.t").isEmpty()


def test_baseline(spark, rows):
    baseline = [("ID", "string"), ("name", "string"), ("Nick", None)]

    def changes(**options):
        return rows(schema_drift.baseline_changes(spark, "t", OLD, baseline, NOW, **options), "change", "column_name")

    assert changes() == [("type_changed", "id")]
    wider = ddl("id string, name string, nick string, extra int")
    added = schema_drift.baseline_changes(spark, "t", wider, baseline, NOW, fail_on_added=True)
    assert rows(added, "change", "column_name") == [("column_added", "extra")]
    with pytest.raises(ValueError):
        changes(enforce_types=True)
    with pytest.raises(ValueError):
        schema_drift.baseline_changes(spark, "t", OLD, [], NOW)


def test_contracts(spark, rows):
    contracts = spark.createDataFrame(
        [("x", "u", "t", "ID", "int"), ("x", "u", "t", "name", "int"), ("y", "u", "T", "gone", None), ("y", "u", "t", "nick", None)],
        "consumer string, url string, full_table_name string, column_name string, data_type string",
    )
    found = schema_drift.contract_violations(contracts, schema_drift.schema_rows(spark, "t", OLD))
    assert rows(found, "consumer", "error") == [
        ("x", "different data type for the column name int vs string"), ("y", "gone column missing in the model"),
    ]


@pytest.fixture
def runs(spark):
    data = [
        ("e1", "m.a", "i1", datetime(2024, 1, 1, 8), "success", None),
        ("e2", "m.b", "i1", datetime(2024, 1, 1, 9), "error", "table"),
        ("e3", "m.a", "i2", datetime(2024, 1, 1, 20), "skipped", None),
        ("e4", "m.a", "i3", datetime(2024, 1, 2, 8), "Success", None),
        ("e5", "m.zzz", "i3", datetime(2024, 1, 2, 9), "error", None),
    ]
    return spark.createDataFrame(
        data, "model_execution_id string, unique_id string, invocation_id string, generated_at timestamp, status string, materialization string"
    )


@pytest.fixture
def models(spark):
    return spark.createDataFrame(
        [("m.a", "s1", "view"), ("m.b", "s2", "view")], "unique_id string, schema_name string, materialization string"
    )


def test_model_runs(runs, models):
    got = {r["model_execution_id"]: r for r in runlog.model_run_results(runs, models).collect()}
    assert set(got) == {"e1", "e2", "e3", "e4"}  # no registered node, no row
    assert [got[e]["model_invocation_reverse_index"] for e in ("e1", "e3", "e4")] == [3, 2, 1]
    assert (got["e2"]["materialization"], got["e1"]["materialization"]) == ("table", "view")
    first = {e for e, r in got.items() if r["is_the_first_invocation_of_the_day"]}
    last = {e for e, r in got.items() if r["is_the_last_invocation_of_the_day"]}
    assert first == {"e1", "e2", "e4"} and last == {"e3", "e4"}


def test_model_alerts(runs, models, rows):
    model_runs = runlog.model_run_results(runs, models)
    snapshots = runlog.node_run_results(runs, models).limit(0)
    assert rows(runlog.model_alerts(model_runs, snapshots), "alert_id") == [("e2",), ("e3",)]
    assert rows(runlog.model_alerts(model_runs, snapshots, skip_skipped=True), "alert_id") == [("e2",)]
    assert runlog.model_alerts(model_runs, snapshots, disabled=True).isEmpty()


def test_run_log(spark, rows):
    stored = spark.createDataFrame([("a", "error"), ("b", "success")], "id string, status string")
    again = spark.createDataFrame([("a", "success", 5)], "id string, status string, rows int")
    assert rows(runlog.merge_run_log(stored, again, "id")) == [("a", "success", 5), ("b", "success", None)]
    assert runlog.merge_run_log(None, again, "id") is again


def test_sampled_rows(spark):
    bad = spark.createDataFrame([(i, None) for i in range(20)], "x int, y string")
    found = runlog.sampled_result_rows(bad, "r", NOW)
    assert found.count() == 5 and found.first()["result_row"].endswith('"y":null}') and found.first()["detected_at"] == NOW


def test_row_hash_depends_on_every_column(spark):
    df = spark.createDataFrame([(1, None), (1, "x"), (None, "x")], "a int, b string")
    hashes = [r[0] for r in df.select(incremental.row_hash(["a", "b"])).collect()]
    assert len(set(hashes)) == 3


def test_hash_diff_of_equal_tables_is_empty(spark):
    df = spark.createDataFrame([(1,), (2,)], "a int").withColumn("metadata_hash", incremental.row_hash(["a"]))
    assert incremental.diff_by_hash(df, df).isEmpty()
    assert incremental.diff_by_hash(df, df.where("a = 1")).select("action").first()[0] == "remove"


def test_jobs(spark):
    df = spark.createDataFrame(
        [("j", "1", "r", datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 1)), ("j", "1", "r", datetime(2024, 1, 1, 0, 0, 30), datetime(2024, 1, 1, 0, 2)), ("j", None, "r", None, None)],
        "job_name string, job_id string, job_run_id string, run_started_at timestamp, run_completed_at timestamp",
    )
    assert [r["run_execution_time"] for r in runlog.job_run_results(df).collect()] == [120]


def test_freshness_alerts(spark, rows):
    results = spark.createDataFrame(
        [("f1", "s.a", "pass"), ("f2", "s.b", "warn"), ("f3", "s.b", "error")], "source_freshness_execution_id string, unique_id string, status string"
    ).withColumn("generated_at", F.lit("2024-01-01").cast("timestamp"))
    sources = spark.createDataFrame([("s.a", "x"), ("s.b", "y")], "unique_id string, schema_name string")
    assert rows(runlog.source_freshness_alerts(results, sources), "alert_id") == [("f2",), ("f3",)]
    assert rows(runlog.source_freshness_alerts(results, sources, skip_warnings=True), "alert_id") == [("f3",)]


def test_latest_full_refresh(spark):
    df = spark.createDataFrame(
        [("m", datetime(2024, 1, 1), True), ("m", datetime(2024, 1, 5), True), ("m", datetime(2024, 1, 9), False), ("x", datetime(2024, 2, 1), True)],
        "unique_id string, generated_at timestamp, full_refresh boolean",
    )
    assert runlog.latest_full_refresh(df, "m").first()[0] == datetime(2024, 1, 5)
    assert runlog.latest_full_refresh(df, "none").isEmpty()


def test_snapshot_store(spark):
    first = schema_drift.columns_snapshot(spark, "t", OLD, None, BEFORE)
    store = schema_drift.append_snapshot(None, first.unionByName(first))
    assert store.count() == 3
    again = schema_drift.columns_snapshot(spark, "t", OLD, store, NOW)
    store = schema_drift.append_snapshot(store, again)
    assert store.count() == 6 and schema_drift.schema_changes(again, store, "t").isEmpty()
