"""Metrics and anomalies on generated series with a fixed clock."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from drayline.functions import Period
from drayline.operators import anomaly, monitors
from drayline.operators.monitors import MonitorConfig

AS_OF = datetime(2024, 2, 1)
CONFIG = MonitorConfig(as_of=AS_OF, timestamp_column="updated_at")


def days_back(days=31, step=timedelta(days=1), end=AS_OF):
    first, moments, current = end - timedelta(days=days), [], end - step
    while current >= first:
        moments.append(current)
        current -= step
    return moments


def frame(spark, moments, per_day=1, **columns):
    names = list(columns)
    schema = "updated_at timestamp" + "".join(f", {n} {columns[n][1]}" for n in names)
    data = [(m, *[columns[n][0](m, i) for n in names]) for m in moments for i in range(per_day)]
    return spark.createDataFrame(data, schema)


def failed(results):
    return not anomaly.anomalies(results).isEmpty()


def test_steady_volume_passes(spark):
    df = frame(spark, days_back())
    results = anomaly.volume_anomalies(df, "t", CONFIG)
    assert results.count() == 14 and not failed(results)


def test_missing_days_fail(spark):
    df = frame(spark, [m for m in days_back() if m < AS_OF - timedelta(days=1)], per_day=3)
    results = anomaly.volume_anomalies(df, "t", CONFIG)
    assert failed(results)
    assert not failed(anomaly.volume_anomalies(df, "t", monitors.with_overrides(CONFIG, direction="spike")))
    assert failed(anomaly.volume_anomalies(df, "t", monitors.with_overrides(CONFIG, direction="drop")))
    # a detection delay moves the end back to where data is complete
    assert not failed(anomaly.volume_anomalies(df, "t", monitors.with_overrides(CONFIG, detection_delay=Period("day", 1))))


def test_fail_on_zero(spark):
    df = frame(spark, [m for m in days_back() if m.day % 2 == 0])
    assert not failed(anomaly.volume_anomalies(df, "t", CONFIG))
    assert failed(anomaly.volume_anomalies(df, "t", monitors.with_overrides(CONFIG, fail_on_zero=True)))


def test_only_the_backfill_range_can_fail(spark):
    spike = AS_OF - timedelta(days=5)
    df = frame(spark, days_back()).unionByName(frame(spark, [spike] * 50))
    assert not failed(anomaly.volume_anomalies(df, "t", CONFIG))
    assert failed(anomaly.volume_anomalies(df, "t", monitors.with_overrides(CONFIG, backfill_days=7, sensitivity=2)))


def test_null_values_of_a_column(spark):
    good = frame(spark, days_back(), 2, hero=(lambda m, i: ["Superman", "Batman"][i], "string"))
    assert not failed(anomaly.column_anomalies(good, "t", CONFIG, "hero"))
    bad = good.unionByName(frame(spark, [AS_OF - timedelta(hours=20)] * 3, 1, hero=(lambda m, i: None, "string")))
    results = anomaly.column_anomalies(bad, "t", CONFIG, "hero", ["null_count"])
    assert failed(results)
    summary = anomaly.anomaly_test_results(results).first()
    assert summary["status"] == "fail" and summary["failures"] == 1 and summary["column_name"] == "hero"
    assert summary["test_results_description"].startswith("In column hero, the last null_count value is 3.000")


def test_anomalous_exactly_when_outside_the_range(spark):
    df = frame(spark, days_back(), 1, metric=(lambda m, i: 10 if m >= AS_OF - timedelta(days=1) else m.day % 3, "int"))
    for direction in ("both", "spike"):
        config = monitors.with_overrides(CONFIG, direction=direction, sensitivity=3)
        scores = anomaly.column_anomalies(df, "t", config, "metric", ["max"])
        assert failed(scores)
        recent = scores.where(F.col("bucket_end") > F.lit(AS_OF - timedelta(days=2)))
        outside = ~F.col("metric_value").between(F.col("min_metric_value"), F.col("max_metric_value"))
        assert recent.where(F.col("is_anomalous") != outside).isEmpty()


def test_small_changes_are_ignored(spark):
    df = frame(spark, days_back(), 100).unionByName(frame(spark, [AS_OF - timedelta(hours=1)] * 5))
    assert failed(anomaly.volume_anomalies(df, "t", CONFIG))
    lenient = monitors.with_overrides(CONFIG, spike_failure_percent_threshold=10, drop_failure_percent_threshold=10)
    results = anomaly.volume_anomalies(df, "t", lenient)
    assert not failed(results)
    assert results.where("training_stddev > 0").first()["max_metric_value"] > 105


def test_dimension_values_that_vanish(spark):
    names = ["Superman", "Batman"]
    all_days = frame(spark, days_back(), 2, hero=(lambda m, i: names[i], "string"))
    config = monitors.with_overrides(CONFIG, dimensions=("hero",))
    assert not failed(anomaly.dimension_anomalies(all_days, "t", config))
    # history knows both; on the last day one is absent
    earlier = monitors.with_overrides(config, as_of=AS_OF - timedelta(days=1))
    history = monitors.merge_metric_store(None, monitors.dimension_metrics(all_days, "t", earlier))
    last_day = F.lit(AS_OF - timedelta(days=1))
    gone = all_days.where((F.col("updated_at") < last_day) | (F.col("hero") == "Superman"))
    metrics = monitors.dimension_metrics(gone, "t", config, history)
    zero = metrics.where((F.col("dimension_value") == "Batman") & (F.col("metric_value") == 0))
    assert zero.count() == 1 and zero.first()["bucket_start"] == AS_OF - timedelta(days=1)
    assert failed(anomaly.dimension_anomalies(gone, "t", config, history))
    # values whose whole history is zero are forgotten
    blank = history.withColumn("metric_value", F.lit(0.0))
    assert monitors.dimension_metrics(gone, "t", config, blank).where("metric_value = 0").isEmpty()


def test_zero_fill_starts_at_the_first_appearance(spark):
    late = AS_OF - timedelta(days=4)
    df = frame(spark, [m for m in days_back() if m.day % 2], 1, hero=(lambda m, i: "new" if m >= late else "old", "string"))
    config = monitors.with_overrides(CONFIG, dimensions=("hero",))
    history = monitors.dimension_metrics(df, "t", config)
    filled = monitors.dimension_metrics(df, "t", config, history).where("dimension_value = 'new'")
    assert filled.agg(F.min("bucket_start")).first()[0] >= late
    assert filled.where("metric_value = 0").count() >= 1


def test_dimensions_without_time(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 1)], "x string, y int")
    config = MonitorConfig(as_of=AS_OF, dimensions=("x",))
    history = monitors.dimension_metrics(spark.createDataFrame([("gone", 1)], "x string, y int"), "t", config)
    found = monitors.dimension_metrics(df, "t", config, history)
    assert rows(found, "dimension_value", "metric_value") == [("NULL", 1.0), ("a", 2.0), ("gone", 0.0)]


@pytest.mark.parametrize(
    "bucket, step, days, backfill",
    [
        (Period("hour", 1), timedelta(minutes=10), 14, 2),
        (Period("day", 1), timedelta(hours=2), 30, 3),
        (Period("week", 1), timedelta(hours=12), 105, 14),
        (Period("month", 1), timedelta(days=2), 450, 60),
    ],
)
def test_freshness(spark, bucket, step, days, backfill):
    config = monitors.with_overrides(CONFIG, time_bucket=bucket, days_back=days, backfill_days=backfill)
    moments = days_back(days + 40, step)
    assert not failed(anomaly.freshness_anomalies(frame(spark, moments), "t", config))
    stop = AS_OF - timedelta(days=backfill)
    halted = frame(spark, [m for m in moments if m < stop])
    results = anomaly.freshness_anomalies(halted, "t", config)
    assert failed(results)
    # a faster feed is never an anomaly
    dense = frame(spark, moments + [m + step / 2 for m in moments if m > stop])
    assert not failed(anomaly.freshness_anomalies(dense, "t", config))


def test_freshness_before_the_first_update_is_unknown(spark):
    df = frame(spark, [AS_OF - timedelta(days=3)])
    found = monitors.freshness_metric(df, "t", CONFIG)
    assert found.count() == 3
    assert found.agg(F.max("metric_value")).first()[0] == 3 * 86400


def test_freshness_lead_in(spark):
    """An update before the range decides the first bucket's wait."""
    df = frame(spark, [AS_OF - timedelta(days=16), AS_OF - timedelta(days=13, hours=12)])
    first = monitors.freshness_metric(df, "t", CONFIG).orderBy("bucket_start").first()
    assert first["metric_value"] == 2.5 * 86400


def test_event_freshness(spark):
    config = monitors.with_overrides(CONFIG, event_timestamp_column="event_at")
    steady = frame(spark, days_back(31, timedelta(hours=1)), 1, event_at=(lambda m, i: m, "timestamp"))
    assert not failed(anomaly.event_freshness_anomalies(steady, "t", config))
    slow = frame(
        spark, days_back(31, timedelta(hours=1)), 1,
        event_at=(lambda m, i: m if m < AS_OF - timedelta(days=1) else m - timedelta(hours=2), "timestamp"),
    )
    assert failed(anomaly.event_freshness_anomalies(slow, "t", config))
    with pytest.raises(ValueError):
        anomaly.event_freshness_anomalies(steady, "t", CONFIG)


def test_missing_count(spark):
    df = spark.createDataFrame([(x,) for x in ["a", "b", "c", " a ", None, " ", "null", "NULL"]], "s string")
    found = monitors.column_metrics(df, "t", MonitorConfig(as_of=AS_OF), {"s": ["missing_count", "null_count"]})
    assert {r["metric_name"]: r["metric_value"] for r in found.collect()} == {"missing_count": 4.0, "null_count": 1.0}


def test_single_row_deviation_is_left_out(spark):
    df = spark.createDataFrame([(5,)], "v int")
    found = monitors.column_metrics(df, "t", MonitorConfig(as_of=AS_OF), {"v": ["standard_deviation", "zero_count", "average"]})
    assert {r["metric_name"] for r in found.collect()} == {"zero_count", "average"}


def test_monitors_by_type(spark):
    schema = spark.createDataFrame([], "a int, b string, c boolean, d timestamp").schema
    assert monitors.monitors_for(schema["d"].dataType) == ["null_count", "null_percent"]
    assert "average" in monitors.monitors_for(schema["a"].dataType)
    assert "sum" not in monitors.monitors_for(schema["a"].dataType)  # available, not default
    assert monitors.monitors_for(schema["a"].dataType, ["sum", "max_length"]) == ["sum"]
    assert "count_true" in monitors.monitors_for(schema["c"].dataType)


def test_collect_metrics(spark):
    df = frame(spark, days_back(), 2, id=(lambda m, i: i, "int"), name=(lambda m, i: "n", "string"))
    wanted = [
        {"name": "rows", "type": "row_count"},
        {"name": "empty", "type": "null_count", "columns": "*"},
        {"name": "highest", "type": "max", "columns": ["id"]},
    ]
    found = monitors.collect_metrics(df, "t", CONFIG, wanted)
    names = {(r["metric_name"], r["column_name"]) for r in found.select("metric_name", "column_name").distinct().collect()}
    assert names == {("rows", None), ("empty", "updated_at"), ("empty", "id"), ("empty", "name"), ("highest", "id")}
    for bad in (
        [{"name": "x", "type": "row_count", "columns": "id"}], [{"name": "x", "type": "max"}], [{"type": "row_count"}],
        [{"name": "x", "type": "row_count"}, {"name": "x", "type": "freshness"}],
    ):
        with pytest.raises(ValueError):
            monitors.collect_metrics(df, "t", CONFIG, bad)


def test_planned_range(spark):
    df = frame(spark, days_back())
    start, end = monitors.planned_range(CONFIG)
    assert (start, end) == (datetime(2024, 1, 18), AS_OF)
    store = monitors.row_count_metric(df, "t", CONFIG)
    assert monitors.planned_range(CONFIG, store, full_table_name="T")[0] == datetime(2024, 1, 30)  # backfill only
    gap = store.where(F.col("bucket_start") != F.lit(datetime(2024, 1, 22)))
    assert monitors.planned_range(CONFIG, gap)[0] == datetime(2024, 1, 22)
    assert monitors.planned_range(CONFIG, store.limit(0))[0] == datetime(2024, 1, 18)
    other = monitors.with_overrides(CONFIG, where_expression="true")
    assert monitors.planned_range(other, store)[0] == datetime(2024, 1, 18)  # other settings, other metrics
    two = monitors.with_overrides(CONFIG, time_bucket=Period("day", 5))
    assert monitors.planned_range(two)[1] == datetime(2024, 1, 28)  # the last bucket would be cut short


def test_history_replaces_recomputation(spark, rows):
    df = frame(spark, days_back(), 3)
    fresh = anomaly.volume_anomalies(df, "t", CONFIG)
    earlier = monitors.with_overrides(CONFIG, as_of=AS_OF - timedelta(days=3))
    store = monitors.merge_metric_store(None, monitors.row_count_metric(df, "t", earlier))
    resumed = anomaly.volume_anomalies(df, "t", CONFIG, store)
    columns = ["bucket_end", "metric_value", "training_avg", "is_anomalous"]
    assert rows(resumed, *columns) == rows(fresh, *columns)
    # metrics from before a full refresh of the table do not train
    cut = monitors.with_overrides(CONFIG, latest_full_refresh=AS_OF)
    assert anomaly.volume_anomalies(df, "t", cut, store).count() == 3


def test_seasonality(spark):
    weekend = [m for m in days_back(140) if m.weekday() >= 5]
    df = frame(spark, days_back(140), 2).unionByName(frame(spark, weekend, 20))
    season = monitors.with_overrides(CONFIG, seasonality="day_of_week", days_back=19)
    assert season.effective_days_back == 133
    results = anomaly.volume_anomalies(df, "t", season)
    assert results.select("bucket_seasonality").distinct().count() == 7 and not failed(results)
    for bad in ({"seasonality": "monthly"}, {"seasonality": "hour_of_day"}, {"seasonality": "day_of_week", "timestamp_column": None}):
        with pytest.raises(ValueError):
            monitors.with_overrides(CONFIG, **bad)


def test_configuration():
    levels = MonitorConfig.layered(
        {"as_of": AS_OF, "sensitivity": 2, "days_back": 30}, {"sensitivity": 4, "days_back": None}, {"timestamp_column": "t"}
    )
    assert (levels.sensitivity, levels.days_back, levels.timestamp_column, levels.backfill_days) == (4, 30, "t", 2)
    periods = MonitorConfig(as_of=AS_OF, training_period=Period("week", 2), detection_period=Period("hour", 48))
    assert (periods.effective_days_back, periods.effective_backfill_days) == (14, 2)
    assert json.loads(CONFIG.metric_properties)["time_bucket"] == {"count": 1, "period": "day"}
    for bad in ({"direction": "up"}, {"sensitivity": 0}, {"time_bucket": Period("day", 0)}, {"spike_failure_percent_threshold": -1}):
        with pytest.raises(ValueError):
            MonitorConfig(as_of=AS_OF, **bad)


def test_excluded_metrics_and_final_results(spark):
    df = frame(spark, days_back())
    config = monitors.with_overrides(
        CONFIG, anomaly_exclude_metrics="metric_date < date '2024-01-25'", exclude_final_results="training_set_size > 2"
    )
    assert anomaly.volume_anomalies(df, "t", config).count() == 5
    minimum = monitors.with_overrides(CONFIG, min_training_set_size=99, fail_on_zero=True)
    assert not failed(anomaly.volume_anomalies(df.limit(3), "t", minimum))


def test_store_views(spark):
    df = frame(spark, days_back(), 2).unionByName(frame(spark, [AS_OF - timedelta(hours=1)] * 40))
    store = monitors.merge_metric_store(None, monitors.row_count_metric(df, "t", CONFIG))
    scores = anomaly.metrics_anomaly_score(store, AS_OF)
    assert scores.count() == 8 and scores.where("is_anomaly").count() == 1
    sweep = anomaly.anomaly_threshold_sensitivity(scores).first()
    assert sweep["is_anomaly_3"] and not sweep["is_anomaly_4_5"]
    runs = monitors.monitor_runs(store).first()
    assert (runs["first_bucket_end"], runs["last_bucket_end"]) == (datetime(2024, 1, 19), AS_OF)


def test_scores_of_metrics_without_buckets(spark):
    stores = [
        monitors.row_count_metric(spark.range(10 + d % 3), "t", MonitorConfig(as_of=AS_OF - timedelta(days=d))) for d in range(5)
    ]
    store = stores[0]
    for other in stores[1:]:
        store = store.unionByName(other)
    scores = anomaly.metrics_anomaly_score(monitors.merge_metric_store(None, store), AS_OF)
    assert scores.count() == 5
    assert scores.agg(F.max("training_set_size")).first()[0] == 5
    assert scores.select("training_start").distinct().collect()[0][0] == AS_OF - timedelta(days=4)
