"""Stored moments, sketches and metrics of writes against what a full scan gives."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from drayline.operators import anomaly, monitors, observed, resumed
from drayline.operators.monitors import MonitorConfig
from drayline.plans import quantiles
from drayline.sources.tables import PartitionedTable

AS_OF = datetime(2024, 2, 1)
METRICS = (
    "id string, full_table_name string, column_name string, metric_name string, metric_value double, "
    "dimension string, dimension_value string, bucket_start timestamp, bucket_end timestamp, updated_at timestamp"
)


def metric(series, day, value):
    end = AS_OF - timedelta(days=40 - day)
    return (f"{series}-{day}", "t", None if series == "rows" else series, "m", value, None, None, end - timedelta(days=1), end, end)


def figures(df):
    return {r["id"]: r for r in df.collect()}


def assert_same(told, whole):
    """Equal up to what a double holds of a mean of 10^9: some 10^-7."""
    assert told.keys() == whole.keys()
    for key, row in whole.items():
        mine = told[key]
        assert (mine["training_set_size"], mine["training_start"]) == (row["training_set_size"], row["training_start"])
        for c in ("training_avg", "training_stddev", "anomaly_score"):
            if row[c] is None or mine[c] is None:
                assert mine[c] is row[c], (key, c)
            else:
                assert mine[c] == pytest.approx(row[c], abs=2e-6, rel=1e-12, nan_ok=True), (key, c)


@pytest.mark.parametrize("rows_per_chunk", [5_000_000, 4])
def test_scores_go_on_from_moments(spark, rows_per_chunk):
    rng = random.Random(3)
    store = [metric("rows", d, 1e9 + rng.random()) for d in range(30)]
    store += [metric("same", d, 0.1) for d in range(30)]
    store += [metric("gaps", d, None if d % 3 else float(d)) for d in range(30)]
    store += [metric("odd", d, float("nan") if d == 12 else float(d)) for d in range(30)]
    store += [metric("new", d, float(d * d)) for d in range(25, 30)] + [metric("none", d, None) for d in range(4)]
    all_rows = spark.createDataFrame(store, METRICS)
    day = F.datediff("bucket_end", F.lit(AS_OF - timedelta(days=40)))
    # Day 3 of one series is known in the last run only.
    turn = F.when((F.col("column_name") == "gaps") & (day == 3), 2).otherwise(F.least(F.floor(day / 10), F.lit(2)))
    told, state, read = {}, None, []
    for n in range(3):
        new = all_rows.where(turn == n)
        trained, state = resumed.resume_scores(new, all_rows.where(turn <= n), state, rows_per_chunk)
        read.append(trained.count() - new.count())
        told.update(figures(resumed.resumed_anomaly_score(trained, AS_OF, days=60)))
    whole = figures(anomaly.metrics_anomaly_score(all_rows, AS_OF, days=60))
    assert_same(told, whole)
    # Only the series that went back was read again.
    assert read[:2] == [0, 0] and read[2] == 19
    assert state.count() == 6
    assert {r["training_stddev"] for r in trained.where("column_name = 'same'").collect()} == {0.0}


def test_no_new_metrics(spark):
    store = spark.createDataFrame([metric("rows", d, float(d)) for d in range(4)], METRICS)
    _, state = resumed.resume_scores(store, store)
    trained, after = resumed.resume_scores(store.limit(0), store, state)
    assert trained.isEmpty() and after.exceptAll(state).isEmpty() and after.count() == 1


def trips(spark, n, days=9):
    rng = random.Random(n)
    data = [
        (date(2024, 1, 1 + rng.randrange(days)), rng.choice(["A", "B", None]), rng.choice([None, *[rng.randrange(20, 1200) / 10] * 9]), rng.random() < 0.1)
        for _ in range(n)
    ]
    return spark.createDataFrame(data, "trip_date date, delivery_address string, total_duration_min double, is_deleted boolean")


def test_sketches_merge_within_their_rank_error(spark, tmp_path):
    table = PartitionedTable(spark, str(tmp_path / "s"), ["trip_date"], str(tmp_path / "staging"))
    all_trips = trips(spark, 20_000)
    size = 256
    quantiles.refresh_sketches(table, all_trips.where("trip_date <= '2024-01-05'"), size=size)
    day = spark.createDataFrame([(date(2024, 1, d),) for d in range(5, 10)], "trip_date date")
    quantiles.refresh_sketches(table, all_trips, day, size)
    ranges = spark.createDataFrame([(date(2024, 1, 1), date(2024, 1, 9)), (date(2024, 1, 3), date(2024, 1, 4))], "first_day date, last_day date")
    found = quantiles.duration_quantiles(table.read(), [], {"p90": 0.9, "p10": 0.1}, ranges, size).collect()
    assert len(found) == 2
    usable = [(r["trip_date"], r["total_duration_min"]) for r in all_trips.collect() if not r["is_deleted"] and r["total_duration_min"] is not None]
    for row in found:
        values = [v for d, v in usable if row["first_day"] <= d <= row["last_day"]]
        assert row["total_orders"] == len(values)
        for name, fraction in (("p90", 0.9), ("p10", 0.1)):
            below, up_to = (sum(f(v) for v in values) / len(values) for f in (lambda v: v < row[name], lambda v: v <= row[name]))
            assert below - 2.5 / size <= fraction <= up_to + 2.5 / size
    by_district = quantiles.duration_quantiles(table.read(), ["district"], {"p50": 0.5}, size=size)
    assert {r["district"] for r in by_district.collect()} == {"A", "B", None}
    # A day that has lost its trips loses its sketches.
    quantiles.refresh_sketches(table, all_trips.where("trip_date <> '2024-01-09'"), day, size)
    assert table.read().where("trip_date = '2024-01-09'").isEmpty() and not table.read().isEmpty()


def test_metrics_of_a_write_equal_those_of_a_scan(spark, tmp_path, rows):
    df = spark.range(500).select(
        F.col("id").alias("n"), F.when(F.col("id") % 7 > 0, F.col("id") / 3).alias("x"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("v"), F.col("id"))).alias("s"), (F.col("id") % 3).alias("part"),
    )
    config = MonitorConfig(as_of=AS_OF)
    table = PartitionedTable(spark, str(tmp_path / "t"), ["part"], str(tmp_path / "staging"))
    watched = observed.ObservedMetrics("t", config, observed.chosen_columns(df))
    table.append(df, watched.watch)
    assert watched.row_count == table.read().count() == 500
    value = F.round("metric_value", 9).alias("metric_value")
    expected = monitors.all_columns_metrics(df, "t", config)
    assert rows(watched.metrics().withColumn("metric_value", value)) == rows(expected.withColumn("metric_value", value))
    # The second append has metrics of its own.
    second = observed.ObservedMetrics("t", config, ["x"])
    table.append(df.limit(0), second.watch)
    assert second.row_count == 0 and second.metrics().where("metric_name in ('min', 'average')").isEmpty()
    with pytest.raises(ValueError):
        observed.ObservedMetrics("t", MonitorConfig(as_of=AS_OF, timestamp_column="n"))
    with pytest.raises(ValueError):
        observed.ObservedMetrics("t", config).metrics()


def test_metrics_of_a_stream(spark, tmp_path):
    for n in range(2):
        spark.range(10 * (n + 1)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id bigint").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    config = MonitorConfig(as_of=AS_OF)
    observed.start_observed(
        stream, str(tmp_path / "out"), str(tmp_path / "metrics"), str(tmp_path / "cp"),
        lambda _batch, n: observed.ObservedMetrics(f"t{n}", config, {"id": ["max", "null_count"]}), available_now=True,
    ).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 30
    found = spark.read.parquet(str(tmp_path / "metrics")).where("metric_name = 'max'")
    assert sorted(r["metric_value"] for r in found.collect()) == [9.0, 19.0]
