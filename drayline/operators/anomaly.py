"""Anomaly scores of metric series and the decision which points are anomalous.

A score compares a bucket with the running mean and deviation of its series up
to and including that bucket. Series are short (one row per bucket of the
training range), so a window per series is bounded by the configuration.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from drayline.functions import (
    arithmetic_max,
    arithmetic_min,
    as_of_timestamp,
    day_of_week,
    hour_of_day,
    hour_of_week,
    metric_id,
    moment,
)
from drayline.operators import monitors
from drayline.operators.chunking import ROWS_PER_CHUNK, expanding_stats
from drayline.operators.latest import latest_per_key
from drayline.operators.monitors import MonitorConfig
from drayline.operators.reshape import bucket_spine
from drayline.session import cut_lineage

# Metrics that may be negative, and metrics of which only a rise is bad.
SIGNED_METRICS = ["min", "max", "average", "standard_deviation", "variance", "sum"]
RISE_ONLY_METRICS = ["freshness", "event_freshness"]

_INSTANT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
_SERIES = ["full_table_name", "column_name", "metric_name", "dimension", "dimension_value", "bucket_seasonality"]


def _season(config: MonitorConfig) -> Column:
    end = F.col("bucket_end")
    if config.seasonality == "day_of_week":
        return day_of_week(end)
    if config.seasonality == "hour_of_day":
        return hour_of_day(end)
    if config.seasonality == "hour_of_week":
        return hour_of_week(end)
    return F.lit("no_seasonality")


def _relevant_history(
    history: DataFrame, table: str, config: MonitorConfig, metric_names: list[str] | None, column: str | None,
    columns_only: bool,
) -> DataFrame:
    """Stored metrics of the training range that were computed under the same settings."""
    start, end = config.min_bucket_start, config.detection_end
    kept = history.where(
        (F.col("bucket_end") > moment(start))
        & (F.col("metric_properties") == config.metric_properties)
        & (F.upper("full_table_name") == table.upper())
    )
    if metric_names:
        kept = kept.where(F.col("metric_name").isin(*metric_names))
    if column:
        kept = kept.where(F.upper("column_name") == column.upper())
    if columns_only:
        kept = kept.where(F.col("column_name").isNotNull())
    if config.dimensions:
        kept = kept.where(F.col("dimension") == "; ".join(config.dimensions))
    if config.latest_full_refresh is not None:
        kept = kept.where(F.col("updated_at") > moment(config.latest_full_refresh))
    if config.timestamp_column is not None:
        # Only buckets of the present alignment; the spine is bounded by the settings.
        spine = bucket_spine(history.sparkSession, start, end, config.time_bucket)
        kept = kept.join(F.broadcast(spine), ["bucket_start", "bucket_end"], "left_semi")
    return kept.select(*monitors.METRIC_COLUMNS)


def _limits(config: MonitorConfig) -> tuple[Column, Column]:
    """The expected range, widened where small relative changes are to be ignored."""
    mean, spread = F.col("training_avg"), F.col("training_stddev") * config.sensitivity
    low, high = mean - spread, mean + spread
    if config.drop_failure_percent_threshold:
        low = arithmetic_min((1 - config.drop_failure_percent_threshold / 100.0) * mean, low)
    if config.spike_failure_percent_threshold:
        high = arithmetic_max((1 + config.spike_failure_percent_threshold / 100.0) * mean, high)
    return low, high


def anomaly_scores(
    new_metrics: DataFrame,
    table: str,
    config: MonitorConfig,
    history: DataFrame | None = None,
    metric_names: list[str] | None = None,
    column: str | None = None,
    columns_only: bool = False,
    execution_id: str = "",
    test_id: str = "",
) -> DataFrame:
    """Score every metric of the training range and of this run.

    Of several values of one metric the last updated counts. Rows matching
    ``anomaly_exclude_metrics`` neither train nor score; the expression may use
    ``metric_date`` and ``metric_time_bucket``.
    """
    rows = new_metrics.select(*monitors.METRIC_COLUMNS)
    if history is not None:
        rows = _relevant_history(history, table, config, metric_names, column, columns_only).unionByName(rows)
    rows = latest_per_key(rows, ["id"], ["updated_at"])
    bucket_time = F.coalesce("bucket_start", "bucket_end")
    rows = rows.withColumn("metric_time_bucket", bucket_time).withColumn(
        "metric_date", bucket_time.cast("date")
    )
    if config.anomaly_exclude_metrics:
        rows = rows.where(~F.expr(config.anomaly_exclude_metrics))
    rows = rows.withColumn("bucket_seasonality", _season(config))
    window = W.partitionBy(*_SERIES).orderBy("bucket_end").rowsBetween(W.unboundedPreceding, W.currentRow)
    trained = rows.select(
        "*",
        F.avg("metric_value").over(window).alias("training_avg"),
        F.stddev_samp("metric_value").over(window).alias("training_stddev"),
        F.count("metric_value").over(window).alias("training_set_size"),
        F.last("bucket_end").over(window).alias("training_end"),
        F.first("bucket_end").over(window).alias("training_start"),
    ).where(F.col("metric_value").isNotNull() & F.col("training_avg").isNotNull())
    spread = F.col("training_stddev")
    low, high = _limits(config)
    score = F.when(spread == 0, F.lit(0.0)).when(
        spread.isNotNull(), F.try_divide(F.col("metric_value") - F.col("training_avg"), spread)
    )
    may_be_negative = F.col("metric_name").isin(*SIGNED_METRICS)
    return trained.select(
        metric_id(["id", F.lit(execution_id)]).alias("id"),
        F.col("id").alias("metric_id"),
        F.lit(execution_id).alias("test_execution_id"),
        F.lit(test_id).alias("test_unique_id"),
        as_of_timestamp(config.as_of).alias("detected_at"),
        "full_table_name",
        "column_name",
        "metric_name",
        score.alias("anomaly_score"),
        F.lit(float(config.sensitivity)).alias("anomaly_score_threshold"),
        F.col("source_value").alias("anomalous_value"),
        "bucket_start",
        "bucket_end",
        "bucket_seasonality",
        "metric_value",
        F.when(spread.isNull(), None).when((low > 0) | may_be_negative, low).otherwise(F.lit(0.0)).alias("min_metric_value"),
        F.when(spread.isNotNull(), high).alias("max_metric_value"),
        "training_avg",
        "training_stddev",
        "training_set_size",
        "training_start",
        "training_end",
        "dimension",
        "dimension_value",
    )


def anomaly_description() -> Column:
    """Text that explains a scored row; its sentences are fixed values."""

    def shown(value: Column, places: int) -> Column:
        return F.round(value.cast("decimal(38,6)"), places).cast("string")

    value, mean = shown(F.col("metric_value"), 3), shown(F.col("training_avg"), 3)
    average = F.concat(F.lit(" is "), value, F.lit(". The average for this metric is "), mean, F.lit("."))
    name = F.col("metric_name")
    has_dimension, has_column = F.col("dimension").isNotNull(), F.col("column_name").isNotNull()
    hours = shown(F.abs(F.col("metric_value")) / 3600, 2)
    usual = shown(F.abs(F.col("training_avg")) / 3600, 2)
    return (
        F.when(
            has_dimension & ~has_column,
            F.concat(
                F.lit("The last "), name, F.lit(" value for dimension "), F.col("dimension"), F.lit(" - "),
                F.coalesce("dimension_value", F.lit("NULL")), average,
            ),
        )
        .when(
            has_dimension,
            F.concat(
                F.lit("In column "), F.col("column_name"), F.lit(", the last "), name,
                F.lit(" value for dimension "), F.col("dimension"), average,
            ),
        )
        .when(
            name == "freshness",
            F.concat(
                F.lit("Last update was at "), F.col("anomalous_value"), F.lit(", "), hours,
                F.lit(" hours ago. Usually the table is updated within "), usual, F.lit(" hours."),
            ),
        )
        .when(has_column, F.concat(F.lit("In column "), F.col("column_name"), F.lit(", the last "), name, F.lit(" value"), average))
        .otherwise(F.concat(F.lit("The last "), name, F.lit(" value"), average))
    )


def _outside(config: MonitorConfig) -> Column:
    score, limit = F.col("anomaly_score"), F.lit(float(config.sensitivity))
    directed = {
        "spike": score > limit,
        "drop": score < -limit,
        "both": F.abs(score) > limit,
    }[config.direction]
    return F.when(F.col("metric_name").isin(*RISE_ONLY_METRICS), score > limit).otherwise(directed)


def _large_enough(config: MonitorConfig) -> Column:
    value, mean = F.col("metric_value"), F.col("training_avg")
    spike, drop = config.spike_failure_percent_threshold, config.drop_failure_percent_threshold
    rises = value > (1 + spike / 100.0) * mean if spike and config.direction != "drop" else None
    falls = value < (1 - drop / 100.0) * mean if drop and config.direction != "spike" else None
    if rises is not None and falls is not None:
        return rises | falls
    return rises if rises is not None else falls if falls is not None else F.lit(True)


def detect_anomalies(scores: DataFrame, config: MonitorConfig) -> DataFrame:
    """Scored rows with ``is_anomalous`` and the bounds to plot.

    Only buckets of the last backfill days before the newest bucket can be
    anomalous. At an anomaly the plotted bound is that of the bucket before.
    The newest bucket is read first, so pass scores of stored metrics.
    """
    newest = scores.agg(F.date_format(F.max("bucket_end"), _INSTANT).alias("m")).first()["m"]
    rows = scores.withColumn("max_bucket_end", F.to_timestamp(F.lit(newest).cast("string"), _INSTANT))
    anomalous = F.col("anomaly_score").isNotNull()
    bad = _outside(config) & _large_enough(config)
    if config.fail_on_zero:
        bad = bad | (F.col("metric_value") == 0)
    anomalous = anomalous & bad
    if config.min_training_set_size is not None:
        anomalous = anomalous & (F.col("training_set_size") >= config.min_training_set_size)
    since = F.col("max_bucket_end") - F.expr(f"interval {config.effective_backfill_days} days")
    anomalous = anomalous & (F.col("bucket_end") > since)
    rows = rows.withColumn("anomaly_description", anomaly_description()).withColumn(
        "is_anomalous", F.coalesce(anomalous, F.lit(False))
    )
    before = W.partitionBy(*_SERIES).orderBy("bucket_end")

    def bound(limit: str, open_direction: str) -> Column:
        """The side that cannot fail follows the value itself."""
        shown = "metric_value" if config.direction == open_direction else limit
        return F.when(F.col("is_anomalous"), F.lag(shown).over(before)).otherwise(F.col(shown))

    final = rows.select(
        F.col("metric_value").alias("value"),
        F.col("training_avg").alias("average"),
        bound("min_metric_value", "spike").alias("min_value"),
        bound("max_metric_value", "drop").alias("max_value"),
        F.col("bucket_start").alias("start_time"),
        F.col("bucket_end").alias("end_time"),
        "*",
    )
    return final.where(config.exclude_final_results) if config.exclude_final_results else final


def anomalies(results: DataFrame) -> DataFrame:
    return results.where("is_anomalous")


def anomaly_test_results(results: DataFrame) -> DataFrame:
    """One row per (table, column, metric): latest point, number of anomalies, description.

    The scored points are numbered by bucket; the newest one names the result.
    """
    keys = ["full_table_name", "column_name", "metric_name"]
    order = F.struct(F.col("bucket_end"), F.coalesce("dimension_value", F.lit("")))
    scored = F.col("anomaly_score").isNotNull()
    point = F.struct(order.alias("o"), "id", "metric_id", "anomalous_value")
    described = F.struct(order.alias("o"), F.col("anomaly_description").alias("text"))
    grouped = results.groupBy(*keys).agg(
        F.max(point).alias("_latest"),
        F.max(F.when(scored, described)).alias("_described"),
        F.count_if(scored).alias("scored_points"),
        F.count_if(F.col("is_anomalous") & scored).alias("failures"),
    )
    return grouped.select(
        F.col("_latest.id").alias("id"),
        F.col("_latest.metric_id").alias("data_issue_id"),
        *keys,
        F.lit("anomaly_detection").alias("test_type"),
        F.col("metric_name").alias("test_sub_type"),
        F.coalesce("_described.text", F.lit("Not enough data to calculate anomaly score.")).alias("test_results_description"),
        F.col("_latest.anomalous_value").alias("other"),
        "scored_points",
        "failures",
        F.when(F.col("failures") > 0, "fail").otherwise("pass").alias("status"),
    )


# --- tests: metrics, scores and decision in one call --------------------------------------


def _test(metrics: DataFrame, table: str, config: MonitorConfig, history, **kwargs) -> DataFrame:
    """Store the run's metrics, then score and decide: the monitored table is scanned once."""
    stored = cut_lineage(metrics, "metrics")
    return detect_anomalies(anomaly_scores(stored, table, config, history, **kwargs), config)


def table_anomalies(
    df: DataFrame, table: str, config: MonitorConfig, metrics: list[str] | None = None,
    history: DataFrame | None = None, **kwargs,
) -> DataFrame:
    chosen = metrics or monitors.DEFAULT_MONITORS["table"]
    span = monitors.planned_range(config, history, full_table_name=table, metric_names=chosen) if config.timestamp_column else None
    return _test(
        monitors.table_metrics(df, table, config, chosen, span), table, config, history,
        metric_names=chosen, **kwargs,
    )


def volume_anomalies(df, table, config, history=None, **kwargs) -> DataFrame:
    return table_anomalies(df, table, config, ["row_count"], history, **kwargs)


def freshness_anomalies(df, table, config, history=None, **kwargs) -> DataFrame:
    if config.timestamp_column is None:
        raise ValueError("freshness needs a timestamp_column")
    return table_anomalies(df, table, config, ["freshness"], history, **kwargs)


def event_freshness_anomalies(df, table, config, history=None, **kwargs) -> DataFrame:
    if config.event_timestamp_column is None:
        raise ValueError("event freshness needs an event_timestamp_column")
    return table_anomalies(df, table, config, ["event_freshness"], history, **kwargs)


def column_anomalies(
    df: DataFrame, table: str, config: MonitorConfig, column: str, monitors_list: list[str] | None = None,
    history: DataFrame | None = None, **kwargs,
) -> DataFrame:
    chosen = monitors.monitors_for(df.schema[column].dataType, monitors_list)
    span = None
    if config.timestamp_column:
        span = monitors.planned_range(config, history, full_table_name=table, metric_names=chosen, column_name=column)
    metrics = monitors.column_metrics(df, table, config, {column: chosen}, span)
    return _test(metrics, table, config, history, metric_names=chosen, column=column, **kwargs)


def all_columns_anomalies(
    df: DataFrame, table: str, config: MonitorConfig, monitors_list: list[str] | None = None,
    exclude_prefix: str | None = None, exclude_regexp: str | None = None,
    history: DataFrame | None = None, **kwargs,
) -> DataFrame:
    span = monitors.planned_range(config, history, full_table_name=table) if config.timestamp_column else None
    metrics = monitors.all_columns_metrics(df, table, config, monitors_list, exclude_prefix, exclude_regexp, span)
    return _test(metrics, table, config, history, columns_only=True, **kwargs)


def dimension_anomalies(
    df: DataFrame, table: str, config: MonitorConfig, history: DataFrame | None = None, **kwargs
) -> DataFrame:
    span = None
    if config.timestamp_column:
        span = monitors.planned_range(config, history, full_table_name=table, metric_names=["dimension"])
    metrics = monitors.dimension_metrics(df, table, config, history, span)
    return _test(metrics, table, config, history, metric_names=["dimension"], **kwargs)


# --- views over the metric store -------------------------------------------------------------


def metrics_anomaly_score(
    store: DataFrame, as_of, sensitivity: float = 3, days: int = 7, rows_per_chunk: int = ROWS_PER_CHUNK
) -> DataFrame:
    """Scores of the last days of every stored series; all dimension values of a metric form one series."""
    keys = ["metric_name", "full_table_name", "column_name"]
    rows = store.select(
        "id", "full_table_name", "column_name", "dimension", "dimension_value", "metric_name",
        F.col("metric_value").alias("latest_metric_value"), "bucket_start", "bucket_end", "updated_at",
        # Metrics without time buckets have an end only.
        F.coalesce("bucket_start", "bucket_end").alias("_at"),
    )
    trained = expanding_stats(rows, keys, ["_at", "bucket_end", "id"], "latest_metric_value", rows_per_chunk)
    begin = rows.groupBy(*keys).agg(F.min(F.struct("_at", "bucket_end", "id")).alias("_begin"))
    same = reduce(lambda a, b: a & b, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys])
    trained = trained.alias("l").join(begin.alias("r"), same, "left").select(
        "l.*", F.col("_begin.bucket_end").alias("training_start"), F.col("l.bucket_end").alias("training_end")
    ).drop("_at")
    return recent_scores(trained, as_of, sensitivity, days)


def recent_scores(trained: DataFrame, as_of, sensitivity: float, days: int) -> DataFrame:
    """Scores and verdicts of the last days, given the running statistics of every series."""
    spread = F.col("training_stddev")
    score = F.when(spread == 0, F.lit(0.0)).when(
        spread.isNotNull(), F.try_divide(F.col("latest_metric_value") - F.col("training_avg"), spread)
    )
    since = F.date_trunc("day", moment(as_of)) - F.expr(f"interval {days} days")
    recent = trained.where(
        F.col("latest_metric_value").isNotNull() & F.col("training_avg").isNotNull() & (F.col("bucket_end") >= since)
    ).withColumn("anomaly_score", score)
    return recent.withColumn("is_anomaly", F.coalesce(F.abs("anomaly_score") > float(sensitivity), F.lit(False)))


# The thresholds of the sensitivity sweep.
SWEEP = (1.5, 2, 2.5, 3, 3.5, 4, 4.5)


def anomaly_threshold_sensitivity(scores: DataFrame) -> DataFrame:
    """Which recent scores would be anomalies at which threshold."""
    size = F.abs("anomaly_score")
    flags = [(size >= float(t)).alias(f"is_anomaly_{str(t).replace('.', '_')}") for t in SWEEP]
    return scores.where(size >= SWEEP[0]).select(
        "full_table_name", "column_name", "metric_name", "latest_metric_value",
        F.col("training_avg").alias("metric_avg"), F.col("training_stddev").alias("metric_stddev"),
        "anomaly_score", *flags,
    )
