"""Metrics over time buckets, in long format (one row per table, column, metric and bucket).

Every metric is an aggregate by bucket that combines on the map side. The
spine of buckets comes from parameters, so filling gaps is a broadcast join of
two small tables; the monitored rows are scanned once and never joined.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from drayline.functions import (
    Period,
    as_of_timestamp,
    concat_with_separator,
    metric_id,
    moment,
    not_percent,
    percent,
    type_group,
)
from drayline.operators.incremental import merge_upsert
from drayline.operators.latest import latest_per_key
from drayline.operators.reshape import bucket_spine, columns_ignoring

# Available and default monitors by kind of column.
AVAILABLE_MONITORS = {
    "table": ["row_count", "freshness"],
    "any": ["null_count", "null_percent", "not_null_percent"],
    "string": [
        "min_length", "max_length", "average_length", "missing_count", "missing_percent",
        "not_missing_percent",
    ],
    "numeric": [
        "min", "max", "zero_count", "zero_percent", "not_zero_percent", "average",
        "standard_deviation", "variance", "sum",
    ],
    "boolean": ["count_true", "count_false"],
}
DEFAULT_MONITORS = {
    "table": ["row_count", "freshness"],
    "any": ["null_count", "null_percent"],
    "string": ["min_length", "max_length", "average_length", "missing_count", "missing_percent"],
    "numeric": [
        "min", "max", "zero_count", "zero_percent", "average", "standard_deviation", "variance",
    ],
    "boolean": ["count_true", "count_false"],
}
# Seasonal keys and the bucket each one needs.
SEASONALITIES = {"day_of_week": "day", "hour_of_day": "hour", "hour_of_week": "hour"}
# Days read before the first bucket, so that its first gap between updates is known.
FRESHNESS_LEAD_DAYS = 7

# The columns of the metric store.
METRIC_COLUMNS = [
    "id", "full_table_name", "column_name", "metric_name", "metric_type", "metric_value",
    "source_value", "bucket_start", "bucket_end", "bucket_duration_hours", "updated_at",
    "dimension", "dimension_value", "metric_properties",
]


@dataclass(frozen=True)
class MonitorConfig:
    """Settings of a monitor and of the anomaly decision on it."""

    as_of: datetime
    timestamp_column: str | None = None
    event_timestamp_column: str | None = None
    where_expression: str | None = None
    time_bucket: Period = field(default_factory=lambda: Period("day", 1))
    days_back: int = 14
    backfill_days: int = 2
    freshness_lead_days: int = FRESHNESS_LEAD_DAYS
    training_period: Period | None = None
    detection_period: Period | None = None
    detection_delay: Period = field(default_factory=lambda: Period("hour", 0))
    dimensions: tuple[str, ...] = ()
    seasonality: str | None = None
    sensitivity: float = 3
    direction: str = "both"
    spike_failure_percent_threshold: float | None = None
    drop_failure_percent_threshold: float | None = None
    fail_on_zero: bool = False
    min_training_set_size: int | None = None
    anomaly_exclude_metrics: str | None = None
    exclude_final_results: str | None = None
    latest_full_refresh: datetime | None = None

    def __post_init__(self) -> None:
        if self.direction not in ("both", "spike", "drop"):
            raise ValueError(f"direction must be both, spike or drop, got {self.direction!r}")
        if self.time_bucket.count < 1:
            raise ValueError("time_bucket count must be larger than 0")
        if self.detection_delay.period not in ("hour", "day", "week"):
            raise ValueError("detection_delay takes hours, days or weeks")
        if self.sensitivity <= 0:
            raise ValueError("sensitivity must be positive")
        for name in ("spike_failure_percent_threshold", "drop_failure_percent_threshold"):
            value = getattr(self, name)
            if value is not None and value <= 0:
                raise ValueError(f"{name} must be positive")
        if self.seasonality is not None:
            if self.timestamp_column is None:
                raise ValueError("seasonality needs a timestamp_column")
            if self.seasonality not in SEASONALITIES:
                raise ValueError(f"seasonality must be one of {sorted(SEASONALITIES)}")
            if self.time_bucket != Period(SEASONALITIES[self.seasonality], 1):
                raise ValueError(
                    f"{self.seasonality} needs a time_bucket of 1 {SEASONALITIES[self.seasonality]}"
                )

    @classmethod
    def layered(cls, *settings: dict) -> "MonitorConfig":
        """Build from several levels of settings, e.g. project, table and test; later ones win."""
        merged: dict = {}
        for level in settings:
            merged.update({k: v for k, v in level.items() if v is not None})
        return cls(**merged)

    @property
    def effective_days_back(self) -> int:
        days = self.training_period.convert("day").count if self.training_period else self.days_back
        return days * 7 if self.seasonality in ("day_of_week", "hour_of_week") else days

    @property
    def effective_backfill_days(self) -> int:
        return self.detection_period.convert("day").count if self.detection_period else self.backfill_days

    @property
    def detection_end(self) -> datetime:
        return self.as_of - timedelta(hours=self.detection_delay.convert("hour").count)

    @property
    def min_bucket_start(self) -> datetime:
        """Start of the period in which the training range begins."""
        day = _midnight(self.detection_end - timedelta(days=self.effective_days_back))
        if self.time_bucket.period == "week":
            return day - timedelta(days=day.weekday())
        return day.replace(day=1) if self.time_bucket.period == "month" else day

    @property
    def backfill_start(self) -> datetime:
        return _midnight(self.detection_end - timedelta(days=self.effective_backfill_days))

    @property
    def metric_properties(self) -> str:
        """The settings a metric value depends on; metrics with other settings are not comparable."""
        return json.dumps(
            {
                "dimensions": list(self.dimensions) or None,
                "event_timestamp_column": self.event_timestamp_column,
                "time_bucket": {"count": self.time_bucket.count, "period": self.time_bucket.period}
                if self.timestamp_column
                else None,
                "timestamp_column": self.timestamp_column,
                "where_expression": self.where_expression,
            },
            sort_keys=True,
        )


def _midnight(moment: datetime) -> datetime:
    return moment.replace(hour=0, minute=0, second=0, microsecond=0)


# --- buckets --------------------------------------------------------------------------


def bucket_start_of(timestamp: Column, start: datetime, bucket: Period) -> Column:
    """Start of the bucket a timestamp falls into, counting buckets from ``start``."""
    if bucket.period == "month":
        elapsed = F.timestamp_diff("MONTH", moment(start), timestamp)
        months = (F.floor(elapsed / bucket.count) * bucket.count).cast("int")
        return F.timestamp_add("MONTH", months, moment(start))
    length = bucket.convert("hour").count * 3_600_000_000
    origin = F.unix_micros(moment(start))
    elapsed = F.unix_micros(timestamp) - origin
    return F.timestamp_micros(origin + F.floor(elapsed / F.lit(length)) * F.lit(length))


def planned_range(
    config: MonitorConfig, history: DataFrame | None = None, spark=None,
    full_table_name: str | None = None, metric_names: list[str] | None = None,
    column_name: str | None = None,
) -> tuple[datetime, datetime]:
    """The (first bucket start, last bucket end) to compute.

    Without ``history``: the whole training range, cut to complete buckets.
    With it: from the first bucket the metric store lacks, or from the start of
    the backfill range if that is earlier.
    """
    end = config.detection_end
    start = config.min_bucket_start
    if history is None:
        return start, _last_complete(start, end, config.time_bucket)
    spark = spark or history.sparkSession
    spine = bucket_spine(spark, start, end, config.time_bucket)
    stored = history.where(
        (F.col("bucket_start") >= moment(start))
        & (F.col("bucket_end") <= moment(end))
        & (F.col("metric_properties") == config.metric_properties)
    )
    if full_table_name:
        stored = stored.where(F.upper("full_table_name") == full_table_name.upper())
    if metric_names:
        stored = stored.where(F.col("metric_name").isin(*metric_names))
    if column_name:
        stored = stored.where(F.upper("column_name") == column_name.upper())
    missing = spine.join(stored.select("bucket_start", "bucket_end").distinct(), ["bucket_start", "bucket_end"], "left_anti")
    first = missing.agg(F.date_format(F.min("bucket_start"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("m")).first()["m"]
    candidates = [config.backfill_start]
    if first is not None:
        candidates.append(datetime.strptime(first, "%Y-%m-%d %H:%M:%S.%f"))
    return min(candidates), end


def _last_complete(start: datetime, end: datetime, bucket: Period) -> datetime:
    if bucket.period == "month":
        current = start
        while True:
            months = current.year * 12 + current.month - 1 + bucket.count
            following = current.replace(year=months // 12, month=months % 12 + 1)
            if following > end:
                return current
            current = following
    length = timedelta(hours=bucket.convert("hour").count)
    return start + ((end - start) // length) * length


def _in_range(df: DataFrame, column: str, start: datetime, end: datetime) -> DataFrame:
    """Rows in [start, end), compared in the column's own type so that the scan can prune."""
    kind = df.schema[column].dataType
    value = F.col(column)
    if type_group(kind) != "timestamp":
        value, kind = value.cast("timestamp"), "timestamp"
    return df.where((value >= moment(start).cast(kind)) & (value < moment(end).cast(kind)))


def _monitored(df: DataFrame, config: MonitorConfig) -> DataFrame:
    return df.where(config.where_expression) if config.where_expression else df


def _spine(df: DataFrame, config: MonitorConfig, span: tuple[datetime, datetime]) -> DataFrame:
    return bucket_spine(df.sparkSession, span[0], span[1], config.time_bucket)


def _covered(df: DataFrame, config: MonitorConfig, span: tuple[datetime, datetime]) -> DataFrame:
    """Monitored rows inside complete buckets, with their bucket."""
    end = _last_complete(span[0], span[1], config.time_bucket)
    rows = _in_range(_monitored(df, config), config.timestamp_column, span[0], end)
    ts = F.col(config.timestamp_column).cast("timestamp")
    return rows.withColumn("bucket_start", bucket_start_of(ts, span[0], config.time_bucket))


def _finish(metrics: DataFrame, table: str, config: MonitorConfig, with_dimension_key: bool) -> DataFrame:
    """Add the columns every metric row carries, and its id."""
    have = set(metrics.columns)
    defaults = {
        "column_name": "string", "source_value": "string", "bucket_start": "timestamp",
        "dimension": "string", "dimension_value": "string",
    }
    for name, kind in defaults.items():
        if name not in have:
            metrics = metrics.withColumn(name, F.lit(None).cast(kind))
    if "bucket_end" not in have:
        metrics = metrics.withColumn("bucket_end", moment(config.as_of))
    full = (
        metrics.withColumn("full_table_name", F.lit(table))
        .withColumn("metric_value", F.col("metric_value").cast("double"))
        .withColumn(
            "bucket_duration_hours",
            F.timestamp_diff("HOUR", F.col("bucket_start"), F.col("bucket_end")).cast("int"),
        )
        .withColumn("updated_at", as_of_timestamp(config.as_of))
        .withColumn("metric_properties", F.lit(config.metric_properties))
    )
    key = ["full_table_name", "column_name", "metric_name", "metric_type"]
    if with_dimension_key:
        key += ["dimension", "dimension_value"]
    return full.withColumn("id", metric_id([*key, "bucket_end", "metric_properties"])).select(*METRIC_COLUMNS)


# --- table metrics ----------------------------------------------------------------------


def row_count_metric(
    df: DataFrame, table: str, config: MonitorConfig, span=None, name: str = "row_count"
) -> DataFrame:
    """Rows per bucket, 0 for empty buckets; without a timestamp one count."""
    labels = [F.lit(name).alias("metric_name"), F.lit("row_count").alias("metric_type")]
    if config.timestamp_column is None:
        counted = _monitored(df, config).agg(F.count(F.lit(1)).alias("metric_value"))
        return _finish(counted.select("*", *labels), table, config, False)
    span = span or planned_range(config)
    counts = _covered(df, config, span).groupBy("bucket_start").agg(F.count(F.lit(1)).alias("_n"))
    filled = _spine(df, config, span).join(counts, "bucket_start", "left")
    return _finish(
        filled.select("bucket_start", "bucket_end", F.coalesce("_n", F.lit(0)).alias("metric_value"), *labels),
        table, config, False,
    )


def freshness_metric(
    df: DataFrame, table: str, config: MonitorConfig, span=None, name: str = "freshness"
) -> DataFrame:
    """Longest wait for an update per bucket, in seconds.

    Candidates are the gaps between consecutive updates that end in the bucket
    and the wait from the last update to the end of the bucket. Updates are
    first reduced to one row per second holding the first and last of it (gaps
    inside a second are shorter than the unit), then each hour to its first
    and last update and its longest gap; hours are linked through their edges.
    One pass over the rows, and no task sorts more than an hour of seconds or
    the list of hours.
    """
    span = span or planned_range(config)
    lead = span[0] - timedelta(days=config.freshness_lead_days)
    end = _last_complete(span[0], span[1], config.time_bucket)
    ts = F.col(config.timestamp_column).cast("timestamp")
    rows = _in_range(_monitored(df, config), config.timestamp_column, lead, end)
    seconds = (
        rows.select(ts.alias("_ts"))
        .groupBy(F.date_trunc("second", "_ts").alias("_second"))
        .agg(F.min("_ts").alias("_first"), F.max("_ts").alias("_last"))
        .withColumn("_hour", F.date_trunc("hour", "_second"))
    )

    def wait(since: Column, update: Column) -> Column:
        """The gap before an update, null for the very first one."""
        seconds_since = F.timestamp_diff("SECOND", since, update)
        return F.when(since.isNotNull(), F.struct(seconds_since.alias("_wait"), update.alias("_update")))

    inside = W.partitionBy("_hour").orderBy("_second")
    hours = (
        seconds.withColumn("_gap", wait(F.lag("_last").over(inside), F.col("_first")))
        .groupBy("_hour")
        .agg(F.min("_first").alias("_first"), F.max("_last").alias("_last"), F.max("_gap").alias("_gap"))
    )
    # From here on there is one row per hour of the monitored range.
    along = W.partitionBy(F.lit(0)).orderBy("_hour")
    linked = hours.withColumn("_link", wait(F.lag("_last").over(along), F.col("_first")))
    # Hours never straddle buckets; everything before the range counts as one bucket.
    before_range = moment(lead)
    bucket = F.when(F.col("_hour") < moment(span[0]), before_range).otherwise(
        bucket_start_of(F.col("_hour"), span[0], config.time_bucket)
    )
    by_bucket = linked.groupBy(bucket.alias("bucket_start")).agg(
        F.max("_last").alias("_bucket_last"), F.max(F.greatest("_gap", "_link")).alias("_inside")
    )
    spine = _spine(df, config, span)
    stops = spine.unionByName(
        df.sparkSession.range(1).select(before_range.alias("bucket_start")), allowMissingColumns=True
    )
    up_to = W.partitionBy(F.lit(0)).orderBy("bucket_start").rowsBetween(W.unboundedPreceding, 0)
    carried = (
        stops.join(by_bucket, "bucket_start", "left")
        .withColumn("_end_update", F.max("_bucket_last").over(up_to))
        .where(F.col("bucket_end").isNotNull())
    )
    limit = F.least(F.col("bucket_end"), moment(config.as_of))
    at_end = F.when(
        F.col("_end_update").isNotNull(),
        F.struct(
            F.timestamp_diff("SECOND", F.col("_end_update"), limit).alias("_wait"), F.col("_end_update").alias("_update")
        ),
    )
    worst = F.greatest(F.col("_inside"), at_end)
    result = carried.withColumn("_worst", worst).where(F.col("_worst").isNotNull())
    return _finish(
        result.select(
            "bucket_start",
            "bucket_end",
            F.lit(name).alias("metric_name"),
            F.lit("freshness").alias("metric_type"),
            F.col("_worst._update").cast("string").alias("source_value"),
            F.col("_worst._wait").alias("metric_value"),
        ),
        table, config, False,
    )


def event_freshness_metric(
    df: DataFrame, table: str, config: MonitorConfig, span=None, name: str = "event_freshness"
) -> DataFrame:
    """Longest delay between event and update per bucket; the whole bucket when it is empty."""
    labels = [F.lit(name).alias("metric_name"), F.lit("event_freshness").alias("metric_type")]
    event = F.col(config.event_timestamp_column).cast("timestamp")
    if config.timestamp_column is None:
        delay = F.timestamp_diff("SECOND", F.max(event), moment(config.as_of))
        return _finish(
            _monitored(df, config).agg(delay.alias("metric_value")).select("*", *labels), table, config, False
        )
    span = span or planned_range(config)
    update = F.col(config.timestamp_column).cast("timestamp")
    delays = _covered(df, config, span).groupBy("bucket_start").agg(
        F.max(F.timestamp_diff("SECOND", event, update)).alias("_delay"), F.max(event).alias("_event")
    )
    whole = F.timestamp_diff("SECOND", F.col("bucket_start"), F.col("bucket_end"))
    filled = _spine(df, config, span).join(delays, "bucket_start", "left")
    return _finish(
        filled.select(
            "bucket_start", "bucket_end", F.coalesce("_delay", whole).alias("metric_value"),
            F.col("_event").cast("string").alias("source_value"), *labels,
        ),
        table, config, False,
    )


_TABLE_METRICS = {
    "row_count": row_count_metric,
    "freshness": freshness_metric,
    "event_freshness": event_freshness_metric,
}


def table_metrics(
    df: DataFrame, table: str, config: MonitorConfig, metrics: list[str] | dict[str, str] | None = None, span=None
) -> DataFrame:
    """Union of table metrics; ``metrics`` lists types or maps names to types."""
    chosen = metrics or DEFAULT_MONITORS["table"]
    named = chosen if isinstance(chosen, dict) else {m: m for m in chosen}
    if config.timestamp_column is None:
        named = {k: v for k, v in named.items() if v != "freshness"}
    parts = []
    for name, kind in named.items():
        if kind not in _TABLE_METRICS:
            raise ValueError(f"unsupported table metric {kind!r}")
        parts.append(_TABLE_METRICS[kind](df, table, config, span, name))
    if not parts:
        raise ValueError("no table metric applies")
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


# --- column metrics ------------------------------------------------------------------------


def _count_if(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))


def column_aggregate(metric: str, column: str) -> Column:
    """The aggregate behind one column monitor."""
    value = F.col(f"`{column}`")
    total = F.count(F.lit(1))
    text = value.cast("string")
    missing = value.isNull() | (F.trim(text) == "") | (F.lower(text) == "null")
    null_count = _count_if(value.isNull())
    # A null counts as zero here, and as false in the boolean monitors.
    zero_count = _count_if(value.isNull() | (value.cast("double") == 0))
    aggregates = {
        "null_count": lambda: null_count,
        "null_percent": lambda: percent(null_count, total),
        "not_null_percent": lambda: not_percent(null_count, total),
        "min": lambda: F.min(value.cast("double")),
        "max": lambda: F.max(value.cast("double")),
        "average": lambda: F.avg(value.cast("double")),
        "sum": lambda: F.sum(value.cast("double")),
        "standard_deviation": lambda: F.stddev_samp(value.cast("double")),
        "variance": lambda: F.var_samp(value.cast("double")),
        "zero_count": lambda: zero_count,
        "zero_percent": lambda: percent(zero_count, total),
        "not_zero_percent": lambda: not_percent(zero_count, total),
        "min_length": lambda: F.min(F.length(text)),
        "max_length": lambda: F.max(F.length(text)),
        "average_length": lambda: F.avg(F.length(text)),
        "missing_count": lambda: _count_if(missing),
        "missing_percent": lambda: percent(_count_if(missing), total),
        "not_missing_percent": lambda: not_percent(_count_if(missing), total),
        "count_true": lambda: _count_if(value.cast("boolean")),
        "count_false": lambda: _count_if(~F.coalesce(value.cast("boolean"), F.lit(False))),
    }
    if metric not in aggregates:
        raise ValueError(f"unsupported column metric {metric!r}")
    return aggregates[metric]()


def monitors_for(data_type, chosen: list[str] | None = None) -> list[str]:
    """Monitors that apply to a column type, out of the chosen ones (default: the default set)."""
    kind = type_group(data_type)
    groups = ["any", kind] if kind in ("string", "numeric", "boolean") else ["any"]
    source = AVAILABLE_MONITORS if chosen else DEFAULT_MONITORS
    names = [m for g in groups for m in source[g]]
    return [m for m in names if not chosen or m in chosen]


def wanted_monitors(
    df: DataFrame, columns: dict[str, list[str]] | dict[str, dict[str, str]] | list[str]
) -> list[tuple[str, str, str]]:
    """Column, metric name and metric type of all monitors asked for that apply."""
    if isinstance(columns, list):
        columns = {c: monitors_for(df.schema[c].dataType) for c in columns}
    wanted: list[tuple[str, str, str]] = []
    for column, metrics in columns.items():
        named = metrics if isinstance(metrics, dict) else {m: m for m in metrics}
        allowed = monitors_for(
            df.schema[column].dataType, [m for kind in list(AVAILABLE_MONITORS)[1:] for m in AVAILABLE_MONITORS[kind]]
        )
        for name, kind in named.items():
            if kind in AVAILABLE_MONITORS["table"]:
                raise ValueError(f"{kind!r} is a table metric")
            if kind in allowed:
                wanted.append((column, name, kind))
    if not wanted:
        raise ValueError("no column metric applies")
    return wanted


def _places(wanted: list[tuple[str, str, str]]) -> dict[tuple[str, str], str]:
    return {pair: f"_m{i}" for i, pair in enumerate(sorted({(c, k) for c, _, k in wanted}))}


def monitor_aggregates(wanted: list[tuple[str, str, str]]) -> list[Column]:
    """One aggregate a column and metric type."""
    return [column_aggregate(k, c).cast("double").alias(name) for (c, k), name in _places(wanted).items()]


def unfold_monitors(wide: DataFrame, wanted: list[tuple[str, str, str]], keys: list[str]) -> DataFrame:
    """One row a metric from one column a metric; metrics without a value are left out."""
    place = _places(wanted)
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"), F.lit(n).alias("metric_name"),
                F.lit(k).alias("metric_type"), F.col(place[(c, k)]).alias("metric_value"),
            )
            for c, n, k in wanted
        ]
    )
    return wide.select(*keys, F.inline(cells)).where(F.col("metric_value").isNotNull())


def column_metrics(
    df: DataFrame,
    table: str,
    config: MonitorConfig,
    columns: dict[str, list[str]] | dict[str, dict[str, str]] | list[str],
    span=None,
) -> DataFrame:
    """Column monitors of any number of columns from a single aggregation.

    ``columns`` lists columns (default monitors by type), maps a column to
    metric types, or maps it to metric name -> type. With dimensions the
    metrics are per dimension value.
    """
    wanted = wanted_monitors(df, columns)
    dims = [f"_dim_{d}" for d in config.dimensions]
    rows = _monitored(df, config)
    keys: list[str] = []
    if config.timestamp_column is not None:
        span = span or planned_range(config)
        rows = _covered(df, config, span)
        keys = ["bucket_start"]
    for d, alias in zip(config.dimensions, dims):
        rows = rows.withColumn(alias, F.col(d))
    wide = rows.groupBy(*keys, *dims).agg(*monitor_aggregates(wanted))
    long = unfold_monitors(wide, wanted, [*keys, *dims])
    if dims:
        long = long.withColumn("dimension", F.lit("; ".join(config.dimensions))).withColumn(
            "dimension_value", concat_with_separator(dims)
        ).drop(*dims)
    if keys:
        long = long.withColumn("bucket_end", F.col("bucket_start") + F.expr(f"interval {config.time_bucket.interval}"))
    return _finish(long, table, config, True)


def finish_column_metrics(long: DataFrame, table: str, config: MonitorConfig) -> DataFrame:
    """Metric rows of values by column, name and type that were computed elsewhere."""
    return _finish(long, table, config, True)


def all_columns_metrics(
    df: DataFrame,
    table: str,
    config: MonitorConfig,
    monitors: list[str] | None = None,
    exclude_prefix: str | None = None,
    exclude_regexp: str | None = None,
    span=None,
) -> DataFrame:
    """Column monitors of every column not excluded, still in one aggregation."""
    names = columns_ignoring(df, exclude_prefix, exclude_regexp)
    chosen = {c: monitors_for(df.schema[c].dataType, monitors) for c in names}
    return column_metrics(df, table, config, {c: m for c, m in chosen.items() if m}, span)


# --- dimension metrics ------------------------------------------------------------------------


def dimension_metrics(
    df: DataFrame,
    table: str,
    config: MonitorConfig,
    history: DataFrame | None = None,
    span=None,
    name: str = "dimension",
) -> DataFrame:
    """Rows per dimension value and bucket.

    A value known from the metric history counts 0 in buckets where it is
    absent, from its first appearance on; values whose history is all zero are
    forgotten. A bucket without any row has one metric of 0 without a value.
    """
    if not config.dimensions:
        raise ValueError("dimensions are required")
    value = concat_with_separator(list(config.dimensions)).alias("dimension_value")
    labels = [
        F.lit(name).alias("metric_name"), F.lit("row_count").alias("metric_type"),
        F.lit("; ".join(config.dimensions)).alias("dimension"),
    ]
    known = None
    if history is not None:
        known = (
            history.where(
                (F.col("full_table_name") == table)
                & (F.col("metric_name") == name)
                & (F.col("metric_properties") == config.metric_properties)
                & F.col("dimension_value").isNotNull()
            )
            .groupBy("dimension_value")
            .agg(F.min("bucket_end").alias("_since"), F.sum("metric_value").alias("_total"))
            .where(F.col("_total") > 0)
        )
    if config.timestamp_column is None:
        counts = _monitored(df, config).groupBy(value).agg(F.count(F.lit(1)).alias("metric_value"))
        if known is not None:
            absent = known.join(counts, "dimension_value", "left_anti")
            counts = counts.unionByName(absent.select("dimension_value", F.lit(0).cast("bigint").alias("metric_value")))
        return _finish(counts.select("*", *labels), table, config, True)

    span = span or planned_range(config)
    spine = _spine(df, config, span)
    counts = _covered(df, config, span).groupBy("bucket_start", value).agg(F.count(F.lit(1)).alias("metric_value"))
    step = F.expr(f"interval {config.time_bucket.interval}")
    counts = counts.withColumn("bucket_end", F.col("bucket_start") + step)
    empty = spine.join(counts.select("bucket_start").distinct(), "bucket_start", "left_anti").select(
        "bucket_start", F.lit(None).cast("string").alias("dimension_value"),
        F.lit(0).cast("bigint").alias("metric_value"), "bucket_end",
    )
    rows = counts.unionByName(empty)
    if known is not None:
        starts = F.sequence(moment(span[0]), moment(span[1]), step)
        expected = (
            known.select("dimension_value", "_since", F.explode(starts).alias("bucket_start"))
            .withColumn("bucket_end", F.col("bucket_start") + step)
            .where((F.col("bucket_end") <= moment(span[1])) & (F.col("bucket_end") >= F.col("_since")))
        )
        absent = expected.join(counts, ["bucket_start", "dimension_value"], "left_anti")
        rows = rows.unionByName(
            absent.select("bucket_start", "dimension_value", F.lit(0).cast("bigint").alias("metric_value"), "bucket_end")
        )
    return _finish(rows.select("*", *labels), table, config, True)


# --- collecting and storing ------------------------------------------------------------------------


def collect_metrics(
    df: DataFrame, table: str, config: MonitorConfig, metrics: list[dict], span=None
) -> DataFrame:
    """Custom metrics: ``{"name", "type", "columns"?}`` with one column, a list or ``"*"``."""
    validate_metric_names(metrics)
    table_kinds = set(AVAILABLE_MONITORS["table"])
    column_kinds = {m for k, ms in AVAILABLE_MONITORS.items() if k != "table" for m in ms}
    at_table: dict[str, str] = {}
    at_column: dict[str, dict[str, str]] = {}
    for metric in metrics:
        name, kind, columns = metric["name"], metric["type"], metric.get("columns")
        if columns:
            if kind not in column_kinds:
                raise ValueError(f"{kind!r} is not a column metric")
            chosen = df.columns if columns == "*" else [columns] if isinstance(columns, str) else columns
            for column in chosen:
                at_column.setdefault(column, {})[name] = kind
        else:
            if kind not in table_kinds:
                raise ValueError(f"{kind!r} is not a table metric")
            at_table[name] = kind
    parts = []
    if at_table:
        parts.append(table_metrics(df, table, config, at_table, span))
    if at_column:
        parts.append(column_metrics(df, table, config, at_column, span))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def validate_metric_names(metrics: list[dict], existing: set[str] | None = None) -> None:
    seen = set(existing or ())
    for metric in metrics:
        name = metric.get("name")
        if not name:
            raise ValueError("every metric needs a name")
        if name in seen:
            raise ValueError(f"the metric {name!r} is already defined")
        seen.add(name)


def latest_metrics(metrics: DataFrame) -> DataFrame:
    """One row per metric id, the last updated."""
    return latest_per_key(metrics, ["id"], ["updated_at"])


def merge_metric_store(store: DataFrame | None, new: DataFrame) -> DataFrame:
    """Metric store after a run: the run's metrics replace those of equal id."""
    latest = latest_metrics(new)
    if "created_at" not in latest.columns:
        latest = latest.withColumn("created_at", F.col("updated_at"))
    return latest if store is None else merge_upsert(store, latest, ["id"], "append_new_columns")


def monitor_runs(store: DataFrame) -> DataFrame:
    """Range of buckets per monitored series."""
    return store.groupBy("full_table_name", "column_name", "metric_name", "metric_properties").agg(
        F.max("bucket_end").alias("last_bucket_end"), F.min("bucket_end").alias("first_bucket_end")
    )


def with_overrides(config: MonitorConfig, **changes) -> MonitorConfig:
    return replace(config, **changes)
