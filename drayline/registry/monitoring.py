"""Metric monitoring and anomaly detection over the event table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from drayline.functions import Period
from drayline.operators import anomaly, monitors, observed, resumed
from drayline.operators.chunking import expanding_stats
from drayline.operators.monitors import MonitorConfig
from drayline.registry.base import Tables, query
from drayline.session import cut_lineage, scratch_path
from drayline.sources.tables import PartitionedTable

TABLE = "shop.public.events"
AS_OF = datetime(2024, 1, 31)
DAILY = MonitorConfig(as_of=AS_OF, timestamp_column="ts", days_back=30, backfill_days=7, sensitivity=1.5)
HOURLY = MonitorConfig(
    as_of=AS_OF, timestamp_column="ts", time_bucket=Period("hour", 6), days_back=30, backfill_days=3, sensitivity=2
)

_DAYS = "days AS (SELECT b AS bucket_start, b + INTERVAL 1 DAY AS bucket_end FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30', INTERVAL 1 DAY)) AS b))"
_QUARTERS = "quarters AS (SELECT b AS bucket_start, b + INTERVAL 6 HOUR AS bucket_end FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30 18:00:00', INTERVAL 6 HOUR)) AS b))"


def _round(df: DataFrame, columns: list[str], places: int = 6) -> DataFrame:
    return df.select(*[F.round(c, places).alias(c) if c in columns else F.col(c) for c in df.columns])


def _plain(df: DataFrame, *columns: str) -> DataFrame:
    """Chosen columns with timestamps as the SQL side has them."""
    kinds = dict(df.dtypes)
    return df.select(
        *[F.col(c).cast("timestamp_ntz").alias(c) if kinds[c] == "timestamp" else F.col(c) for c in columns]
    )


# --- metrics ------------------------------------------------------------------------

_PROPERTIES = DAILY.metric_properties.replace("'", "''")


@query(
    "metric_row_count",
    f"WITH {_DAYS} SELECT md5('{TABLE}' || '-' || '' || '-row_count-row_count-' || strftime(bucket_end, '%Y-%m-%d %H:%M:%S') || '-' || '{_PROPERTIES}') AS id, "
    "bucket_start, bucket_end, 24 AS bucket_duration_hours, "
    "CAST((SELECT count(*) FROM events WHERE ts >= bucket_start AND ts < bucket_end) AS DOUBLE) AS metric_value FROM days",
)
def metric_row_count(t: Tables) -> DataFrame:
    found = monitors.row_count_metric(t.events, TABLE, DAILY)
    return _plain(found, "id", "bucket_start", "bucket_end", "bucket_duration_hours", "metric_value")


@query(
    "metric_row_count_filtered",
    f"WITH {_QUARTERS} SELECT bucket_start, CAST((SELECT count(*) FROM events WHERE event_type = 'error' AND value > 40 AND ts >= bucket_start AND ts < bucket_end) AS DOUBLE) AS metric_value FROM quarters",
)
def metric_row_count_filtered(t: Tables) -> DataFrame:
    """A caller's filter and six-hour buckets; empty buckets count 0."""
    config = monitors.with_overrides(HOURLY, where_expression="event_type = 'error' and value > 40")
    return _plain(monitors.row_count_metric(t.events, TABLE, config), "bucket_start", "metric_value")


@query("metric_row_count_total", "SELECT CAST(count(*) AS DOUBLE) AS metric_value, TIMESTAMP '2024-01-31' AS bucket_end FROM lineitem")
def metric_row_count_total(t: Tables) -> DataFrame:
    found = monitors.row_count_metric(t.lineitem, "lineitem", MonitorConfig(as_of=AS_OF))
    return _plain(found, "metric_value", "bucket_end")


def _bucket_sql(width_hours: int) -> str:
    return f"TIMESTAMP '2024-01-01' + CAST(floor(date_sub('second', TIMESTAMP '2024-01-01', ts) / {width_hours * 3600}) AS INT) * INTERVAL {width_hours} HOUR"


@query(
    "metric_bucket_assignment",
    f"SELECT event_id, {_bucket_sql(168)} AS week_start, {_bucket_sql(30)} AS thirty_hours, date_trunc('month', ts) AS month_start FROM events",
)
def metric_bucket_assignment(t: Tables) -> DataFrame:
    start = datetime(2024, 1, 1)
    ts = F.col("ts").cast("timestamp")
    found = t.events.select(
        "event_id",
        monitors.bucket_start_of(ts, start, Period("week", 1)).alias("week_start"),
        monitors.bucket_start_of(ts, start, Period("hour", 30)).alias("thirty_hours"),
        monitors.bucket_start_of(ts, start, Period("month", 1)).alias("month_start"),
    )
    return _plain(found, *found.columns)


def _freshness_sql(spine: str, name: str, start: str, where: str) -> str:
    return (
        f"WITH {spine}, u AS (SELECT DISTINCT ts FROM events WHERE {where} AND ts >= TIMESTAMP '{start}' - INTERVAL 7 DAY), "
        "gaps AS (SELECT ts, date_sub('second', lag(ts) OVER (ORDER BY ts), ts) AS wait FROM u), "
        f"candidates AS (SELECT bucket_start, bucket_end, ts, wait FROM {name} JOIN gaps ON ts >= bucket_start AND ts < bucket_end "
        "UNION ALL SELECT bucket_start, bucket_end, max(ts), date_sub('second', max(ts), bucket_end) "
        f"FROM {name} JOIN u ON ts < bucket_end GROUP BY 1, 2) "
        "SELECT bucket_start, CAST(wait AS DOUBLE) AS metric_value FROM (SELECT *, row_number() OVER (PARTITION BY bucket_end ORDER BY wait DESC NULLS LAST, ts DESC) AS rn FROM candidates) WHERE rn = 1"
    )


@query("metric_freshness", _freshness_sql(_DAYS, "days", "2024-01-01", "true"))
def metric_freshness(t: Tables) -> DataFrame:
    return _plain(monitors.freshness_metric(t.events, TABLE, DAILY), "bucket_start", "metric_value")


@query("metric_freshness_sparse", _freshness_sql(_QUARTERS, "quarters", "2024-01-01", "event_type = 'signup' AND value > 80"))
def metric_freshness_sparse(t: Tables) -> DataFrame:
    """Few updates: most buckets wait for one that came long before."""
    config = monitors.with_overrides(HOURLY, where_expression="event_type = 'signup' and value > 80")
    return _plain(monitors.freshness_metric(t.events, TABLE, config), "bucket_start", "metric_value")


@query(
    "metric_event_freshness",
    f"WITH {_QUARTERS} SELECT bucket_start, CAST(coalesce(max(date_sub('second', ts - CAST(event_id % 500 AS INT) * INTERVAL 1 MINUTE, ts)), 21600) AS DOUBLE) AS metric_value "
    "FROM quarters LEFT JOIN events e ON ts >= bucket_start AND ts < bucket_end GROUP BY 1",
)
def metric_event_freshness(t: Tables) -> DataFrame:
    """Delay between event and load; an empty bucket counts with its whole length."""
    rows = t.events.withColumn(
        "happened_at", F.timestamp_add("MINUTE", -(F.col("event_id") % 500).cast("int"), F.col("ts"))
    )
    config = monitors.with_overrides(HOURLY, event_timestamp_column="happened_at")
    return _plain(monitors.event_freshness_metric(rows, TABLE, config), "bucket_start", "metric_value")


@query(
    "metric_event_freshness_total",
    "SELECT CAST(date_sub('second', max(ts), TIMESTAMP '2024-01-31') AS DOUBLE) AS metric_value FROM events",
)
def metric_event_freshness_total(t: Tables) -> DataFrame:
    config = MonitorConfig(as_of=AS_OF, event_timestamp_column="ts")
    return monitors.event_freshness_metric(t.events, TABLE, config).select("metric_value")


def _long(parts: dict[str, str], source: str, keys: str = "") -> str:
    """UNION ALL of one aggregate per metric."""
    head = f"{keys}, " if keys else ""
    group = f" GROUP BY {keys}" if keys else ""
    return " UNION ALL ".join(
        f"SELECT {head}'{name}' AS metric_name, round(CAST({value} AS DOUBLE), 6) AS metric_value FROM ({source}){group}"
        for name, value in parts.items()
    )


_NUMERIC = {
    "null_count": "count(*) - count(v)",
    "null_percent": "floor((count(*) - count(v)) / count(*) * 100 * 1000 + 0.5) / 1000",
    "not_null_percent": "floor((100 - (count(*) - count(v)) / count(*) * 100) * 1000 + 0.5) / 1000",
    "min": "min(v)",
    "max": "max(v)",
    "average": "avg(v)",
    "sum": "sum(v)",
    "standard_deviation": "stddev_samp(v)",
    "variance": "var_samp(v)",
    "zero_count": "count(*) FILTER (v IS NULL OR v = 0)",
    "zero_percent": "floor(count(*) FILTER (v IS NULL OR v = 0) / count(*) * 100 * 1000 + 0.5) / 1000",
    "not_zero_percent": "floor((100 - count(*) FILTER (v IS NULL OR v = 0) / count(*) * 100) * 1000 + 0.5) / 1000",
}
_VALUES = "CASE WHEN event_id % 10 = 0 THEN NULL WHEN event_id % 10 = 1 THEN 0 ELSE value END"


def _gappy(t: Tables) -> DataFrame:
    tenth = F.col("event_id") % 10
    value = F.when(tenth == 0, None).when(tenth == 1, 0.0).otherwise(F.col("value"))
    return t.events.select("ts", "user_id", "event_type", value.alias("v"))


@query(
    "metric_numeric_column",
    _long(_NUMERIC, f"SELECT CAST(ts AS DATE) AS day, {_VALUES} AS v FROM events", "day"),
)
def metric_numeric_column(t: Tables) -> DataFrame:
    """All numeric monitors per day from one aggregation."""
    found = monitors.column_metrics(_gappy(t), TABLE, DAILY, {"v": list(_NUMERIC)})
    return found.select(F.col("bucket_start").cast("date").alias("day"), "metric_name", F.round("metric_value", 6).alias("metric_value"))


_STRING = {
    "null_count": "count(*) - count(s)",
    "min_length": "min(length(s))",
    "max_length": "max(length(s))",
    "average_length": "avg(length(s))",
    "missing_count": "count(*) FILTER (s IS NULL OR trim(s) = '' OR lower(s) = 'null')",
    "missing_percent": "floor(count(*) FILTER (s IS NULL OR trim(s) = '' OR lower(s) = 'null') / count(*) * 100 * 1000 + 0.5) / 1000",
    "not_missing_percent": "floor((100 - count(*) FILTER (s IS NULL OR trim(s) = '' OR lower(s) = 'null') / count(*) * 100) * 1000 + 0.5) / 1000",
}


@query(
    "metric_string_column",
    _long(
        _STRING,
        "SELECT event_type, (['a', 'bcd', NULL, ' ', 'null', 'NULL', ' a '])[CAST(event_id % 7 AS INT) + 1] AS s FROM events",
        "event_type",
    ),
)
def metric_string_column(t: Tables) -> DataFrame:
    """String monitors per dimension value, without time buckets."""
    texts = F.array(*[F.lit(x) for x in ("a", "bcd", None, " ", "null", "NULL", " a ")])
    rows = t.events.select("event_type", F.element_at(texts, (F.col("event_id") % 7).cast("int") + 1).alias("s"))
    config = MonitorConfig(as_of=AS_OF, dimensions=("event_type",))
    found = monitors.column_metrics(rows, TABLE, config, {"s": list(_STRING)})
    return found.select(F.col("dimension_value").alias("event_type"), "metric_name", F.round("metric_value", 6).alias("metric_value"))


@query(
    "metric_boolean_column",
    _long(
        {"count_true": "count(*) FILTER (b)", "count_false": "count(*) FILTER (b IS NULL OR NOT b)"},
        "SELECT CASE WHEN l_quantity < 40 THEN l_discount > 0.05 END AS b FROM lineitem",
    ),
)
def metric_boolean_column(t: Tables) -> DataFrame:
    """A null counts as false."""
    rows = t.lineitem.select(F.when(F.col("l_quantity") < 40, F.col("l_discount") > 0.05).alias("b"))
    found = monitors.column_metrics(rows, "lineitem", MonitorConfig(as_of=AS_OF), {"b": ["count_true", "count_false"]})
    return found.select("metric_name", "metric_value")


_ALL_COLUMNS = (
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, metric_name, metric_value FROM ("
        + _long({k: v.replace("v IS NULL OR v = 0", f"{c} IS NULL OR {c} = 0").replace("(v)", f"({c})") for k, v in _NUMERIC.items() if k in ("null_count", "min", "max", "zero_count")}, "SELECT * FROM customer")
        + ")"
        for c in ("c_nationkey", "c_acctbal")
    )
    + " UNION ALL SELECT 'c_mktsegment', metric_name, metric_value FROM ("
    + _long({"null_count": "count(*) - count(c_mktsegment)", "min_length": "min(length(c_mktsegment))"}, "SELECT * FROM customer")
    + ")"
)


@query("metric_all_columns", _ALL_COLUMNS)
def metric_all_columns(t: Tables) -> DataFrame:
    """Chosen monitors of all columns but the excluded, by type, in one aggregation."""
    chosen = ["null_count", "min", "max", "zero_count", "min_length"]
    found = monitors.all_columns_metrics(
        t.customer, "customer", MonitorConfig(as_of=AS_OF), chosen, exclude_prefix="c_cust", exclude_regexp=".*name"
    )
    return found.select("column_name", "metric_name", F.round("metric_value", 6).alias("metric_value"))


@query("metric_observed_on_write", _ALL_COLUMNS)
def metric_observed_on_write(t: Tables) -> DataFrame:
    """The same metrics from the rows as they are appended to a partitioned table."""
    chosen = ["null_count", "min", "max", "zero_count", "min_length"]
    columns = observed.chosen_columns(t.customer, chosen, exclude_prefix="c_cust", exclude_regexp=".*name")
    watched = observed.ObservedMetrics("customer", MonitorConfig(as_of=AS_OF), columns)
    PartitionedTable(t.spark, scratch_path(t.spark, "observed"), ["c_mktsegment"]).append(t.customer, watched.watch)
    return watched.metrics().select("column_name", "metric_name", F.round("metric_value", 6).alias("metric_value"))


_HISTORY_CUT = "2024-01-16"


def _dimension_history(t: Tables) -> DataFrame:
    """Metrics of the first half, in which one kind of event is known under another name."""
    early = _renamed(t).where(F.col("ts") < F.lit(_HISTORY_CUT).cast("timestamp_ntz"))
    first_half = monitors.with_overrides(_BY_TYPE, as_of=datetime(2024, 1, 16), days_back=15)
    return monitors.dimension_metrics(early, TABLE, first_half)


def _renamed(t: Tables) -> DataFrame:
    old = (F.col("ts") < F.lit(_HISTORY_CUT).cast("timestamp_ntz")) & (F.col("event_type") == "view")
    return t.events.withColumn("kind", F.when(old, "page_view").otherwise(F.col("event_type")))


_BY_TYPE = monitors.with_overrides(DAILY, dimensions=("kind",))


@query(
    "metric_dimension",
    f"WITH {_DAYS}, e AS (SELECT CAST(ts AS DATE) AS day, CASE WHEN ts < TIMESTAMP '{_HISTORY_CUT}' AND event_type = 'view' THEN 'page_view' ELSE event_type END AS kind FROM events), "
    "counts AS (SELECT day, kind, count(*) AS n FROM e GROUP BY 1, 2) "
    "SELECT day, kind AS dimension_value, CAST(n AS DOUBLE) AS metric_value FROM counts UNION ALL "
    f"SELECT CAST(bucket_start AS DATE), k.kind, 0 FROM days, (SELECT kind, min(day) AS since FROM counts WHERE day < DATE '{_HISTORY_CUT}' GROUP BY 1) k "
    "WHERE CAST(bucket_start AS DATE) >= k.since AND NOT EXISTS (SELECT 1 FROM counts c WHERE c.kind = k.kind AND c.day = CAST(bucket_start AS DATE))",
)
def metric_dimension(t: Tables) -> DataFrame:
    """Values that stop occurring count 0 from then on."""
    found = monitors.dimension_metrics(_renamed(t), TABLE, _BY_TYPE, _dimension_history(t))
    return found.select(F.col("bucket_start").cast("date").alias("day"), "dimension_value", "metric_value")


@query(
    "metric_dimension_pair",
    "SELECT coalesce(l_returnflag, 'NULL') || '; ' || l_linestatus AS dimension_value, CAST(count(*) AS DOUBLE) AS metric_value FROM lineitem GROUP BY 1",
)
def metric_dimension_pair(t: Tables) -> DataFrame:
    config = MonitorConfig(as_of=AS_OF, dimensions=("l_returnflag", "l_linestatus"))
    return monitors.dimension_metrics(t.lineitem, "lineitem", config).select("dimension_value", "metric_value")


@query(
    "collected_metrics",
    "SELECT 'rows' AS metric_name, NULL AS column_name, CAST(count(*) AS DOUBLE) AS metric_value FROM orders "
    "UNION ALL SELECT 'longest', 'o_orderstatus', max(length(o_orderstatus)) FROM orders UNION ALL SELECT 'longest', 'o_orderpriority', max(length(o_orderpriority)) FROM orders "
    "UNION ALL SELECT 'top', 'o_totalprice', max(o_totalprice) FROM orders",
)
def collected_metrics(t: Tables) -> DataFrame:
    """Named metrics of a table and of its columns."""
    wanted = [
        {"name": "rows", "type": "row_count"},
        {"name": "longest", "type": "max_length", "columns": ["o_orderstatus", "o_orderpriority"]},
        {"name": "top", "type": "max", "columns": "o_totalprice"},
    ]
    found = monitors.collect_metrics(t.orders, "orders", MonitorConfig(as_of=AS_OF), wanted)
    return found.select("metric_name", "column_name", "metric_value")


@query(
    "metric_store_merge",
    f"WITH {_DAYS} SELECT bucket_start, CAST((SELECT count(*) FROM events WHERE ts >= bucket_start AND ts < bucket_end "
    "AND (bucket_start >= TIMESTAMP '2024-01-25' OR event_id % 2 = 0)) AS DOUBLE) AS metric_value FROM days",
)
def metric_store_merge(t: Tables) -> DataFrame:
    """Stored metrics of half the rows; the last days are recomputed from all rows and replace them."""
    stored = monitors.merge_metric_store(
        None, monitors.row_count_metric(t.events.where(F.col("event_id") % 2 == 0), TABLE, DAILY)
    )
    fresh = monitors.row_count_metric(t.events, TABLE, DAILY, (datetime(2024, 1, 25), AS_OF))
    return _plain(monitors.merge_metric_store(stored, fresh), "bucket_start", "metric_value")


@query(
    "metric_planned_range",
    "SELECT TIMESTAMP '2024-01-10' AS planned_start, TIMESTAMP '2024-01-31' AS planned_end, count(DISTINCT CAST(ts AS DATE)) AS stored_days "
    "FROM events WHERE CAST(ts AS DATE) <> DATE '2024-01-10' AND ts < TIMESTAMP '2024-01-28'",
)
def metric_planned_range(t: Tables) -> DataFrame:
    """One day is missing in the store: recomputation starts there."""
    store = monitors.row_count_metric(t.events, TABLE, DAILY).where(
        (F.col("bucket_start") != F.lit("2024-01-10").cast("timestamp")) & (F.col("bucket_end") <= F.lit("2024-01-28").cast("timestamp"))
    )
    start, end = monitors.planned_range(DAILY, store, full_table_name=TABLE)
    return store.agg(F.count(F.lit(1)).alias("stored_days")).select(
        F.lit(str(start)).cast("timestamp_ntz").alias("planned_start"), F.lit(str(end)).cast("timestamp_ntz").alias("planned_end"), "stored_days"
    )


@query(
    "monitor_runs",
    "SELECT 'event_type' AS dimension, event_type AS metric_name, CAST(max(CAST(ts AS DATE)) + 1 AS TIMESTAMP) AS last_bucket_end, CAST(min(CAST(ts AS DATE)) + 1 AS TIMESTAMP) AS first_bucket_end FROM events GROUP BY 2",
)
def monitor_runs(t: Tables) -> DataFrame:
    by_type = monitors.with_overrides(DAILY, dimensions=("event_type",))
    store = monitors.dimension_metrics(t.events, TABLE, by_type).where(F.col("dimension_value").isNotNull())
    found = monitors.monitor_runs(store.withColumn("metric_name", F.col("dimension_value")))
    return _plain(found.withColumn("dimension", F.lit("event_type")), "dimension", "metric_name", "last_bucket_end", "first_bucket_end")


# --- scores and decisions --------------------------------------------------------------

_COUNTS = f"{_DAYS}, m AS (SELECT bucket_start, bucket_end, CAST((SELECT count(*) FROM events WHERE ts >= bucket_start AND ts < bucket_end) AS DOUBLE) AS v FROM days)"
_SCORED = (
    "s AS (SELECT *, avg(v) OVER w AS mean, stddev_samp(v) OVER w AS spread, count(v) OVER w AS n FROM m WINDOW w AS ({by}ORDER BY bucket_end ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)), "
    "z AS (SELECT *, CASE WHEN spread IS NULL THEN NULL WHEN spread = 0 THEN 0 ELSE (v - mean) / spread END AS score FROM s)"
)


@query(
    "anomaly_scores",
    f"WITH {_COUNTS}, {_SCORED.format(by='')} SELECT bucket_start, round(score, 6) AS anomaly_score, round(mean, 6) AS training_avg, round(spread, 6) AS training_stddev, "
    "n AS training_set_size, CASE WHEN spread IS NULL THEN NULL ELSE round(greatest(mean - 1.5 * spread, 0), 6) END AS min_metric_value, round(mean + 1.5 * spread, 6) AS max_metric_value FROM z",
)
def anomaly_scores(t: Tables) -> DataFrame:
    scores = anomaly.anomaly_scores(monitors.row_count_metric(t.events, TABLE, DAILY), TABLE, DAILY)
    names = ["anomaly_score", "training_avg", "training_stddev", "min_metric_value", "max_metric_value"]
    return _round(_plain(scores, "bucket_start", "training_set_size", *names), names)


@query(
    "volume_anomalies",
    f"WITH {_COUNTS}, {_SCORED.format(by='')}, a AS (SELECT *, coalesce(abs(score) > 1.5 AND bucket_end > TIMESTAMP '2024-01-24', false) AS bad, greatest(mean - 1.5 * spread, 0) AS low, mean + 1.5 * spread AS high FROM z) "
    "SELECT bucket_end, bad AS is_anomalous, round(CASE WHEN spread IS NULL AND NOT bad THEN NULL WHEN bad THEN lag(low) OVER (ORDER BY bucket_end) ELSE low END, 6) AS min_value, "
    "round(CASE WHEN bad THEN lag(high) OVER (ORDER BY bucket_end) ELSE high END, 6) AS max_value FROM a",
)
def volume_anomalies(t: Tables) -> DataFrame:
    found = anomaly.volume_anomalies(t.events, TABLE, DAILY)
    return _round(_plain(found, "bucket_end", "is_anomalous", "min_value", "max_value"), ["min_value", "max_value"])


_LAST_WEEK = "bucket_end > TIMESTAMP '2024-01-24'"


@query(
    "volume_drops_ignoring_small",
    f"WITH {_COUNTS}, {_SCORED.format(by='')} SELECT bucket_end, coalesce(score < -0.5 AND v < 0.95 * mean AND {_LAST_WEEK}, false) AS is_anomalous, "
    "round(CASE WHEN spread IS NULL THEN NULL ELSE greatest(least(0.95 * mean, mean - 0.5 * spread), 0) END, 6) AS min_metric_value FROM z",
)
def volume_drops_ignoring_small(t: Tables) -> DataFrame:
    """Only drops of more than five percent."""
    config = monitors.with_overrides(DAILY, sensitivity=0.5, direction="drop", drop_failure_percent_threshold=5)
    found = anomaly.volume_anomalies(t.events, TABLE, config)
    return _round(_plain(found, "bucket_end", "is_anomalous", "min_metric_value"), ["min_metric_value"])


@query(
    "volume_excluding_weekends",
    f"WITH {_DAYS}, m AS (SELECT bucket_start, bucket_end, CAST((SELECT count(*) FROM events WHERE ts >= bucket_start AND ts < bucket_end) AS DOUBLE) AS v FROM days WHERE isodow(bucket_start) < 6), "
    f"{_SCORED.format(by='')} SELECT bucket_end, n AS training_set_size, round(score, 6) AS anomaly_score FROM z WHERE n >= 3",
)
def volume_excluding_weekends(t: Tables) -> DataFrame:
    """Some buckets neither train nor score, and the first results are dropped."""
    config = monitors.with_overrides(
        DAILY, anomaly_exclude_metrics="weekday(metric_date) >= 5", exclude_final_results="training_set_size >= 3"
    )
    found = anomaly.volume_anomalies(t.events, TABLE, config)
    return _round(_plain(found, "bucket_end", "training_set_size", "anomaly_score"), ["anomaly_score"])


@query(
    "volume_by_weekday",
    f"WITH {_COUNTS}, {_SCORED.format(by='PARTITION BY dayname(bucket_end) ')} SELECT bucket_end, dayname(bucket_end) AS bucket_seasonality, n AS training_set_size, round(score, 6) AS anomaly_score FROM z",
)
def volume_by_weekday(t: Tables) -> DataFrame:
    """Each weekday has its own training set, over seven times the range."""
    config = monitors.with_overrides(DAILY, seasonality="day_of_week", days_back=5)
    # The configured range starts before the data; score the days that have data.
    own = monitors.row_count_metric(t.events, TABLE, DAILY)
    scores = anomaly.detect_anomalies(anomaly.anomaly_scores(own, TABLE, config), config)
    return _round(_plain(scores, "bucket_end", "bucket_seasonality", "training_set_size", "anomaly_score"), ["anomaly_score"])


@query(
    "volume_by_hour_of_day",
    "WITH hours AS (SELECT b AS bucket_start, b + INTERVAL 1 HOUR AS bucket_end FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30 23:00:00', INTERVAL 1 HOUR)) AS b)), "
    "m AS (SELECT bucket_start, bucket_end, CAST(count(ts) AS DOUBLE) AS v FROM hours LEFT JOIN events ON date_trunc('hour', ts) = bucket_start GROUP BY 1, 2), "
    f"{_SCORED.format(by='PARTITION BY hour(bucket_end) ')} SELECT bucket_end, CAST(hour(bucket_end) AS VARCHAR) AS bucket_seasonality, round(score, 6) AS anomaly_score, round(mean, 6) AS training_avg FROM z",
)
def volume_by_hour_of_day(t: Tables) -> DataFrame:
    config = monitors.with_overrides(DAILY, time_bucket=Period("hour", 1), seasonality="hour_of_day")
    found = anomaly.volume_anomalies(t.events, TABLE, config)
    return _round(_plain(found, "bucket_end", "bucket_seasonality", "anomaly_score", "training_avg"), ["anomaly_score", "training_avg"])


@query(
    "freshness_anomalies",
    _freshness_sql(_QUARTERS, "quarters", "2024-01-01", "TRUE").replace("SELECT bucket_start, CAST(wait AS DOUBLE) AS metric_value FROM", "SELECT bucket_start, bucket_end, CAST(wait AS DOUBLE) AS v FROM").replace("WITH ", "WITH m AS (WITH ", 1)
    + f"), {_SCORED.format(by='')} SELECT bucket_end, v AS metric_value, coalesce(score > 2 AND bucket_end > TIMESTAMP '2024-01-28', false) AS is_anomalous FROM z",
)
def freshness_anomalies(t: Tables) -> DataFrame:
    """Only a longer wait is an anomaly."""
    found = anomaly.freshness_anomalies(t.events, TABLE, HOURLY)
    return _plain(found, "bucket_end", "metric_value", "is_anomalous")


@query(
    "event_freshness_anomalies",
    f"WITH {_QUARTERS}, m AS (SELECT bucket_start, bucket_end, CAST(coalesce(max(date_sub('second', ts - CAST(event_id % 500 AS INT) * INTERVAL 1 MINUTE, ts)), 21600) AS DOUBLE) AS v "
    f"FROM quarters LEFT JOIN events e ON ts >= bucket_start AND ts < bucket_end GROUP BY 1, 2), {_SCORED.format(by='')} "
    "SELECT bucket_end, v AS metric_value, coalesce(score > 1 AND bucket_end > TIMESTAMP '2024-01-28', false) AS is_anomalous FROM z",
)
def event_freshness_anomalies(t: Tables) -> DataFrame:
    rows = t.events.withColumn(
        "happened_at", F.timestamp_add("MINUTE", -(F.col("event_id") % 500).cast("int"), F.col("ts"))
    )
    config = monitors.with_overrides(HOURLY, event_timestamp_column="happened_at", sensitivity=1)
    return _plain(anomaly.event_freshness_anomalies(rows, TABLE, config), "bucket_end", "metric_value", "is_anomalous")


@query(
    "column_anomalies",
    f"WITH m AS (SELECT CAST(ts AS DATE) AS bucket_start, CAST(CAST(ts AS DATE) + 1 AS TIMESTAMP) AS bucket_end, CAST(count(*) - count(v) AS DOUBLE) AS v FROM (SELECT ts, {_VALUES} AS v FROM events) GROUP BY 1, 2), "
    f"{_SCORED.format(by='')} SELECT bucket_end, v AS metric_value, round(score, 6) AS anomaly_score, coalesce(abs(score) > 1.5 AND {_LAST_WEEK}, false) AS is_anomalous FROM z",
)
def column_anomalies(t: Tables) -> DataFrame:
    found = anomaly.column_anomalies(_gappy(t), TABLE, DAILY, "v", ["null_count"])
    return _round(_plain(found, "bucket_end", "metric_value", "anomaly_score", "is_anomalous"), ["anomaly_score"])


@query(
    "column_anomalies_by_dimension",
    "WITH m AS (SELECT event_type, CAST(CAST(ts AS DATE) + 1 AS TIMESTAMP) AS bucket_end, max(value) AS v FROM events GROUP BY 1, 2), "
    f"{_SCORED.format(by='PARTITION BY event_type ')} SELECT event_type AS dimension_value, bucket_end, round(score, 6) AS anomaly_score, coalesce(score > 1.5 AND {_LAST_WEEK}, false) AS is_anomalous FROM z",
)
def column_anomalies_by_dimension(t: Tables) -> DataFrame:
    config = monitors.with_overrides(DAILY, dimensions=("event_type",), direction="spike")
    found = anomaly.column_anomalies(t.events, TABLE, config, "value", ["max"])
    return _round(_plain(found, "dimension_value", "bucket_end", "anomaly_score", "is_anomalous"), ["anomaly_score"])


@query(
    "all_columns_anomalies",
    "WITH m AS (SELECT CAST(CAST(ts AS DATE) + 1 AS TIMESTAMP) AS bucket_end, c AS column_name, v FROM ("
    "SELECT CAST(ts AS DATE) AS ts, 'user_id' AS c, CAST(max(user_id) AS DOUBLE) AS v FROM events GROUP BY 1 UNION ALL "
    "SELECT CAST(ts AS DATE), 'value', max(value) FROM events GROUP BY 1)), "
    f"{_SCORED.format(by='PARTITION BY column_name ')} SELECT column_name, bucket_end, round(score, 6) AS anomaly_score, coalesce(abs(score) > 1.5 AND {_LAST_WEEK}, false) AS is_anomalous FROM z",
)
def all_columns_anomalies(t: Tables) -> DataFrame:
    found = anomaly.all_columns_anomalies(t.events, TABLE, DAILY, ["max"], exclude_prefix="event_")
    return _round(_plain(found, "column_name", "bucket_end", "anomaly_score", "is_anomalous"), ["anomaly_score"])


@query(
    "dimension_anomalies",
    "WITH m AS (SELECT event_type, CAST(CAST(ts AS DATE) + 1 AS TIMESTAMP) AS bucket_end, CAST(count(*) AS DOUBLE) AS v FROM events GROUP BY 1, 2), "
    f"{_SCORED.format(by='PARTITION BY event_type ')} SELECT event_type AS dimension_value, bucket_end, v AS metric_value, coalesce(abs(score) > 1.5 AND {_LAST_WEEK}, false) AS is_anomalous FROM z",
)
def dimension_anomalies(t: Tables) -> DataFrame:
    config = monitors.with_overrides(DAILY, dimensions=("event_type",))
    found = anomaly.dimension_anomalies(t.events, TABLE, config)
    return _plain(found.where(F.col("dimension_value").isNotNull()), "dimension_value", "bucket_end", "metric_value", "is_anomalous")


@query(
    "volume_anomalies_incremental",
    f"WITH {_COUNTS}, {_SCORED.format(by='')} SELECT bucket_end, v AS metric_value, round(score, 6) AS anomaly_score, coalesce(abs(score) > 1.5 AND {_LAST_WEEK}, false) AS is_anomalous FROM z",
)
def volume_anomalies_incremental(t: Tables) -> DataFrame:
    """History from the metric store, the last days computed anew: same result as from scratch."""
    early = t.events.where(F.col("ts") < F.lit("2024-01-27").cast("timestamp_ntz"))
    before = monitors.with_overrides(DAILY, as_of=datetime(2024, 1, 27), days_back=26)
    store = monitors.merge_metric_store(None, monitors.row_count_metric(early, TABLE, before))
    found = anomaly.volume_anomalies(t.events, TABLE, DAILY, store)
    return _round(_plain(found, "bucket_end", "metric_value", "anomaly_score", "is_anomalous"), ["anomaly_score"])


@query(
    "anomaly_test_results",
    f"WITH {_COUNTS}, {_SCORED.format(by='')} SELECT '{TABLE}' AS full_table_name, 'row_count' AS metric_name, count(score) AS scored_points, "
    f"count(*) FILTER (abs(score) > 1.5 AND {_LAST_WEEK}) AS failures, "
    f"CASE WHEN count(*) FILTER (abs(score) > 1.5 AND {_LAST_WEEK}) > 0 THEN 'fail' ELSE 'pass' END AS status FROM z",
)
def anomaly_test_results(t: Tables) -> DataFrame:
    found = anomaly.anomaly_test_results(anomaly.volume_anomalies(t.events, TABLE, DAILY))
    return found.select("full_table_name", "metric_name", "scored_points", "failures", "status")


@query(
    "anomaly_descriptions",
    f"WITH {_COUNTS}, {_SCORED.format(by='')} SELECT bucket_end, 'The last row_count value is ' || printf('%.3f', v) || '. The average for this metric is ' || printf('%.3f', mean) || '.' AS anomaly_description FROM z",
)
def anomaly_descriptions(t: Tables) -> DataFrame:
    return _plain(anomaly.volume_anomalies(t.events, TABLE, DAILY), "bucket_end", "anomaly_description")


_RECENT = "z2 AS (SELECT * FROM z WHERE bucket_end >= TIMESTAMP '2024-01-24')"


_STORE_SCORES = (
    f"WITH {_COUNTS}, {_SCORED.format(by='')}, {_RECENT} SELECT bucket_end, v AS latest_metric_value, "
    "round(score, 6) AS anomaly_score, n AS training_set_size, abs(score) > 1 AS is_anomaly FROM z2"
)


def _store_scores(t: Tables, **options) -> DataFrame:
    store = monitors.merge_metric_store(None, monitors.row_count_metric(t.events, TABLE, DAILY))
    found = anomaly.metrics_anomaly_score(store, AS_OF, sensitivity=1, **options)
    return _round(_plain(found, "bucket_end", "latest_metric_value", "anomaly_score", "training_set_size", "is_anomaly"), ["anomaly_score"])


@query("metrics_anomaly_score", _STORE_SCORES)
def metrics_anomaly_score(t: Tables) -> DataFrame:
    return _store_scores(t)


@query("metrics_anomaly_score_split_keys", _STORE_SCORES)
def metrics_anomaly_score_split_keys(t: Tables) -> DataFrame:
    """The same with the series treated as too long for one task."""
    return _store_scores(t, rows_per_chunk=7)


@query("anomaly_scores_resumed", _STORE_SCORES)
def anomaly_scores_resumed(t: Tables) -> DataFrame:
    """Metrics scored in three runs from stored moments, one bucket of the first third only in the last run."""
    store = monitors.merge_metric_store(None, monitors.row_count_metric(t.events, TABLE, DAILY))
    day = F.dayofmonth("bucket_start")
    turn = F.when(day == 7, 2).otherwise(F.least(F.floor((day - 1) / 10), F.lit(2)))
    store = cut_lineage(store.withColumn("_turn", turn), "metrics")
    state, scores = None, None
    for n in range(3):
        new, known = (store.where(c).drop("_turn") for c in (F.col("_turn") == n, F.col("_turn") <= n))
        trained, state = resumed.resume_scores(new, known, state)
        found = resumed.resumed_anomaly_score(trained, AS_OF, sensitivity=1)
        scores = found if scores is None else scores.join(found.select("id"), "id", "left_anti").unionByName(found)
    return _round(_plain(scores, "bucket_end", "latest_metric_value", "anomaly_score", "training_set_size", "is_anomaly"), ["anomaly_score"])


@query(
    "running_stats_with_nan",
    "WITH v AS (SELECT event_id, event_type, ts, CASE WHEN event_id % 97 <> 0 THEN value END AS x, CAST(event_id % 97 = 0 AS INT) AS odd FROM events), "
    "s AS (SELECT event_id, avg(x) OVER w AS mean, stddev_samp(x) OVER w AS spread, max(odd) OVER w = 1 AS bad, "
    "sum(CASE WHEN odd = 1 OR x IS NOT NULL THEN 1 ELSE 0 END) OVER w AS n FROM v "
    "WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) "
    "SELECT event_id, CASE WHEN NOT bad THEN round(mean / 7, 6) END AS training_avg, CASE WHEN NOT bad THEN round(spread / 7, 6) END AS training_stddev, "
    "bad AS avg_is_nan, bad AND n > 1 AS stddev_is_nan, CAST(n AS BIGINT) AS training_set_size FROM s",
)
def running_stats_with_nan(t: Tables) -> DataFrame:
    """A series with values that are no numbers, cut into many chunks: the same as one window."""
    value = F.when(F.col("event_id") % 97 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    rows = t.events.select("event_id", "event_type", "ts", value.alias("v"))
    found = expanding_stats(rows, ["event_type"], ["ts", "event_id"], "v", rows_per_chunk=300)
    number = lambda c: F.when(~F.isnan(c), F.round(F.col(c) / 7, 6)).alias(c)  # noqa: E731  a seventh of cents never lies on a half
    return found.select(
        "event_id", number("training_avg"), number("training_stddev"), F.isnan("training_avg").alias("avg_is_nan"),
        F.coalesce(F.isnan("training_stddev"), F.lit(False)).alias("stddev_is_nan"), "training_set_size",
    )


@query(
    "anomaly_threshold_sensitivity",
    "WITH m AS (SELECT event_type, CAST(CAST(ts AS DATE) + 1 AS TIMESTAMP) AS bucket_end, max(value) AS v FROM events GROUP BY 1, 2), "
    f"{_SCORED.format(by='PARTITION BY event_type ')}, {_RECENT} SELECT event_type AS metric_name, round(score, 6) AS anomaly_score, abs(score) >= 1.5 AS is_anomaly_1_5, abs(score) >= 2 AS is_anomaly_2, "
    "abs(score) >= 2.5 AS is_anomaly_2_5, abs(score) >= 3 AS is_anomaly_3, abs(score) >= 3.5 AS is_anomaly_3_5, abs(score) >= 4 AS is_anomaly_4, abs(score) >= 4.5 AS is_anomaly_4_5 FROM z2 WHERE abs(score) >= 1.5",
)
def anomaly_threshold_sensitivity(t: Tables) -> DataFrame:
    by_type = monitors.with_overrides(DAILY, dimensions=("event_type",))
    metrics = monitors.column_metrics(t.events, TABLE, by_type, {"value": ["max"]})
    store = monitors.merge_metric_store(None, metrics).withColumn("metric_name", F.col("dimension_value"))
    found = anomaly.anomaly_threshold_sensitivity(anomaly.metrics_anomaly_score(store, AS_OF))
    keep = [c for c in found.columns if c.startswith("is_anomaly")]
    return _round(found.select("metric_name", "anomaly_score", *keep), ["anomaly_score"])
