"""Scores of metric series that go on from stored moments instead of the history.

A series is kept as one row: how many values it has, their mean and squared
deviations about its first value, and where it ends. A run reads these rows and the
new metrics. Only a series that gets a metric before its end (a late or corrected
bucket) is read again from the store, and only that one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from drayline.operators.anomaly import recent_scores
from drayline.operators.chunking import ROWS_PER_CHUNK, expanding_stats
from drayline.session import cut_lineage

SERIES = ["metric_name", "full_table_name", "column_name"]
_PLACE = ["_at", "bucket_end", "id"]
STATE_COLUMNS = [*SERIES, "n", "origin", "mean", "squares", "training_start", "last_place"]
_INFINITE = float("inf")


def _same_series(left: str, right: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in SERIES])


def _rows(store: DataFrame) -> DataFrame:
    return store.select(
        "id", "full_table_name", "column_name", "dimension", "dimension_value", "metric_name",
        F.col("metric_value").alias("latest_metric_value"), "bucket_start", "bucket_end", "updated_at",
        F.coalesce("bucket_start", "bucket_end").alias("_at"),
    )


def _place() -> Column:
    return F.struct(*_PLACE)


def _combined(rows: DataFrame, state: DataFrame | None, rows_per_chunk: int) -> DataFrame:
    """Running moments of rows that all lie after what their series' state covers."""
    value = F.col("latest_metric_value")
    first = rows.groupBy(*SERIES).agg(
        F.min_by(value, F.when(value.isNotNull() & ~F.isnan(value) & (F.abs(value) < _INFINITE), _place())).alias("_first"),
        F.min(_place()).alias("_begin"),
    )
    if state is None:
        blank = {"n": "long", "origin": "double", "mean": "double", "squares": "double", "training_start": "timestamp"}
        known = first.select("*", *[F.lit(None).cast(kind).alias(c) for c, kind in blank.items()])
    else:
        held = state.select(*SERIES, "n", "origin", "mean", "squares", "training_start")
        known = first.alias("l").join(held.alias("r"), _same_series("l", "r"), "left").select(
            "l.*", "r.n", "r.origin", "r.mean", "r.squares", "r.training_start"
        )
    known = known.select(
        *SERIES, F.coalesce("n", F.lit(0)).alias("_held_n"), F.coalesce("origin", "_first").alias("origin"),
        F.coalesce("mean", F.lit(0.0)).alias("_held_mean"), F.coalesce("squares", F.lit(0.0)).alias("_held_squares"),
        F.coalesce("training_start", F.col("_begin.bucket_end")).alias("training_start"),
    )
    rows = rows.alias("l").join(known.alias("r"), _same_series("l", "r")).select(
        "l.*", "r._held_n", "r.origin", "r._held_mean", "r._held_squares", "r.training_start"
    )
    # Deviations from the first value: a constant series has a deviation of exactly zero.
    rows = rows.withColumn("_deviation", F.col("latest_metric_value") - F.coalesce("origin", F.lit(0.0)))
    here = expanding_stats(rows, SERIES, _PLACE, "_deviation", rows_per_chunk)
    n1, m1 = F.col("training_set_size"), F.col("training_avg")
    q1 = F.when(n1 > 1, F.pow("training_stddev", F.lit(2)) * (n1 - 1)).otherwise(F.lit(0.0))
    n0, m0, q0 = F.col("_held_n"), F.col("_held_mean"), F.col("_held_squares")
    n, step = n0 + n1, m1 - m0
    endless = (F.abs(m0) == _INFINITE) | (F.abs(m1) == _INFINITE)
    mean = F.when(n1 == 0, m0).when(n0 == 0, m1).when(endless, m0 + m1).otherwise(m0 + step * n1 / n)
    joined_up = q0 + q1 + step * step * n0 * n1 / n
    squares = F.when(n1 == 0, q0).when(n0 == 0, q1).when(endless, F.lit(float("nan"))).otherwise(joined_up)
    # A single value that is no number has no deviation yet, but none of its series will be a number.
    squares = F.when(F.isnan(mean) | (F.abs(mean) == _INFINITE), F.lit(float("nan"))).otherwise(squares)
    told = here.select(*rows.columns, n.alias("n"), mean.alias("mean"), squares.alias("squares"))
    return told.drop("_held_n", "_held_mean", "_held_squares", "_deviation")


def _state_of(combined: DataFrame) -> DataFrame:
    last = combined.groupBy(*SERIES).agg(
        F.max_by(F.struct("n", "origin", "mean", "squares", "training_start"), _place()).alias("_s"), F.max(_place()).alias("last_place")
    )
    return last.select(*SERIES, "_s.*", "last_place").select(*STATE_COLUMNS)


def resume_scores(
    new: DataFrame, store: DataFrame, state: DataFrame | None = None, rows_per_chunk: int = ROWS_PER_CHUNK
) -> tuple[DataFrame, DataFrame]:
    """Running statistics of new metrics and the moments to go on from.

    ``new`` holds metric rows (:data:`monitors.METRIC_COLUMNS`) with ids that are
    unique, ``store`` all metrics, the new ones included, ``state`` what the last run
    returned. The statistics cover every new row, and every row of a series that was
    read again, because there the rows after a late one change. Null values are kept
    and train nothing; from a NaN or an infinity on there is no deviation. Both
    results are stored, so the store is read at most once, and not at all where
    no series goes back.
    """
    rows = _rows(new)
    again = None
    if state is not None:
        began = rows.groupBy(*SERIES).agg(F.min(_place()).alias("_from"))
        back = began.alias("l").join(state.alias("r"), _same_series("l", "r")).where(F.col("_from") <= F.col("last_place"))
        back = cut_lineage(back.select(*[f"l.{k}" for k in SERIES]), "series-again")
        if not back.isEmpty():
            again = _rows(store).alias("l").join(back.alias("r"), _same_series("l", "r"), "left_semi")
            rows = rows.alias("l").join(back.alias("r"), _same_series("l", "r"), "left_anti")
    combined = _combined(rows, state, rows_per_chunk)
    if again is not None:
        combined = combined.unionByName(_combined(again, None, rows_per_chunk))
    combined = cut_lineage(combined, "resumed")
    fresh = _state_of(combined)
    if state is not None:
        kept = state.alias("l").join(fresh.alias("r"), _same_series("l", "r"), "left_anti").select(*STATE_COLUMNS)
        fresh = kept.unionByName(fresh)
    n = F.col("n")
    trained = combined.select(
        *[c for c in combined.columns if c not in ("n", "mean", "squares", "origin", "_at", "training_start")],
        F.when(n > 0, F.coalesce("origin", F.lit(0.0)) + F.col("mean")).alias("training_avg"),
        F.when(n > 1, F.sqrt(F.col("squares") / (n - 1))).alias("training_stddev"),
        n.alias("training_set_size"), "training_start", F.col("bucket_end").alias("training_end"),
    )
    return trained, cut_lineage(fresh, "moments")


def resumed_anomaly_score(trained: DataFrame, as_of, sensitivity: float = 3, days: int = 7) -> DataFrame:
    """The view of :func:`anomaly.metrics_anomaly_score` over statistics of :func:`resume_scores`."""
    return recent_scores(trained, as_of, sensitivity, days)
