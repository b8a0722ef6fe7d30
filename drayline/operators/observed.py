"""Column metrics of rows while they are written, so that no second scan is needed."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, Observation, functions as F
from pyspark.sql.streaming import StreamingQuery

from drayline.operators import monitors
from drayline.operators.monitors import MonitorConfig
from drayline.operators.reshape import columns_ignoring


class ObservedMetrics:
    """The column monitors of one write.

    ``watch`` marks the rows where they pass; ``metrics`` waits for the write and
    gives the rows that :func:`monitors.column_metrics` would give for them. Only
    the monitors' values come to the driver, one number a column and monitor.

    The mark belongs directly before the write: there each task counts once
    however often it is repeated, while tasks before a shuffle may count again
    when an executor is lost. Metrics by time bucket or dimension need groups,
    which a mark does not have; they are refused.
    """

    def __init__(self, table: str, config: MonitorConfig, columns: dict | list[str] | None = None):
        if config.timestamp_column is not None or config.dimensions or config.where_expression:
            raise ValueError("metrics of a write have no time buckets, dimensions or filter")
        self.table, self.config, self.columns = table, config, columns
        self._observation: Observation | None = None

    def watch(self, df: DataFrame) -> DataFrame:
        self.spark = df.sparkSession
        self._wanted = monitors.wanted_monitors(df, self.columns if self.columns is not None else list(df.columns))
        self._observation = Observation()
        return df.observe(self._observation, F.count(F.lit(1)).alias("_rows"), *monitors.monitor_aggregates(self._wanted))

    def _values(self) -> dict:
        if self._observation is None:
            raise ValueError("nothing has been watched")
        return self._observation.get

    @property
    def row_count(self) -> int:
        return self._values()["_rows"]

    def metrics(self) -> DataFrame:
        values = self._values()
        names = [n for n in values if n != "_rows"]
        schema = ", ".join(f"{n} double" for n in names)
        wide = self.spark.createDataFrame([tuple(values[n] for n in names)], schema)
        return monitors.finish_column_metrics(monitors.unfold_monitors(wide, self._wanted, []), self.table, self.config)


def chosen_columns(
    df: DataFrame, chosen: list[str] | None = None, exclude_prefix: str | None = None, exclude_regexp: str | None = None
) -> dict[str, list[str]]:
    """Monitors by column for all columns not excluded, as :func:`monitors.all_columns_metrics` takes them."""
    names = columns_ignoring(df, exclude_prefix, exclude_regexp)
    by_column = {c: monitors.monitors_for(df.schema[c].dataType, chosen) for c in names}
    return {c: m for c, m in by_column.items() if m}


def start_observed(
    stream: DataFrame,
    path: str,
    metrics_path: str,
    checkpoint: str,
    observed: Callable[[DataFrame, int], ObservedMetrics],
    available_now: bool = False,
    interval: str = "5 minutes",
) -> StreamingQuery:
    """Land a stream by micro-batch with the metrics of each, in one pass over the rows.

    Both go to a folder a batch that a repeated batch replaces. ``observed`` makes
    the monitors of a batch, with the clock its metrics carry.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        watched = observed(batch, batch_id)
        watched.watch(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        watched.metrics().write.mode("overwrite").parquet(f"{metrics_path}/batch={batch_id}")

    writer = stream.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)).start()
