"""First or last row per key.

``row_number() = 1`` is planned as a group limit below the shuffle: each map
task keeps one row per key, so a key with very many versions ships one row per
task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

_RN = "_rn"


def top_n_per_key(df: DataFrame, keys: list, order_by: list[Column], n: int = 1) -> DataFrame:
    window = W.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn(_RN, F.row_number().over(window)).where(F.col(_RN) <= n).drop(_RN)


def first_per_key(df: DataFrame, keys: list, order_by: list[Column]) -> DataFrame:
    """One row per key: the first in the given order (``DISTINCT ON``)."""
    return top_n_per_key(df, keys, order_by, 1)


def latest_per_key(df: DataFrame, keys: list, version_cols: list[str]) -> DataFrame:
    """One row per key: the one with the highest version columns."""
    return first_per_key(df, keys, [F.col(c).desc_nulls_last() for c in version_cols])


def deduplicate(df: DataFrame, partition_by: list[str], order_by: list[Column]) -> DataFrame:
    """Keep one row per ``partition_by`` group, rows holding nulls included."""
    return first_per_key(df, partition_by, order_by)


def latest_row(df: DataFrame, order_by: list[Column]) -> DataFrame:
    """The single first row; a limited sort keeps one row per task."""
    return df.orderBy(*order_by).limit(1)


def most_frequent(
    df: DataFrame, group_by: list[str], column: str, tie_break_ascending: bool = True
) -> DataFrame:
    """Most common value of ``column`` per group, ties resolved by the value."""
    counted = df.groupBy(*group_by, column).agg(F.count(F.lit(1)).alias("_n"))
    tie = F.col(column).asc_nulls_last() if tie_break_ascending else F.col(column).desc_nulls_last()
    return first_per_key(counted, group_by, [F.col("_n").desc(), tie]).drop("_n")
