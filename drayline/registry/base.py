"""Registration of queries and the tables they read."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from drayline.session import use_utc


@dataclass(frozen=True)
class Query:
    """A query and, where SQL can express it at a reasonable cost, the same in SQL."""

    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


class Tables:
    """The Parquet tables of one folder, read on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"


def query(name: str, sql: str | None = None):
    """Register ``function(tables) -> DataFrame`` under a name."""

    def register(function: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            use_utc(spark)
            return function(Tables(spark, sf_dir))

        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = Query(name, run, sql)
        return function

    return register


# --- SQL building blocks (DuckDB) ----------------------------------------------------


def r(expression: str, places: int) -> str:
    """Round half up of a non-negative value."""
    if places == 0:
        return f"floor(({expression}) + 0.5)"
    return f"floor(({expression}) * 1e{places} + 0.5) / 1e{places}"


def units(column: str, scale: int) -> str:
    return f"CAST(round(({column}) * 1e{scale}) AS BIGINT)"


def mean(column: str, scale: int, places: int | None = None) -> str:
    """Mean of a column of ``scale`` decimals from whole units."""
    if places is None:
        return f"CAST(sum({units(column, scale)}) AS DOUBLE) / nullif(count({column}) * CAST(1e{scale} AS BIGINT), 0)"
    if places >= scale:
        factor = f"CAST(1e{places - scale} AS BIGINT)"
        return f"floor(CAST(sum({units(column, scale)}) * {factor} AS DOUBLE) / nullif(count({column}), 0) + 0.5) / 1e{places}"
    factor = f"CAST(1e{scale - places} AS BIGINT)"
    return f"floor(CAST(sum({units(column, scale)}) AS DOUBLE) / nullif(count({column}) * {factor}, 0) + 0.5) / 1e{places}"


def total(column: str, scale: int, places: int | None = None) -> str:
    whole = f"sum({units(column, scale)})"
    if places is None or places >= scale:
        return f"CAST({whole} AS DOUBLE) / 1e{scale}"
    return f"floor(CAST({whole} AS DOUBLE) / 1e{scale - places} + 0.5) / 1e{places}"


def with_ctes(names: list[str], body: str) -> str:
    """Prefix a query with the named common table expressions, in dependency order."""
    from drayline.registry.ctes import CTES

    parts = ", ".join(f"{n} AS ({CTES[n]})" for n in names)
    return f"WITH {parts} {body}"
