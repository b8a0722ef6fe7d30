"""What the catalog holds: relations by name pattern, table and column inventories."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from drayline.schemas import ddl


def _like(pattern: str, text: str) -> bool:
    """Case-insensitive SQL LIKE."""
    regex = "".join(".*" if c == "%" else "." if c == "_" else re.escape(c) for c in pattern)
    return re.fullmatch(regex, text, flags=re.IGNORECASE | re.DOTALL) is not None


def _databases(spark: SparkSession) -> list[str]:
    return [d.name for d in spark.catalog.listDatabases()]


def relations_by_pattern(
    spark: SparkSession, schema_pattern: str, table_pattern: str, exclude: str = ""
) -> list[str]:
    """``schema.table`` names that match both patterns and not the excluded one."""
    found = []
    for database in _databases(spark):
        if not _like(schema_pattern, database):
            continue
        for table in spark.catalog.listTables(database):
            if table.isTemporary or not _like(table_pattern, table.name):
                continue
            if exclude and _like(exclude, table.name):
                continue
            found.append(f"{database}.{table.name}")
    return sorted(found)


def relations_by_prefix(spark: SparkSession, schema: str, prefix: str, exclude: str = "") -> list[str]:
    return relations_by_pattern(spark, schema, f"{prefix}%", exclude)


def table_inventory(spark: SparkSession) -> DataFrame:
    """Tables per schema, upper-cased; a schema without tables has one row with nulls."""
    catalog = spark.catalog.currentCatalog()
    rows = []
    for database in _databases(spark):
        tables = [t.name for t in spark.catalog.listTables(database) if not t.isTemporary]
        rows += [(catalog, database, name) for name in tables or [None]]
    base = spark.createDataFrame(rows, ddl("database_name string, schema_name string, table_name string"))
    upper = base.select(*[F.upper(c).alias(c) for c in base.columns])
    full_schema = F.concat_ws(".", "database_name", "schema_name")
    return upper.select(
        F.when(F.col("table_name").isNotNull(), F.concat_ws(".", full_schema, "table_name")).alias("full_table_name"),
        full_schema.alias("full_schema_name"),
        "database_name",
        "schema_name",
        "table_name",
    )


def column_inventory(spark: SparkSession, schema_pattern: str = "%") -> DataFrame:
    """Columns of every table with their types, names upper-cased."""
    catalog = spark.catalog.currentCatalog()
    rows = []
    for relation in relations_by_pattern(spark, schema_pattern, "%"):
        database, table = relation.split(".", 1)
        for column in spark.catalog.listColumns(relation):
            rows.append((catalog, database, table, column.name, column.dataType))
    schema = ddl("database_name string, schema_name string, table_name string, column_name string, data_type string")
    base = spark.createDataFrame(rows, schema)
    named = [F.upper(c).alias(c) for c in base.columns[:-1]]
    return base.select(
        F.upper(F.concat_ws(".", "database_name", "schema_name", "table_name")).alias("full_table_name"),
        *named,
        "data_type",
    )
