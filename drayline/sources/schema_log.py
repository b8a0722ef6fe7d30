"""The schema of a stored table as small numbered files beside it.

A table whose files were written at different times cannot tell its columns
from any one of them, and values in folder names have no type.  So every table
states its columns, their types and its partition columns here, and changes
them before rows of the new shape are written.  The newest entry counts.

A column that is dropped and comes back later is stored under another name, so
that values from before the drop stay gone.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def _file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


@dataclass(frozen=True)
class Entry:
    """Columns by name: the name in the files and the type; ``used`` are all names files may hold."""

    number: int
    columns: dict[str, tuple[str, T.DataType]]
    used: frozenset[str]

    def stored(self) -> T.StructType:
        return T.StructType([T.StructField(name, kind, True) for name, kind in self.columns.values()])

    def read(self, spark: SparkSession, path: str) -> DataFrame:
        """The table's rows; columns that a file lacks are null."""
        return self.named(spark.read.schema(self.stored()).parquet(path))

    def named(self, df: DataFrame) -> DataFrame:
        if all(name == stored for name, (stored, _) in self.columns.items()):
            return df
        return df.select(*[F.col(stored).alias(name) for name, (stored, _) in self.columns.items()])

    def for_files(self, df: DataFrame) -> DataFrame:
        """Rows as they go into files: this entry's columns in its types, under their stored names."""
        have = set(df.columns)
        return df.select(
            *[(F.col(f"`{n}`") if n in have else F.lit(None)).cast(kind).alias(stored) for n, (stored, kind) in self.columns.items()]
        )

    def same_as(self, schema: T.StructType) -> bool:
        kinds = {f.name: f.dataType.simpleString() for f in schema}
        return {n: kind.simpleString() for n, (_, kind) in self.columns.items()} == kinds

    def retyped(self, schema: T.StructType) -> bool:
        """Whether a column of both has another type there."""
        kinds = {f.name: f.dataType.simpleString() for f in schema}
        return any(kinds.get(n, kind.simpleString()) != kind.simpleString() for n, (_, kind) in self.columns.items())


class SchemaLog:
    """Entries below one path; they are never changed, only added."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def _numbers(self) -> list[int]:
        fs, root = _file_system(self.spark, self.path)
        if not fs.exists(root):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(root)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def newest(self) -> Entry | None:
        numbers = self._numbers()
        if not numbers:
            return None
        fs, file = _file_system(self.spark, f"{self.path}/{numbers[-1]:08d}.json")
        stream = fs.open(file)
        try:
            told = json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()
        columns = {c["name"]: (c["stored"], T.StructField.fromJson(c["field"]).dataType) for c in told["columns"]}
        return Entry(numbers[-1], columns, frozenset(told["used"]))

    def _add(self, entry: Entry) -> Entry:
        columns = [
            {"name": n, "stored": stored, "field": T.StructField(stored, kind).jsonValue()} for n, (stored, kind) in entry.columns.items()
        ]
        text = json.dumps({"columns": columns, "used": sorted(entry.used)})
        fs, file = _file_system(self.spark, f"{self.path}/{entry.number:08d}.json")
        _, draft = _file_system(self.spark, f"{self.path}/_{entry.number:08d}.draft")
        stream = fs.create(draft, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        if not fs.rename(draft, file):  # somebody else has written this number
            raise RuntimeError(f"the schema below {self.path} has been changed by another writer")
        return entry

    def replace(self, schema: T.StructType) -> Entry:
        """A new start: files of earlier entries are about to go."""
        newest = self.newest()
        if newest and newest.same_as(schema) and list(newest.columns) == schema.names and newest.used == frozenset(schema.names):
            return newest
        number = newest.number + 1 if newest else 1
        return self._add(Entry(number, {f.name: (f.name, f.dataType) for f in schema}, frozenset(schema.names)))

    def evolve(self, schema: T.StructType, partition_by: list[str]) -> Entry:
        """The entry for a table that is to have these columns; a new one if they differ from the newest."""
        newest = self.newest()
        if newest is None:
            return self.replace(schema)
        if newest.same_as(schema):
            return newest
        number, columns, used = newest.number + 1, {}, set(newest.used)
        for field in schema:
            stored = newest.columns[field.name][0] if field.name in newest.columns else field.name
            if field.name not in newest.columns and stored in used:
                stored = f"{field.name}__{number}"
            if field.name in partition_by and stored != field.name:
                raise ValueError(f"partition column {field.name!r} cannot be added to a stored table")
            columns[field.name] = (stored, field.dataType)
            used.add(stored)
        return self._add(Entry(number, columns, frozenset(used)))
