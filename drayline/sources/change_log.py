"""What each change of a table touched, and how far its readers have come."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from drayline.session import remove_folder

ENTRY = "_entry"
_ALL = "_ALL"


@dataclass(frozen=True)
class Pending:
    """What a reader has not seen: entries up to ``upto``; ``everything`` where a list of keys does not say it."""

    upto: int
    everything: bool
    rows: DataFrame | None = None


class ChangeLog:
    """One folder of rows (keys, or whole rows) for each change of a table.

    A writer appends an entry before its change takes effect, or in a step that
    is repeated until it succeeds, so a change is never missing here; an entry
    whose change did not happen costs a recomputation and nothing else. Each
    reader keeps the number of the last entry it has worked off. An entry that
    stands for the whole table (:meth:`append_all`), like a reader without a
    number, asks for a full run.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _names(self, folder: str) -> list[str]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def _touch(self, path: str) -> None:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(target, True).close()

    def _numbers(self) -> list[int]:
        return [int(n) for n in self._names(self.path) if n.isdigit()]

    def _finished(self, number: int) -> set[str]:
        return {"_SUCCESS", _ALL} & set(self._names(self._entry(number)))

    def _entry(self, number: int) -> str:
        return f"{self.path}/{number:012d}"

    def newest(self) -> int:
        """Number of the last entry; entries begin at 2, 1 is the mark of a reader that has seen none."""
        # Numbers of removed entries live on in the readers' marks.
        return max([1, *self._numbers(), *[self.mark(r) for r in self._names(f"{self.path}/_readers")]])

    def append(self, rows: DataFrame) -> int:
        number = self.newest() + 1
        rows.withColumn(ENTRY, F.lit(number).cast("long")).write.mode("overwrite").parquet(self._entry(number))
        return number

    def append_all(self) -> int:
        """An entry that stands for every row; those before it are no longer needed."""
        number = self.newest() + 1
        self._touch(f"{self._entry(number)}/{_ALL}")
        for old in self._numbers():
            if old < number:
                remove_folder(self.spark, self._entry(old))
        return number

    def mark(self, reader: str) -> int:
        """The last entry a reader has worked off, 0 if it never has."""
        return max([0, *[int(n) for n in self._names(f"{self.path}/_readers/{reader}") if n.isdigit()]])

    def pending(self, reader: str) -> Pending:
        mark = self.mark(reader)
        # The one writer of a log may be at work on the last entry; an unfinished one before it is dead.
        finished = {n: kinds for n in self._numbers() if n > mark and (kinds := self._finished(n))}
        upto = max([mark, *finished])
        if not mark or any(_ALL in kinds for kinds in finished.values()):
            return Pending(upto, True)
        paths = [self._entry(n) for n in finished]
        return Pending(upto, False, self.spark.read.parquet(*paths) if paths else None)

    def advance(self, reader: str, upto: int) -> None:
        """The reader has worked off all entries up to a number; those that every reader has seen go."""
        folder = f"{self.path}/_readers/{reader}"
        old = self._names(folder)
        upto = max(upto, 1)
        self._touch(f"{folder}/{upto:012d}")
        for name in old:
            if name.isdigit() and int(name) < upto:
                remove_folder(self.spark, f"{folder}/{name}")
        seen = min(self.mark(r) for r in self._names(f"{self.path}/_readers"))
        for number in self._numbers():
            if number <= seen:
                remove_folder(self.spark, self._entry(number))
