"""Pinned versions of file tables (S4): what a count saw is what an extract reads.

A log beside a table holds one small table of actions for each version: the
files that came, went or changed, with length and modification time. Replaying
the actions up to a version gives its file list. ``pin`` records the table as it
is now as a version (a new one where anything changed); ``read`` reads exactly
that version's files and ``verify`` raises ``SnapshotChanged`` when one of them
is gone or another file by now.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docferry.sources import fs
from docferry.sources.tables import Catalog

_FILES = "path string, length bigint, modified timestamp"


class SnapshotChanged(RuntimeError):
    """Files of a pinned version were rewritten or removed."""


class SnapshotLog:
    """The versions of the parquet table in ``table``, kept in ``log``."""

    def __init__(self, spark: SparkSession, table: str, log: str) -> None:
        self._spark, self.table, self._log = spark, table, log.rstrip("/")

    def _now(self) -> DataFrame:
        """Files as they are now; their contents aren't read."""
        return (self._spark.read.format("binaryFile").option("recursiveFileLookup", True)
                .option("pathGlobFilter", "*.parquet").load(self.table)
                .select("path", "length", F.col("modificationTime").alias("modified")))

    def last(self) -> int:
        """The newest version, -1 before the first."""
        if not fs.exists(self._spark, self._log):
            return -1
        fsys, p = fs._fs(self._spark, self._log)
        names = [s.getPath().getName() for s in fsys.listStatus(p)]
        return max((int(n.removeprefix("version=")) for n in names if n.startswith("version=")), default=-1)

    def files(self, version: int) -> DataFrame:
        """The file list of a version: the newest action of each path wins."""
        if not 0 <= version <= self.last():
            raise ValueError(f"no version {version} of {self.table}")
        actions = self._spark.read.parquet(self._log).filter(F.col("version") <= version)
        return actions.groupBy("path").agg(F.max_by(F.struct("kept", "length", "modified"), "version").alias("a")).filter(
            "a.kept").select("path", "a.length", "a.modified")

    def pin(self) -> int:
        """The version of the table as it is now."""
        last = self.last()
        now = self._now()
        before = self.files(last) if last >= 0 else self._spark.createDataFrame([], _FILES)
        pair = now.alias("n").join(before.alias("b"), "path", "full")
        changed = pair.filter(~(F.col("n.length").eqNullSafe(F.col("b.length"))
                                & F.col("n.modified").eqNullSafe(F.col("b.modified"))))
        actions = changed.select(
            "path", F.col("n.length").isNotNull().alias("kept"), F.col("n.length").alias("length"),
            F.col("n.modified").alias("modified"))
        staged = f"{self._log}/_staged-{last + 1}"
        actions.coalesce(1).write.mode("overwrite").parquet(staged)
        if last >= 0 and self._spark.read.parquet(staged).isEmpty():
            fs.delete(self._spark, staged)
            return last
        fs.rename(self._spark, staged, f"{self._log}/version={last + 1}", replace=False)
        return last + 1

    def verify(self, version: int) -> None:
        """Raise where a file of the version is gone or was rewritten."""
        pair = self.files(version).alias("v").join(self._now().alias("n"), "path", "left")
        bad = pair.filter(~(F.col("n.length").eqNullSafe(F.col("v.length"))
                            & F.col("n.modified").eqNullSafe(F.col("v.modified")))).select("path").limit(3).collect()
        if bad:
            raise SnapshotChanged(f"{self.table} version {version}: changed files, such as "
                                  f"{', '.join(r.path for r in bad)}")

    def read(self, version: int) -> DataFrame:
        """The rows of a version, from exactly its files."""
        self.verify(version)
        # A scan's file list is the driver's in any case.
        paths = [r.path for r in self.files(version).select("path").orderBy("path").collect()]
        if not paths:
            return self._spark.createDataFrame([], self._spark.read.parquet(self.table).schema)
        return self._spark.read.parquet(*paths)


class SnapshotCatalog(Catalog):
    """Tables whose every ``get`` pins the version it returns. ``verify`` tells
    whether the version of the last ``get`` still stands."""

    def __init__(self, spark: SparkSession, tables: dict[str, str], log_root: str) -> None:
        super().__init__()
        self._logs = {n: SnapshotLog(spark, path, f"{log_root.rstrip('/')}/{n}") for n, path in tables.items()}
        self.versions: dict[str, int] = {}

    def names(self) -> list[str]:
        return sorted(self._logs)

    def get(self, name: str) -> DataFrame:
        if name not in self._logs:
            raise KeyError(f"unknown data_index {name!r}")
        log = self._logs[name]
        self.versions[name] = log.pin()
        return log.read(self.versions[name])

    def verify(self, name: str) -> None:
        self._logs[name].verify(self.versions[name])
