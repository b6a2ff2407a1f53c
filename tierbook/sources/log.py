"""An append-only table of few, small rows: one file per version, folded now and then.

Each version (mostly one row) is a file of its own in ``entries/``, named by its version, and is
there in full or not at all. Once more than ``FOLD_AFTER`` files have gathered,
all rows so far are written to one file in ``base/`` and their entries are
removed, so that a reader opens a bounded number of files however long the
history is. A row that is found in both places counts once.

One writer at a time per log; a second one that takes the same version fails.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierbook.sources.storage import list_folder, remove

FOLD_AFTER = 100


class Log:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path = spark, path.rstrip("/")
        self.schema = T.StructType([T.StructField("version", T.LongType()), *schema.fields])

    def _versions(self, kind: str) -> list[int]:
        """Versions in one of the two folders; a write that has not ended has no success mark yet and no file to read."""
        return sorted(int(e.name) for e in list_folder(self.spark, f"{self.path}/{kind}") if e.name.isdigit())

    def append(self, row: dict) -> int:
        """Add one row; returns its version."""
        return self.append_all([row])

    def append_all(self, rows: list[dict]) -> int:
        """Add rows that become visible together, as one version; returns it."""
        entries = self._versions("entries")
        version = 1 + max([*entries, *self._versions("base")], default=0)
        values = [tuple(version if f.name == "version" else row.get(f.name) for f in self.schema.fields) for row in rows]
        self._write("entries", version, self.spark.createDataFrame(values, self.schema), "errorifexists")
        if len(entries) >= FOLD_AFTER:
            self.fold()
        return version

    def _write(self, kind: str, version: int, rows: DataFrame, mode: str) -> None:
        rows.coalesce(1).write.mode(mode).parquet(f"{self.path}/{kind}/{version:020d}")

    def fold(self) -> None:
        """Write all rows to one file and remove what it replaces."""
        entries, base = self._versions("entries"), self._versions("base")
        if not entries:
            return
        self._write("base", entries[-1], self.rows(), "overwrite")
        for version in entries:
            remove(self.spark, f"{self.path}/entries/{version:020d}")
        for version in base:
            if version != entries[-1]:
                remove(self.spark, f"{self.path}/base/{version:020d}")

    def last_version(self) -> int | None:
        """The newest version (a folder's name: nothing is read)."""
        return max([*self._versions("entries"), *self._versions("base")], default=None)

    def exists(self) -> bool:
        return bool(self._versions("entries") or self._versions("base"))

    def rows(self) -> DataFrame:
        """All rows, in no order."""
        base = self._versions("base")[-1:]
        paths = [f"{self.path}/base/{v:020d}" for v in base]
        paths += [f"{self.path}/entries/{v:020d}" for v in self._versions("entries") if v > max(base, default=0)]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths).where(F.col("version").isNotNull())
