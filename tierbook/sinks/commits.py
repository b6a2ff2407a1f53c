"""Loads that become visible as a whole: fresh folder, then one commit row.

Every load of a batch writes a folder of its own below the batch's leaf, which
nobody reads yet. Appending its row to the table's commit log makes it the
batch's content, in one step; the folder of an earlier load of the same batch
stays as it is until ``vacuum``. A load that dies on the way leaves the table
as it was, whether it had written nothing, part or all of its files, and a
rerun by fewer or no rows replaces the batch like any other.

The log lies in ``_log`` in the table's folder. A table without one (written by
another program) is read as it lies.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierbook.sources.log import Log
from tierbook.sources.storage import list_folder, make_folder, remove

KEYS = ("ref", "ts_proc", "ts_file_generation")

COMMIT_SCHEMA = T.StructType(
    [
        *[T.StructField(k, T.StringType()) for k in KEYS],
        T.StructField("folder", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("rejected", T.LongType()),
        T.StructField("faults", T.MapType(T.StringType(), T.LongType())),
    ]
)


@dataclass(frozen=True)
class Load:
    """A load that has begun: where it writes, and which batch it will become."""

    root: str
    folder: str
    key: dict

    @property
    def path(self) -> str:
        return f"{self.root}/{self.folder}"


def commit_log(spark: SparkSession, root: str) -> Log:
    return Log(spark, f"{root.rstrip('/')}/_log/committed", COMMIT_SCHEMA)


def has_log(spark: SparkSession, root: str) -> bool:
    """Whether loads of this table are committed (the mark is there before the first file of the first load)."""
    return any(e.name == "_log" for e in list_folder(spark, root))


def begin(spark: SparkSession, root: str, **key: str | None) -> Load:
    """Announce a load of the batch ``key``; its folder is new."""
    root, name = root.rstrip("/"), uuid.uuid4().hex
    leaf = "/".join(f"{k}={key[k]}" for k in KEYS if key.get(k) is not None)
    load = Load(root, f"{leaf}/load={name}", {k: key.get(k) for k in KEYS})
    make_folder(spark, f"{root}/_log/begun/{name}")
    return load


def commit(spark: SparkSession, load: Load, rows: int, rejected: int = 0, faults: dict | None = None) -> int:
    """Make a load, whose files are all written, the content of its batch."""
    row = {**load.key, "folder": load.folder, "rows": int(rows), "rejected": int(rejected), "faults": faults or {}}
    version = commit_log(spark, load.root).append(row)
    remove(spark, f"{load.root}/_log/begun/{load.folder.rsplit('load=', 1)[1]}")
    return version


def live_loads(spark: SparkSession, root: str) -> DataFrame:
    """The commit row that counts of every batch: the newest."""
    rows = commit_log(spark, root).rows()
    newest = rows.groupBy(*KEYS).agg(F.max_by(F.struct(*rows.columns), "version").alias("n"))
    return newest.select("n.*")


def read_live(spark: SparkSession, root: str, schema: T.StructType, loads: DataFrame | None = None) -> DataFrame:
    """The rows of the live loads (or of those given), with the batch's keys as partition columns.

    Only the folders that the log names are listed and opened, one per batch.
    """
    root = root.rstrip("/")
    if loads is None:
        if not has_log(spark, root):
            return spark.read.schema(schema).parquet(root)
        loads = live_loads(spark, root)
    folders = sorted(r["folder"] for r in loads.select("folder").collect())  # a row per batch
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*[f"{root}/{f}" for f in folders])


def _folders(spark: SparkSession, root: str, below: str = "") -> dict[str, int]:
    """All load folders of a table and when they last changed, by the keys' levels."""
    found = {}
    for e in list_folder(spark, f"{root}/{below}".rstrip("/")):
        if e.is_folder and "=" in e.name:
            path = f"{below}/{e.name}".lstrip("/")
            found.update({path: e.modified_ms} if e.name.startswith("load=") else _folders(spark, root, path))
    return found


def vacuum(spark: SparkSession, root: str, older_than_ms: int) -> list[str]:
    """Remove load folders that no live commit names and that nobody has written to since ``older_than_ms``.

    Give a time before which every running load and every reader of a replaced
    load has ended. Returns the folders removed.
    """
    root = root.rstrip("/")
    if not has_log(spark, root):
        return []
    live = {r["folder"] for r in live_loads(spark, root).select("folder").collect()}
    begun = {e.name: e.modified_ms for e in list_folder(spark, f"{root}/_log/begun")}
    gone = []
    for folder, modified in _folders(spark, root).items():
        name = folder.rsplit("load=", 1)[1]
        if folder not in live and max(modified, begun.get(name, 0)) < older_than_ms:
            remove(spark, f"{root}/{folder}")
            gone.append(folder)
    for name, at in begun.items():
        if at < older_than_ms:
            remove(spark, f"{root}/_log/begun/{name}")
    return sorted(gone)
