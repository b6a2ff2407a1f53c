"""Cutting lineage: tables written to the cluster's shared folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared_root

_FOLDER = uuid.uuid4().hex[:12]
_CLEARED: set[str] = set()


def folder(spark: SparkSession) -> str:
    """This process's folder under ``spark.checkpoint.dir``; removed at exit."""
    root = f"{shared_root(spark)}/tierbook-llm-{_FOLDER}"
    if root not in _CLEARED:
        _CLEARED.add(root)
        atexit.register(clear, spark, root)
    return root


def clear(spark: SparkSession, root: str) -> None:
    if spark.sparkContext._jsc is None:  # the session has ended already
        return
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_WRITTEN: list[str] = []


def written_since(mark: int) -> list[str]:
    """The tables materialised since ``_WRITTEN`` had ``mark`` entries."""
    return _WRITTEN[mark:]


def mark() -> int:
    return len(_WRITTEN)


def drop_paths(spark: SparkSession, paths: list[str], keep: DataFrame) -> None:
    """Remove tables of ``written_since``, but those that ``keep`` reads."""
    read = {f.rsplit("/", 1)[0] for f in keep.inputFiles()}
    for path in paths:
        if not any(r.endswith(path.split(":", 1)[-1].lstrip("/")) for r in read):
            clear(spark, path)


def materialise(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again.

    The files survive the loss of any executor, later plans start from them,
    and their size is known to the optimiser.
    """
    spark = df.sparkSession
    path = f"{folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _WRITTEN.append(path)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch(df: DataFrame) -> None:
    """Remove the files of a materialised table that nothing will read again."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if f"/tierbook-llm-{_FOLDER}/" in path:
            clear(df.sparkSession, path)


def packed_rest(df: DataFrame, *taken: str) -> Column:
    """All other columns of ``df`` in one struct, so that their names can clash
    with nothing (a null byte if there are none)."""
    rest = [c for c in df.columns if c not in taken]
    return F.struct(*[F.col(f"`{c}`") for c in rest]) if rest else F.lit(None).cast("byte")


BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (of numbers and arrays of them) marked for a broadcast if a measurement shows at
    most ``limit`` rows and ``BROADCAST_BYTES`` bytes; else as it is, for a shuffle join with the same result."""
    arrays = [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]
    if not arrays:
        return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df
    size = F.lit(16 * len(df.columns)).cast("long")
    for c in arrays:
        size = size + 8 * F.greatest(F.size(c), F.lit(0))
    rows, total = df.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    return F.broadcast(df) if rows <= limit and total <= BROADCAST_BYTES else df


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this package to the Python workers (once per application), as
    ``--py-files`` would: their import path need not hold the repository."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    name = f"{tempfile.mkdtemp(prefix='tierbook-code-')}/tierbook"
    shutil.make_archive(name, "zip", os.path.dirname(package), os.path.basename(package))
    spark.sparkContext.addPyFile(f"{name}.zip")
    _SHIPPED.add(app)
