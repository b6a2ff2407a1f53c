"""The few file-system calls that Spark's readers and writers don't offer."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Entry:
    name: str
    is_folder: bool
    modified_ms: int


def _opened(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, found = _opened(spark, path)
    return fs.exists(found)


def list_folder(spark: SparkSession, path: str) -> list[Entry]:
    """What lies directly in a folder (nothing below it; none if it does not exist)."""
    fs, found = _opened(spark, path)
    if not fs.exists(found):
        return []
    return [Entry(s.getPath().getName(), s.isDirectory(), s.getModificationTime()) for s in fs.listStatus(found)]


def make_folder(spark: SparkSession, path: str) -> None:
    fs, found = _opened(spark, path)
    fs.mkdirs(found)


def remove(spark: SparkSession, path: str) -> None:
    fs, found = _opened(spark, path)
    fs.delete(found, True)


def rename(spark: SparkSession, old: str, new: str) -> None:
    fs, found = _opened(spark, old)
    if not fs.rename(found, spark._jvm.org.apache.hadoop.fs.Path(new)):
        raise OSError(f"could not rename {old} to {new}")
