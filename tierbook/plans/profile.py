"""Profiles of silver loads, stored beside the control rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierbook.operators.profile import distance, profile
from tierbook.schemas import SubjectSpec
from tierbook.sinks import commits
from tierbook.sources.lake import read_silver
from tierbook.sources.storage import path_exists

STORED = T.StructType(
    [
        T.StructField("column", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("nulls", T.LongType()),
        T.StructField("least", T.StringType()),
        T.StructField("greatest", T.StringType()),
        T.StructField("distinct", T.BinaryType()),
        T.StructField("quantiles", T.BinaryType()),
    ]
)


def stored_profile(spark: SparkSession, spec: SubjectSpec, silver_dir: str, profile_dir: str, load) -> DataFrame:
    """The profile of one load (a row of ``live_loads``): read, or computed and stored under its version."""
    path = f"{profile_dir.rstrip('/')}/version={load['version']}"
    if not path_exists(spark, f"{path}/_SUCCESS"):
        one = commits.live_loads(spark, silver_dir).where(F.col("version") == load["version"])
        rows = read_silver(spark, silver_dir, spec, one).select(*spec.columns.fieldNames())
        profile(rows).coalesce(1).write.mode("overwrite").parquet(path)
    return spark.read.schema(STORED).parquet(path)


def profile_newest(spark: SparkSession, spec: SubjectSpec, silver_dir: str, profile_dir: str) -> DataFrame:
    """How far the newest load lies from the one before it, per column (no rows without two loads).

    A load is read once, when its profile is first asked for.
    """
    newest = commits.live_loads(spark, silver_dir).where("rows > 0").orderBy(F.col("version").desc()).limit(2).collect()
    profiles = [stored_profile(spark, spec, silver_dir, profile_dir, load) for load in newest]
    if len(profiles) < 2:
        empty = spark.createDataFrame([], STORED)
        return distance(empty, empty)
    return distance(profiles[1], profiles[0])
