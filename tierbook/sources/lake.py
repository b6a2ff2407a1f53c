"""Readers for the silver, control and gold layers, always with a declared
schema (partition columns otherwise come back as int/bigint)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierbook.operators.book import BookSpec
from tierbook.operators.latest import PROC_FIRST, latest_batch
from tierbook.operators.quality import assert_rows
from tierbook.schemas import CONTROL_SCHEMA, FAULTS, LOAD_REPORT_SCHEMA, RAW, SubjectSpec
from tierbook.sinks import commits


def _stored(spark: SparkSession, silver_dir: str, spec: SubjectSpec, loads: DataFrame | None = None) -> DataFrame:
    return commits.read_live(spark, silver_dir, spec.stored_schema, loads)


def read_silver(spark: SparkSession, silver_dir: str, spec: SubjectSpec, loads: DataFrame | None = None) -> DataFrame:
    """The rows of every live load (or of ``loads``, rows of ``commits.live_loads``)."""
    return _stored(spark, silver_dir, spec, loads).where(F.col(FAULTS).isNull()).select(*spec.silver_schema.fieldNames())


def read_rejects(spark: SparkSession, silver_dir: str, spec: SubjectSpec) -> DataFrame:
    """The rejected rows of every live load: batch, the columns that don't fit, and the text of all."""
    bad = _stored(spark, silver_dir, spec).where(F.col(FAULTS).isNotNull())
    return bad.select("ref", "ts_file_generation", "ts_proc", F.split(FAULTS, ",").alias("faults"), f"{RAW}.*")


def read_latest_load(
    spark: SparkSession, silver_dir: str, spec: SubjectSpec, order: Sequence[str] = PROC_FIRST, min_ref: str | None = None
) -> DataFrame:
    """Rows of the greatest batch by ``order`` that has rows; of refs from ``min_ref`` on.

    The commit log alone says which it is: one folder is listed and opened,
    however many loads the table has. Its rows are checked against the commit.
    A table without a log is scanned for its greatest batch.
    """
    if not commits.has_log(spark, silver_dir):
        plain = read_silver(spark, silver_dir, spec)
        return latest_batch(plain if min_ref is None else plain.where(F.col("ref") >= min_ref), order)
    loads = commits.live_loads(spark, silver_dir).where("rows > 0")
    if min_ref is not None:
        loads = loads.where(F.col("ref") >= min_ref)
    best = loads.orderBy(*[F.col(c).desc() for c in order], F.col("ref").desc()).first()
    if best is None:
        return spark.createDataFrame([], spec.silver_schema)
    # all refs of the winning batch
    for c in order:
        loads = loads.where(F.col(c).eqNullSafe(best[c]))
    rows = read_silver(spark, silver_dir, spec, loads)
    return assert_rows(rows, loads.agg(F.sum("rows")).first()[0], silver_dir)


def read_control(spark: SparkSession, *control_dirs: str, missing_ok: bool = False) -> DataFrame:
    """Control rows of one or more subjects (one folder per subject).

    With ``missing_ok`` a subject that was never loaded (no folder yet)
    contributes no rows instead of failing the read.
    """
    cols = ("assunto", "ref", "ts_file_generation", "ts_proc", "qtd_registros")
    parts = []
    for d in control_dirs:
        try:  # the reader checks that the folder exists
            df = spark.read.schema(CONTROL_SCHEMA).parquet(d).select(*cols)
        except AnalysisException as exc:
            if not (missing_ok and "PATH_NOT_FOUND" in str(exc)):
                raise
            continue
        parts.append(df)
    if not parts:
        return spark.createDataFrame([], CONTROL_SCHEMA).select(*cols)
    return reduce(DataFrame.unionByName, parts)


def read_load_report(spark: SparkSession, control_dir: str, missing_ok: bool = False) -> DataFrame:
    """Control rows of one subject with what each load rejected: how many rows, and misfits per column."""
    try:
        df = spark.read.schema(LOAD_REPORT_SCHEMA).parquet(control_dir)
    except AnalysisException as exc:
        if not (missing_ok and "PATH_NOT_FOUND" in str(exc)):
            raise
        df = spark.createDataFrame([], LOAD_REPORT_SCHEMA)
    return df.select(
        "assunto", "ref", "ts_file_generation", "ts_proc", "qtd_registros", F.coalesce("rejected", F.lit(0)).alias("rejected"), "faults", "version"
    )


def gold_schema(spec: BookSpec, user_type: T.DataType = T.StringType()) -> T.StructType:
    fields = [
        T.StructField("user_id", user_type),
        T.StructField("ref", T.StringType()),
        T.StructField("ts_proc", T.StringType()),
    ]
    for f in spec.features():
        fields.append(T.StructField(f.name, T.LongType() if f.stat == "qtd" else T.DoubleType()))
    return T.StructType(fields)


def read_gold(spark: SparkSession, gold_dir: str, spec: BookSpec, user_type: T.DataType = T.StringType()) -> DataFrame:
    """The live books, one per ``(ref, ts_proc)``."""
    schema = gold_schema(spec, user_type)
    return commits.read_live(spark, gold_dir, schema).select(*schema.fieldNames())
