"""Control (audit) rows and the multi-subject readiness gate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierbook.schemas import LOAD_REPORT_SCHEMA


def control_row(
    spark: SparkSession, subject: str, ref: str, ts_file_generation: str, ts_proc: str, rows: int,
    rejected: int = 0, faults: dict | None = None, version: int | None = None,
) -> DataFrame:
    """One audit row for one load, built from the run parameters and the
    observed counts; an empty snapshot still gets a row (count 0)."""
    row = (subject, ts_file_generation, ts_proc, int(rows), ref, int(rejected), faults or {}, version)
    return spark.createDataFrame([row], LOAD_REPORT_SCHEMA)


def control_rows(silver_batch: DataFrame, subject: str) -> DataFrame:
    """Audit rows of a silver batch that may hold several snapshots."""
    return (
        silver_batch.groupBy("ref", "ts_file_generation", "ts_proc")
        .agg(F.count(F.lit(1)).alias("qtd_registros"))
        .select(
            F.lit(subject).alias("assunto"),
            "ts_file_generation",
            "ts_proc",
            "qtd_registros",
            "ref",
        )
    )


def readiness(
    spark: SparkSession,
    control: DataFrame,
    subjects: Sequence[str],
    since_ts_proc: str | None,
) -> DataFrame:
    """Per subject: newest load, its row count, and whether it arrived after
    ``since_ts_proc`` (the last book's stamp); ``ready`` when all arrived.

    Snapshots loaded under one stamp count together. The control table is
    first reduced to one row per subject, so everything after that works on at
    most ``len(subjects)`` rows.
    """
    per_stamp = (
        control.where(F.col("assunto").isin(list(subjects))).groupBy("assunto", "ts_proc").agg(F.sum("qtd_registros").alias("rows"))
    )
    newest = F.max(F.struct("ts_proc", "rows"))
    latest = per_stamp.groupBy("assunto").agg(newest.alias("n")).select(
        "assunto", "n.ts_proc", F.col("n.rows").alias("qtd_registros")
    )
    wanted = spark.createDataFrame([(s,) for s in subjects], "assunto string")
    since = F.lit(since_ts_proc) if since_ts_proc is not None else F.lit("")
    state = wanted.join(F.broadcast(latest), "assunto", "left").withColumn(
        "received", F.coalesce(F.col("ts_proc") > since, F.lit(False))
    )
    return state.withColumn("ready", state.select(F.bool_and("received")).scalar())
