"""Layer writers.

Silver and gold are laid out by their batch, ``ref / ts_proc /
ts_file_generation``; a load writes a folder of its own below it and becomes
visible by its commit row (``sinks.commits``), so a retried or replayed load
replaces its batch's rows (also by none) at once and touches no other batch.
Control rows are laid out by the same keys, a row per load. No repartition by
the partition columns: one load has one of each, so that would funnel the
whole load into a single task.

A bronze snapshot is a folder of part files; it counts only once its row is
in the subject's manifest, which is written after the CSV is committed. NULL is
written as a marker that occurs nowhere else, so that it, empty text and rows
of nothing but NULL come back as they were.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tierbook.functions.lineage import parse_snapshot_name, snapshot_file_name
from tierbook.sinks import commits
from tierbook.sources.files import CSV_OPTIONS, manifest_log, manifest_row


def bronze_snapshot_path(bronze_dir: str, subject: str, ref: str, ts_file_generation: str) -> str:
    return f"{bronze_dir.rstrip('/')}/{subject}/{snapshot_file_name(subject, ref, ts_file_generation)}"


# A snapshot whose fields hold line breaks is read with multiLine, which makes
# every file a single split; capping rows per file keeps that load parallel
# however few tasks wrote the snapshot (~1 GB at 200 B/row).
BRONZE_MAX_RECORDS_PER_FILE = 5_000_000


def write_bronze_snapshot(
    df: DataFrame,
    bronze_dir: str,
    subject: str,
    ref: str,
    ts_file_generation: str,
    max_records_per_file: int = BRONZE_MAX_RECORDS_PER_FILE,
) -> str:
    """Raw snapshot as CSV text (header, RFC-4180 quoting, blanks kept).

    Never replaces a committed snapshot; what a failed write of the same name
    left behind is not committed, and is overwritten.
    """
    path = bronze_snapshot_path(bronze_dir, subject, ref, ts_file_generation)
    spark = df.sparkSession
    if manifest_row(spark, path) is not None:
        raise FileExistsError(f"{path} is committed already")
    as_text = df.select(*(F.col(f"`{c}`").cast("string").alias(c) for c in df.columns))
    texts = [f.name for f in df.schema.fields if f.dataType.simpleString() in ("string", "binary") or f.dataType.simpleString().startswith(("char", "varchar"))]
    while True:
        marker = f"<null:{uuid.uuid4().hex[:8]}>"
        none = F.lit(False)
        breaks = [F.coalesce(F.max(F.col(f"`{c}`").rlike("[\\r\\n]")), none) for c in texts]
        taken = [F.coalesce(F.max(F.col(f"`{c}`") == marker), none) for c in texts]
        seen = Observation(f"bronze_{subject}_{ts_file_generation}_{marker}")
        counted = as_text.observe(
            seen,
            F.count(F.lit(1)).alias("rows"),
            F.greatest(*breaks, none, none).alias("line_breaks"),
            F.greatest(*taken, none, none).alias("taken"),
        )
        (
            counted.write.options(**CSV_OPTIONS)
            .option("nullValue", marker)
            .option("ignoreLeadingWhiteSpace", "false")
            .option("ignoreTrailingWhiteSpace", "false")
            .option("maxRecordsPerFile", str(max_records_per_file))
            .mode("overwrite")
            .csv(path)
        )
        if not seen.get["taken"]:  # else some field is the marker itself: write again with another
            break
    commit_snapshot(spark, bronze_dir, subject, path, bool(seen.get["line_breaks"]), int(seen.get["rows"]), marker, df.columns)
    return path


def commit_snapshot(
    spark: SparkSession,
    bronze_dir: str,
    subject: str,
    path: str,
    line_breaks: bool | None = None,
    rows: int | None = None,
    null_marker: str | None = None,
    columns: list[str] | None = None,
) -> None:
    """Add one complete snapshot to the subject's manifest (for one that was
    delivered from outside, call this once all its files are there; what is
    not given is measured when it is read)."""
    name, _, ref, tsf = parse_snapshot_name(path)
    row = dict(snapshot_path=path, snapshot=name, ref=ref, ts_file_generation=tsf, rows=rows, line_breaks=line_breaks)
    row.update(null_marker=null_marker, columns=columns, committed_ms=int(time.time() * 1000))
    manifest_log(spark, f"{bronze_dir.rstrip('/')}/{subject}").append(row)


def _leaf(root: str, ref: str, ts_proc: str, ts_file_generation: str) -> str:
    return f"{root.rstrip('/')}/ref={ref}/ts_proc={ts_proc}/ts_file_generation={ts_file_generation}"


def _write_load(df: DataFrame, load: commits.Load, name: str) -> int:
    """Write a load's folder; returns its rows."""
    seen = Observation(f"{name}_{load.folder.rsplit('load=', 1)[1]}")
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(load.path)
    return int(seen.get["rows"])


def write_silver(df: DataFrame, silver_dir: str, ref: str, ts_proc: str, ts_file_generation: str) -> None:
    """Make ``df`` (every row of it belongs to one batch) the content of that batch."""
    load = commits.begin(df.sparkSession, silver_dir, ref=ref, ts_proc=ts_proc, ts_file_generation=ts_file_generation)
    rows = _write_load(df.drop("ref", "ts_proc", "ts_file_generation"), load, "silver")
    commits.commit(df.sparkSession, load, rows)


def write_gold(df: DataFrame, gold_dir: str, ref: str, ts_proc: str) -> int:
    """Make ``df`` the book of one run (also an empty one); returns its rows."""
    load = commits.begin(df.sparkSession, gold_dir, ref=ref, ts_proc=ts_proc)
    rows = _write_load(df.drop("ref", "ts_proc"), load, "gold")
    commits.commit(df.sparkSession, load, rows)
    return rows


def write_control(row: DataFrame, control_dir: str, ref: str, ts_proc: str, ts_file_generation: str) -> None:
    """Overwrite the audit row of one load."""
    data = row.drop("ref", "ts_proc", "ts_file_generation")
    data.coalesce(1).write.mode("overwrite").parquet(_leaf(control_dir, ref, ts_proc, ts_file_generation))
