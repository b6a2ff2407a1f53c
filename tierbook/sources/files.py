"""Bronze snapshot discovery and CSV reads.

A snapshot that is a folder of part files counts once the subject's manifest
names it; one that is a single file is an atomic object and counts as it is. So
discovery reads the manifest (a log whose number of files is bounded) and
lists what lies directly in the subject's folder, never the part files.
``list_snapshots`` lists every file through Spark's file index instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierbook.functions import lineage
from tierbook.sources.log import Log
from tierbook.sources.storage import list_folder

# Reads back what the bronze writer produces: doubled quotes inside quoted fields.
CSV_OPTIONS = {"header": "true", "escape": '"', "quote": '"'}

MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("snapshot_path", T.StringType()),
        T.StructField("snapshot", T.StringType()),
        T.StructField("ref", T.StringType()),
        T.StructField("ts_file_generation", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("line_breaks", T.BooleanType()),
        T.StructField("null_marker", T.StringType()),
        T.StructField("columns", T.ArrayType(T.StringType())),
        T.StructField("committed_ms", T.LongType()),
    ]
)


def manifest_path(subject_dir: str) -> str:
    return f"{subject_dir.rstrip('/')}/manifest"


def manifest_log(spark: SparkSession, subject_dir: str) -> Log:
    return Log(spark, manifest_path(subject_dir), MANIFEST_SCHEMA)


def read_manifest(spark: SparkSession, subject_dir: str) -> DataFrame:
    """One row per committed snapshot (none if nothing was committed yet)."""
    rows = manifest_log(spark, subject_dir).rows()
    newest = rows.groupBy("snapshot").agg(F.max_by(F.struct(*rows.columns), "version").alias("n")).select("n.*")
    return newest.select(*MANIFEST_SCHEMA.fieldNames())


def manifest_row(spark: SparkSession, path: str):
    """The manifest's row of one snapshot; None for one that was delivered from outside."""
    subject_dir, name = path.rstrip("/").rsplit("/", 1)
    rows = manifest_log(spark, subject_dir).rows().where(F.col("snapshot") == name).collect()  # one, or a few if it was committed again
    return max(rows, key=lambda r: r["version"], default=None)


class NoSnapshotError(FileNotFoundError):
    pass


def list_snapshots(spark: SparkSession, bronze_dir: str, subject: str) -> DataFrame:
    """One row per snapshot of ``subject``: path, name, ref, stamp, newest mtime."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.csv")
        .load(bronze_dir)
        .select("path", "modificationTime")
    )
    name = lineage.snapshot_name(F.col("path"))
    # Snapshot root = path up to and including the snapshot name.
    root = F.regexp_extract(F.col("path"), r"^(.*?/[^/]+_\d{8}_\d{14}\.csv)(?:/|$)", 1)
    return (
        files.where(lineage.snapshot_subject(F.col("path")) == F.lit(subject))
        .select(
            root.alias("snapshot_path"),
            name.alias("snapshot"),
            lineage.snapshot_ref(F.col("path")).alias("ref"),
            lineage.snapshot_ts(F.col("path")).alias("ts_file_generation"),
            F.col("modificationTime"),
            (F.col("path") != root).alias("in_folder"),
        )
        .groupBy("snapshot_path", "snapshot", "ref", "ts_file_generation")
        .agg(F.max("modificationTime").alias("modified"), F.bool_or("in_folder").alias("is_folder"))
    )


def committed_snapshots(spark: SparkSession, subject_dir: str, subject: str) -> DataFrame:
    """The snapshots of ``subject`` that are complete: the folders that the
    manifest names and that are there, and single files."""
    subject_dir = subject_dir.rstrip("/")
    here = [
        (f"{subject_dir}/{e.name}", e.name, *lineage.parse_snapshot_name(e.name)[2:], e.modified_ms, e.is_folder)
        for e in list_folder(spark, subject_dir)
        if lineage.is_snapshot_of(e.name, subject)
    ]
    there = spark.createDataFrame(
        here, "snapshot_path string, snapshot string, ref string, ts_file_generation string, modified_ms long, is_folder boolean"
    )
    named = read_manifest(spark, subject_dir).select("snapshot", "committed_ms")
    found = there.join(named, "snapshot", "left").where("NOT is_folder OR committed_ms IS NOT NULL")
    modified = F.when(F.col("is_folder"), F.col("committed_ms")).otherwise(F.col("modified_ms"))
    return found.select("snapshot_path", "snapshot", "ref", "ts_file_generation", modified.alias("modified"), "is_folder")


def latest_snapshot(spark: SparkSession, bronze_dir: str, subject: str) -> str:
    """Path of the most recently modified complete snapshot (ties: newest stamp in name)."""
    snaps = committed_snapshots(spark, bronze_dir, subject)
    best = snaps.orderBy(F.col("modified").desc(), F.col("ts_file_generation").desc()).select("snapshot_path").first()
    if best is None:
        raise NoSnapshotError(f"no {subject}_<yyyyMMdd>_<yyyyMMddHHmmss>.csv under {bronze_dir}")
    return best["snapshot_path"]


def measure_line_breaks(spark: SparkSession, path: str) -> bool:
    """Whether some field of a CSV holds a line break, found by reading its lines.

    Quotes inside fields are doubled, so every whole record has an even number
    of them; a line on which a quoted field starts that ends on a later line is
    the first of its record and has an odd number. One pass over all splits.
    """
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    return bool(spark.read.text(path).agg(F.bool_or(quotes % 2 == 1)).first()[0])


def has_line_breaks(spark: SparkSession, path: str) -> bool:
    """Whether a field of the snapshot may hold a line break: what its manifest row says, else what its lines show."""
    row = manifest_row(spark, path)
    return measure_line_breaks(spark, path) if row is None or row["line_breaks"] is None else row["line_breaks"]


def read_bronze(
    spark: SparkSession, path: str, with_lineage: bool = True, schema: T.StructType | None = None, mapped: Row | None = None
) -> DataFrame:
    """Header-named, all-string CSV rows (+ the file path for lineage).

    Files are split unless fields hold line breaks. With ``schema`` every
    file must have the same header; a column of ``schema`` that it lacks fails
    when it is selected, more columns are left to the caller. ``mapped`` is the
    snapshot's manifest row, if the caller has read it. Of a snapshot without
    one, empty fields are NULL (its writer had no other mark for them).
    """
    mapped = mapped or manifest_row(spark, path)
    breaks = measure_line_breaks(spark, path) if mapped is None or mapped["line_breaks"] is None else mapped["line_breaks"]
    reader = spark.read.options(**CSV_OPTIONS).option("multiLine", str(breaks).lower())
    columns = mapped["columns"] if mapped is not None else None
    if mapped is not None and mapped["null_marker"] is not None:
        reader = reader.option("nullValue", mapped["null_marker"])
    if columns is None:
        columns = reader.csv(path).columns
    # the header's own columns, declared as text: a file with another order fails instead of being misread
    declared = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    df = reader.schema(declared).option("enforceSchema", str(schema is None).lower()).csv(path)
    if with_lineage:
        df = df.withColumn("_file_path", F.col("_metadata.file_path"))
    return df
