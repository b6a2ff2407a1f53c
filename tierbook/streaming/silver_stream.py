"""New bronze snapshots -> silver, incrementally.

Two streams meet: the subject's manifest, which gets a row once a snapshot of
this library is complete, and the single-file snapshots that others put beside
it (an atomic object each). A folder still being written is in neither, and its
part files are always loaded together. Each micro-batch runs the batch load for its
snapshots, so silver, control rows (a header-only snapshot's zero row too) and
checks are the same. The checkpoint (in the shared folder) records which
files were consumed: a rerun with nothing new writes nothing, and a
lost driver resumes where it stopped.

Replays are idempotent: a micro-batch's stamp and snapshots are written beside
the checkpoint when it is first tried. A replay of the same batch takes its stamp
from there, whatever stamp the new run was given; a snapshot that an earlier
batch took (seen by both streams, or folded into another file of the manifest)
is not loaded again; every load replaces its own batch.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tierbook.functions import lineage
from tierbook.plans.silver import load_subject
from tierbook.schemas import SubjectSpec
from tierbook.sources.files import manifest_log, manifest_path
from tierbook.sources.log import Log
from tierbook.sources.storage import make_folder

STAMP = "%Y%m%d%H%M%S"

BATCH_SCHEMA = T.StructType(
    [
        T.StructField("batch", T.LongType()),
        T.StructField("ts_proc", T.StringType()),
        T.StructField("snapshots", T.ArrayType(T.StringType())),
    ]
)
FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def batch_ts_proc(base_ts_proc: str, batch_id: int) -> str:
    """``base + batch_id`` seconds, as a fixed-width stamp."""
    base = dt.datetime.strptime(base_ts_proc, STAMP)
    return (base + dt.timedelta(seconds=batch_id)).strftime(STAMP)


def plan_batch(spark: SparkSession, checkpoint_dir: str, batch_id: int, base_ts_proc: str, snapshots: list[str]) -> tuple[str, list[str]]:
    """(stamp, snapshots to load) of a micro-batch: what it was first tried with."""
    log = Log(spark, f"{checkpoint_dir.rstrip('/')}-batches", BATCH_SCHEMA)
    tried = log.rows()
    own = tried.where(F.col("batch") == batch_id).orderBy("version").first()
    if own is not None:
        return own["ts_proc"], list(own["snapshots"])
    wanted = spark.createDataFrame([(s,) for s in snapshots], "snapshot string")
    taken = tried.select(F.explode("snapshots").alias("snapshot"))
    fresh = sorted(r["snapshot"] for r in wanted.join(taken, "snapshot", "left_anti").collect())
    ts_proc = batch_ts_proc(base_ts_proc, batch_id)
    log.append({"batch": batch_id, "ts_proc": ts_proc, "snapshots": fresh})
    return ts_proc, fresh


def snapshot_stream(spark: SparkSession, subject_dir: str, subject: str) -> DataFrame:
    """A row (snapshot, the name) per snapshot that is complete; one may come more than once."""
    make_folder(spark, manifest_path(subject_dir))  # nothing may have been committed yet
    files = spark.readStream.option("recursiveFileLookup", "true")
    # entries that were folded into one file since they were listed are found there
    manifest = files.option("ignoreMissingFiles", "true").schema(manifest_log(spark, subject_dir).schema).parquet(manifest_path(subject_dir))
    stamps = f"_{'[0-9]' * 8}_{'[0-9]' * 14}.csv"
    single = (
        spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("pathGlobFilter", subject + stamps).load(f"{subject_dir}/{subject}{stamps}")
    )
    return manifest.select("snapshot").union(single.select(lineage.snapshot_name(F.col("path")).alias("snapshot")))


def start_silver_stream(
    spark: SparkSession,
    spec: SubjectSpec,
    bronze_dir: str,
    silver_dir: str,
    control_dir: str,
    checkpoint_dir: str,
    base_ts_proc: str,
    available_now: bool = True,
    **load_options,
) -> StreamingQuery:
    """Start the stream over the snapshots of ``spec``."""
    subject_dir = f"{bronze_dir.rstrip('/')}/{spec.name}"

    def load(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        names = [r["snapshot"] for r in batch.select("snapshot").distinct().orderBy("snapshot").collect()]
        if not names:
            return
        ts_proc, fresh = plan_batch(session, checkpoint_dir, batch_id, base_ts_proc, names)
        for name in fresh:  # a row per new snapshot; the loads themselves are distributed
            load_subject(session, spec, bronze_dir, silver_dir, control_dir, ts_proc, f"{subject_dir}/{name}", **load_options)

    writer = snapshot_stream(spark, subject_dir, spec.name).writeStream.foreachBatch(load).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def run_silver_stream(*args, **kwargs) -> None:
    """Process every snapshot that is complete, then stop."""
    query = start_silver_stream(*args, **kwargs)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
