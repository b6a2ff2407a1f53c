"""Session construction and shared-scratch resolution."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library relies on. AQE re-plans joins from runtime sizes,
# coalesces small shuffle partitions and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # The feature book aggregates ~400 buffer fields; keep it in whole-stage codegen.
    "spark.sql.codegen.maxFields": "1000",
}


def build_session(
    master: str | None = None,
    app_name: str = "tierbook",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library defaults applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Read from the session. Without one there is no folder that all executors
    see, so this fails; a private one is taken in local mode only, where driver
    and executors are one process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="tierbook-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh, never-reused folder under the shared root for one run; removed when the process ends."""
    path = f"{shared_root(spark)}/tierbook/{purpose}-{uuid.uuid4().hex[:12]}"
    atexit.register(remove_path, spark, path)
    return path


def remove_path(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is None:  # the session has ended already
        return
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark._jsc.hadoopConfiguration()).delete(found, True)
