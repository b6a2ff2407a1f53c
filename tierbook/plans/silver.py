"""Bronze -> silver load of one subject (plus its control row).

One action writes the batch: rows whose values fit their columns and, in the
same files, the rejected ones with their text. All counts (rows, rejects,
misfits per column) ride along on that job through an ``Observation``. The
load is checked against the snapshot's manifest row and the limit of rejects
before its commit makes it visible.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from tierbook.functions.lineage import parse_snapshot_name
from tierbook.operators.control import control_row
from tierbook.operators.quality import LostRows, TooManyRejects, assert_schema
from tierbook.operators.silver import lineage_columns, marked_projection
from tierbook.schemas import FAULTS, RAW, SubjectSpec
from tierbook.sinks import commits
from tierbook.sinks.writers import write_control
from tierbook.sources.files import latest_snapshot, manifest_row, read_bronze
from tierbook.sources.storage import list_folder, make_folder, remove


@dataclass(frozen=True)
class LoadResult:
    subject: str
    snapshot_path: str
    ref: str
    ts_file_generation: str
    ts_proc: str
    rows: int
    rejected: int = 0
    faults: dict | None = None


def _report(spark: SparkSession, subject: str, control_dir: str, row: dict) -> None:
    """Write the control row of a commit, and note that it is there."""
    keys = (row["ref"], row["ts_file_generation"], row["ts_proc"])
    audit = control_row(spark, subject, *keys, row["rows"], row["rejected"], row["faults"], row["version"])
    write_control(audit, control_dir, row["ref"], row["ts_proc"], row["ts_file_generation"])
    before = list_folder(spark, f"{control_dir}/_reported")
    make_folder(spark, f"{control_dir}/_reported/{row['version']}")
    for e in before:
        if e.name != str(row["version"]):
            remove(spark, f"{control_dir}/_reported/{e.name}")


def repair_control(spark: SparkSession, subject: str, silver_dir: str, control_dir: str) -> None:
    """Write the newest commit's control row if the load died before it did.

    Every load does this first, so no older commit can lack its row.
    """
    log = commits.commit_log(spark, silver_dir)
    newest = log.last_version()
    if newest is None or any(e.name == str(newest) for e in list_folder(spark, f"{control_dir}/_reported")):
        return
    row = log.rows().orderBy(F.col("version").desc()).first()  # a version whose commit died has none
    if row is not None:
        _report(spark, subject, control_dir, row.asDict())


def load_subject(
    spark: SparkSession,
    spec: SubjectSpec,
    bronze_dir: str,
    silver_dir: str,
    control_dir: str,
    ts_proc: str,
    snapshot_path: str | None = None,
    keep_misfits: bool = False,
    max_rejected: float | None = None,
) -> LoadResult:
    """Load the newest (or the given) bronze snapshot of ``spec`` into silver.

    A row with a value that its column can't hold is rejected: kept with its
    text, counted, and not read as silver (``sources.lake.read_rejects``). With
    ``keep_misfits`` it stays a silver row whose bad values are NULL. A load that
    rejects more than the share ``max_rejected`` of its rows, or has other rows
    than the snapshot's manifest row says, fails and leaves silver as it was.
    """
    repair_control(spark, spec.name, silver_dir, control_dir)
    path = snapshot_path or latest_snapshot(spark, f"{bronze_dir.rstrip('/')}/{spec.name}", spec.name)
    _, _, ref, tsf = parse_snapshot_name(path)
    known = manifest_row(spark, path)
    raw = lineage_columns(read_bronze(spark, path, with_lineage=False, schema=spec.raw_schema, mapped=known), ts_proc, snapshot_path=path)
    silver = marked_projection(raw, spec)
    assert_schema(silver.drop(FAULTS, RAW), spec.silver_schema)
    load = commits.begin(spark, silver_dir, ref=ref, ts_proc=ts_proc, ts_file_generation=tsf)
    obs = Observation(f"silver_{spec.name}_{load.folder.rsplit('load=', 1)[1]}")
    per_column = [F.count_if(F.find_in_set(F.lit(f.name), F.col(FAULTS)) > 0).alias(f"fault_{f.name}") for f in spec.columns.fields]
    counted = silver.observe(obs, F.count(F.lit(1)).alias("rows"), F.count(FAULTS).alias("rejected"), *per_column)
    if keep_misfits:
        counted = counted.withColumns({FAULTS: F.lit(None).cast("string"), RAW: F.lit(None).cast(spec.raw_schema)})
    counted.drop(*commits.KEYS).write.parquet(load.path)
    seen = obs.get  # a missing count fails the load instead of recording an empty one
    total, rejected = int(seen["rows"]), 0 if keep_misfits else int(seen["rejected"])
    faults = {f.name: int(seen[f"fault_{f.name}"]) for f in spec.columns.fields if seen[f"fault_{f.name}"]}
    if known is not None and known["rows"] is not None and known["rows"] != total:
        raise LostRows(f"{path}: {known['rows']} rows were written, {total} were read")
    if max_rejected is not None and rejected > max_rejected * total:
        raise TooManyRejects(f"{path}: {rejected} of {total} rows rejected ({faults})")
    version = commits.commit(spark, load, total - rejected, rejected, faults)
    row = {**load.key, "rows": total - rejected, "rejected": rejected, "faults": faults, "version": version}
    _report(spark, spec.name, control_dir, row)
    return LoadResult(spec.name, path, ref, tsf, ts_proc, total - rejected, rejected, faults)
