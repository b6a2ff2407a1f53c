"""Bronze rows -> typed, lineage-stamped silver rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierbook.functions import lineage
from tierbook.schemas import FAULTS, RAW, SubjectSpec


def lineage_columns(
    raw: DataFrame,
    ts_proc: str,
    path_col: str = "_file_path",
    snapshot_path: str | None = None,
) -> DataFrame:
    """Add filename, ref, ts_file_generation (from the snapshot name) and ts_proc.

    With ``snapshot_path`` (a load of one known snapshot) the stamps are
    parsed once; otherwise each row's file path is parsed.
    """
    if snapshot_path is not None:
        name, _, ref, tsf = lineage.parse_snapshot_name(snapshot_path)
        cols = {"filename": F.lit(name), "ref": F.lit(ref), "ts_file_generation": F.lit(tsf)}
        return raw.withColumns({**cols, "ts_proc": F.lit(ts_proc)})
    named = raw.withColumn("filename", lineage.snapshot_name_of_file(F.col(path_col)))
    _, ref, tsf = lineage.name_parts(F.col("filename"))
    return named.withColumns({"ref": ref, "ts_file_generation": tsf, "ts_proc": F.lit(ts_proc)})


def _typed(f: T.StructField) -> Column:
    src = F.col(f.name)
    return src if isinstance(f.dataType, T.StringType) else src.try_cast(f.dataType)


def misfit(f: T.StructField) -> Column:
    """True where the text of a column has a value that its type can't hold:
    it does not parse, or is a decimal with more digits than the scale keeps."""
    src = F.col(f.name)
    if isinstance(f.dataType, T.StringType):
        return F.lit(False)
    lost = _typed(f).isNull()
    if isinstance(f.dataType, T.DecimalType):
        whole = f.dataType.precision - f.dataType.scale
        lost = lost | (_typed(f) != src.try_cast(T.DecimalType(38, 38 - whole)))
    return src.isNotNull() & F.coalesce(lost, F.lit(True))


def typed_projection(df: DataFrame, spec: SubjectSpec) -> DataFrame:
    """Lineage columns then the subject's columns, cast by name.

    Extra source columns are dropped; a missing one fails analysis. Values
    that do not parse become NULL (``try_cast``) instead of failing the load.
    """
    cols = [F.col(c).cast("string").alias(c) for c in ("ref", "ts_file_generation", "ts_proc")]
    return df.select(*cols, *[_typed(f).alias(f.name) for f in spec.columns.fields])


def marked_projection(df: DataFrame, spec: SubjectSpec) -> DataFrame:
    """``typed_projection`` and, of a row with misfits, their columns' names
    (``FAULTS``, comma-separated) and the text of all columns (``RAW``)."""
    bad = F.concat_ws(",", *[F.when(misfit(f), f.name) for f in spec.columns.fields])
    df = df.withColumn(FAULTS, F.nullif(bad, F.lit("")))
    text = F.struct(*[F.col(f.name).cast("string").alias(f.name) for f in spec.columns.fields])
    extra = [F.col(FAULTS), F.when(F.col(FAULTS).isNotNull(), text).alias(RAW)]
    cols = [F.col(c).cast("string").alias(c) for c in ("ref", "ts_file_generation", "ts_proc")]
    return df.select(*cols, *[_typed(f).alias(f.name) for f in spec.columns.fields], *extra)


def to_silver(
    raw: DataFrame,
    spec: SubjectSpec,
    ts_proc: str,
    path_col: str = "_file_path",
    snapshot_path: str | None = None,
) -> DataFrame:
    return typed_projection(lineage_columns(raw, ts_proc, path_col, snapshot_path), spec)
