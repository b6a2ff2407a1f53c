"""Lineage columns parsed from a snapshot's file path.

A bronze snapshot is named ``{subject}_{yyyyMMdd}_{yyyyMMddHHmmss}.csv``; it may
be a single file or a Spark output directory of part files. The pattern is
anchored on the two stamps, so subjects containing ``_`` and any directory
depth work.

The stamps are constant per snapshot, so a load of one known snapshot takes
them from its path once (``parse_snapshot_name``); only reads that span
several snapshots (a streaming micro-batch) parse each row's path, with a
single regex for the name and fixed-width substrings for the stamps.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# name, subject, ref, ts_file_generation
SNAPSHOT_PATTERN = r"(([^/]+)_(\d{8})_(\d{14})\.csv)(?:/|$)"
# Length of "_yyyyMMdd_yyyyMMddHHmmss.csv" after the subject.
_STAMP_TAIL = 28


def _group(path: Column, index: int) -> Column:
    return F.nullif(F.regexp_extract(path, SNAPSHOT_PATTERN, index), F.lit(""))


def file_path() -> Column:
    """Path of the file a row was read from (file-source metadata column)."""
    return F.col("_metadata.file_path")


def snapshot_name(path: Column | None = None) -> Column:
    return _group(file_path() if path is None else path, 1)


def snapshot_subject(path: Column | None = None) -> Column:
    return _group(file_path() if path is None else path, 2)


def snapshot_ref(path: Column | None = None) -> Column:
    return _group(file_path() if path is None else path, 3)


def snapshot_ts(path: Column | None = None) -> Column:
    return _group(file_path() if path is None else path, 4)


_NAME_ANCHORED = r"^.+_\d{8}_\d{14}\.csv$"


def snapshot_name_of_file(path: Column) -> Column:
    """Snapshot name for a row's file: the file itself or its parent folder
    (a Spark output directory of part files). Anchored tests on the last two
    path elements only; much cheaper per row than scanning the whole path."""
    parts = F.split(path, "/")
    last, parent = F.element_at(parts, -1), F.element_at(parts, -2)
    return F.when(last.rlike(_NAME_ANCHORED), last).when(parent.rlike(_NAME_ANCHORED), parent)


def name_parts(name: Column) -> tuple[Column, Column, Column]:
    """(subject, ref, ts_file_generation) of a snapshot name, by position."""
    length = F.length(name)
    tail = F.lit(_STAMP_TAIL)
    return (
        F.substring(name, F.lit(1), length - tail),
        F.substring(name, length - tail + F.lit(2), F.lit(8)),
        F.substring(name, length - tail + F.lit(11), F.lit(14)),
    )


def snapshot_file_name(subject: str, ref: str, ts_file_generation: str) -> str:
    return f"{subject}_{ref}_{ts_file_generation}.csv"


def parse_snapshot_name(path: str) -> tuple[str, str, str, str]:
    """(name, subject, ref, ts_file_generation) of a snapshot path, on the driver."""
    m = re.search(SNAPSHOT_PATTERN, path)
    if m is None:
        raise ValueError(f"not a snapshot path: {path}")
    return m.group(1), m.group(2), m.group(3), m.group(4)


def is_snapshot_of(name: str, subject: str) -> bool:
    """Whether a file or folder of this name is a snapshot of ``subject``."""
    m = re.fullmatch(SNAPSHOT_PATTERN, name)
    return m is not None and m.group(2) == subject
