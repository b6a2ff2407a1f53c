"""Source table -> bronze CSV snapshot.

The extract is a distributed read (JDBC range partitions, or any DataFrame
standing in for the source table); executors write the snapshot directly to
the bronze folder, so nothing passes through one process.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tierbook.sinks.writers import write_bronze_snapshot


def snapshot_to_bronze(source: DataFrame, bronze_dir: str, subject: str, ref: str, ts_file_generation: str) -> str:
    """Write the whole source table as ``{subject}_{ref}_{ts}.csv``; returns its path."""
    return write_bronze_snapshot(source, bronze_dir, subject, ref, ts_file_generation)
