"""tierbook: layered-lake loads and per-user feature books on Spark.

Bronze snapshots -> typed, lineage-stamped silver parquet (+ control rows)
-> latest batch per subject -> category enrichment -> wide feature book.
Every step is a DataFrame operator with explicit run stamps (no wall clock).
"""

from tierbook.session import build_session, scratch_path

__all__ = ["build_session", "scratch_path"]
