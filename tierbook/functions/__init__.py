"""Column expressions used across operators (built-ins only, no UDFs)."""

from tierbook.functions.dates import (
    as_date,
    lookback_start,
    window_start,
    month_age,
    parse_ref,
    recency_flag,
    ref_stamp,
)
from tierbook.functions.lineage import (
    snapshot_file_name,
    snapshot_name,
    snapshot_ref,
    snapshot_subject,
    snapshot_ts,
)

__all__ = [
    "as_date",
    "lookback_start",
    "window_start",
    "month_age",
    "parse_ref",
    "recency_flag",
    "ref_stamp",
    "snapshot_file_name",
    "snapshot_name",
    "snapshot_ref",
    "snapshot_subject",
    "snapshot_ts",
]
