"""Rolling lookback on the ``ref`` partition column.

The bound is compared as ``yyyyMMdd`` text with text, so the parquet scan
prunes whole ``ref=`` partitions (``PartitionFilters: ref >= ...``). An
unquoted 6-digit month against 8-digit refs, as the published job writes it,
is always true; ``lookback_start=None`` reproduces that (nothing pruned).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookback_filter(df: DataFrame, lookback_start: str | None, ref_col: str = "ref") -> DataFrame:
    if lookback_start is None:
        return df
    if len(lookback_start) != 8 or not lookback_start.isdigit():
        raise ValueError(f"lookback_start must be yyyyMMdd text, got {lookback_start!r}")
    return df.where(F.col(ref_col) >= F.lit(lookback_start))
