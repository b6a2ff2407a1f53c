"""Latest snapshot of a versioned table.

A batch is the set of rows sharing one tuple of stamps, e.g.
``(ts_proc, ts_file_generation)``. Only the rows of the greatest batch are
kept; rows are never compared with each other. All refs of the winning batch
are kept.

``latest_batch_of_loads`` takes the stamps from the control table, which has
one row per load: the newest load with rows wins, and silver is filtered on
literals of its partition columns, so no file of an older batch is opened.

``latest_batch`` needs no control table. It resolves the stamps one at a time:
a max over the first stamp (a scan that reads no data column, but opens every
file), the next stamp's max inside the partitions already chosen, and the
result is a filter on literals. With
fixed-width digit stamps this tuple maximum equals the maximum of the
concatenated key (what ``latest_batch_by_key`` computes directly, with full
scans); if the newest first stamp only has rows whose next stamp is NULL,
the concatenated-key form is used, so the result is the same in every case.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PROC_FIRST = ("ts_proc", "ts_file_generation")  # newest processing wins
FILE_FIRST = ("ts_file_generation", "ts_proc")  # newest file wins


def batch_key(order: Sequence[str] = PROC_FIRST) -> Column:
    """Concatenated stamps (NULL if any stamp is NULL)."""
    return F.concat(*(F.col(c) for c in order))


def batch_histogram(df: DataFrame, order: Sequence[str] = PROC_FIRST) -> DataFrame:
    """Rows per batch key."""
    return df.groupBy(batch_key(order).alias("dedup_key")).agg(F.count(F.lit(1)).alias("n_rows"))


def latest_batch(df: DataFrame, order: Sequence[str] = PROC_FIRST) -> DataFrame:
    """Rows of the greatest batch, pruning by one stamp at a time.

    Runs one small job per stamp (a max over an already pruned input) and
    returns the input filtered by the winning stamps.
    """
    out = df
    for c in order:
        newest = out.where(F.col(c).isNotNull()).agg(F.max(c)).first()[0]
        if newest is None:  # no complete key below the stamps chosen so far
            return latest_batch_by_key(df, order)
        out = out.where(F.col(c) == F.lit(newest))
    return out


def latest_batch_of_loads(df: DataFrame, control: DataFrame, order: Sequence[str] = PROC_FIRST) -> DataFrame:
    """Rows of the greatest batch that ``control`` (one subject's audit rows)
    reports rows for; without such a load, what ``latest_batch`` finds."""
    loads = control.where(F.col("qtd_registros") > 0).select(*order)
    newest = loads.select(F.max(F.struct(*order)).alias("n")).select("n.*").first()
    if newest is None or any(v is None for v in newest):
        return latest_batch(df, order)
    out = df
    for c in order:
        out = out.where(F.col(c) == F.lit(newest[c]))
    return out


def latest_batch_by_key(df: DataFrame, order: Sequence[str] = PROC_FIRST) -> DataFrame:
    """Same result via the concatenated key (no pruning; any stamp widths)."""
    key = batch_key(order)
    return df.where(key == df.select(F.max(key)).scalar())
