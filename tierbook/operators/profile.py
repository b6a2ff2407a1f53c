"""What a batch looks like: exact counts and mergeable sketches per column.

One aggregation per batch writes, for every column, its rows, NULLs, least and
greatest value (exact), a sketch of its distinct values and, of numbers and
dates, one of its quantiles. Sketches of parts merge into the sketch of the
whole, so a day, a month or all history is profiled from the stored rows
without reading the data again, and two batches are compared by them alone.

A column's row is at most some tens of kilobytes, whatever the batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DISTINCT_BITS = 12  # relative standard error about 1.6 %
QUANTILE_K = 200  # rank error about 1.3 %
SHARES = tuple(i / 100 for i in range(1, 100))
PROFILE = ("column", "rows", "nulls", "least", "greatest", "distinct", "quantiles")


def _number(df: DataFrame, name: str) -> Column | None:
    """The column as a number, where its order is one's."""
    kind, col = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, T.NumericType):
        return col.cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(col).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return col.cast("timestamp").cast("double")
    return None


def profile(df: DataFrame, keys: Sequence[str] = (), columns: Sequence[str] | None = None) -> DataFrame:
    """A row per batch (``keys``) and column: ``PROFILE``, the last two as sketches. One pass."""
    columns = list(columns) if columns is not None else [c for c in df.columns if c not in keys]
    aggs = []
    for i, c in enumerate(columns):
        col = F.col(f"`{c}`")
        number = _number(df, c)
        quantiles = F.lit(None).cast("binary") if number is None else F.kll_sketch_agg_double(number, F.lit(QUANTILE_K))
        aggs.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count(F.lit(1)).alias("rows"),
                F.count_if(col.isNull()).alias("nulls"),
                F.min(col).cast("string").alias("least"),
                F.max(col).cast("string").alias("greatest"),
                F.hll_sketch_agg(col.cast("string"), F.lit(DISTINCT_BITS)).alias("distinct"),
                quantiles.alias("quantiles"),
            ).alias(f"_c{i}")
        )
    wide = df.groupBy(*keys).agg(*aggs)
    one = F.explode(F.array(*[F.col(f"_c{i}") for i in range(len(columns))])).alias("p")
    return wide.select(*keys, one).select(*keys, "p.*")


def merge(profiles: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The profile of the union of batches, from their profiles alone (``least`` and ``greatest`` are left out: as text they have no order)."""
    return profiles.groupBy(*keys, "column").agg(
        F.sum("rows").alias("rows"),
        F.sum("nulls").alias("nulls"),
        F.hll_union_agg("distinct").alias("distinct"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"),
    )


def _some(sketch: str) -> Column:
    """Whether a sketch of quantiles has seen a value."""
    return F.coalesce(F.kll_sketch_get_n_double(sketch), F.lit(0)) > 0


def summary(profiles: DataFrame, shares: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Sketches turned into numbers: ``n_distinct`` and ``quantile`` (an array, by ``shares``)."""
    wanted = F.array(*[F.lit(float(s)) for s in shares])
    some = _some("quantiles")
    return profiles.select(
        *[c for c in profiles.columns if c not in ("distinct", "quantiles")],
        F.hll_sketch_estimate("distinct").alias("n_distinct"),
        F.when(some, F.kll_sketch_get_quantile_double("quantiles", wanted)).alias("quantile"),
    )


def distance(old: DataFrame, new: DataFrame, shares: Sequence[float] = SHARES) -> DataFrame:
    """How far two batches lie apart, per column, from their profiles (one row per column each).

    ``null_shift`` and ``distinct_ratio`` compare shares of NULL and numbers of
    distinct values; ``rank_shift`` is the largest difference between the shares
    of the old and of the new batch up to a value (0 to 1), read off both batches'
    quantiles at ``shares``.
    """
    cols = ("rows", "nulls", "distinct", "quantiles")
    a = old.select("column", *[F.col(c).alias(f"{c}0") for c in cols])
    b = new.select("column", *[F.col(c).alias(f"{c}1") for c in cols])
    wanted = F.array(*[F.lit(float(s)) for s in shares])
    joined = a.join(b, "column")
    for n in (0, 1):
        joined = joined.withColumn(f"q{n}", F.when(_some("quantiles0") & _some("quantiles1"), F.kll_sketch_get_quantile_double(f"quantiles{n}", wanted)))

    def up_to(n: int, value: Column) -> Column:
        return F.size(F.filter(f"q{n}", lambda x: x <= value))

    gaps = F.transform(F.array_union("q0", "q1"), lambda v: F.abs(up_to(0, v) - up_to(1, v)) / F.lit(len(shares)))
    return joined.select(
        "column",
        (F.try_divide("nulls1", "rows1") - F.try_divide("nulls0", "rows0")).alias("null_shift"),
        F.try_divide(F.hll_sketch_estimate("distinct1").cast("double"), F.hll_sketch_estimate("distinct0").cast("double")).alias("distinct_ratio"),
        F.when(F.col("q0").isNotNull(), F.array_max(gaps)).alias("rank_shift"),
    )
