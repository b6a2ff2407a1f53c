"""Words and word shingles as DataFrame expressions (no Python on executors)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = "[\\x20\\x09-\\x0D]+"


def with_shingles(df: DataFrame, words: Column, size: int, out: str) -> DataFrame:
    """``df`` with the column ``out``: the hash of each run of ``size`` words, in
    order, repeats kept; of fewer words the hash of the whole sequence; none
    without words. ``words`` may hold empty strings, which don't count.

    Explode the result with the ``_outer`` functions: for the others Catalyst
    infers a filter on the array's size and pushes it below the projections,
    where the words would be split anew for every shingle."""
    hashed = df.withColumn("_words", F.transform(F.array_remove(words, ""), lambda w: F.xxhash64(w)))
    n = F.size("_words")
    run = F.transform(
        F.slice("_words", 1, F.greatest(n - (size - 1), F.lit(0))),
        lambda x, i: F.xxhash64(x, *[F.get("_words", i + k) for k in range(1, size)]),
    )
    return hashed.withColumn(
        out, F.when(n >= size, run).when(n > 0, F.array(F.xxhash64("_words"))).otherwise(F.array().cast("array<bigint>"))
    ).drop("_words")


def lower_words(text: Column) -> Column:
    return F.split(F.lower(F.coalesce(text, F.lit(""))), SPACE)
