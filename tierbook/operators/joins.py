"""Enrichment joins with a checked broadcast and a skew-safe fallback.

A dimension side is broadcast only after its row count has been checked
(passed in from a proven source, or measured with ``count()``: one partial
count per task and a one-row merge). Beyond the bound the join is a shuffle
join whose hot keys are salted adaptively:

* a key (the NULL key too, which would otherwise land in one task) is hot
  when it holds more fact rows than one balanced task would
  (``rows_per_task``, total rows / ``spark.sql.shuffle.partitions`` at least);
  fewer keys than there are shuffle partitions can qualify, so the hot-key
  table is itself safe to broadcast, whatever ``rows_per_task`` is given;
* a hot key with ``n`` rows is split over ``ceil(n / rows_per_task)`` salts,
  so a key holding a third of all rows spreads over a third of the tasks,
  and no join task receives much more than ``rows_per_task`` rows of one key;
* its dimension rows are replicated once per salt (in total at most about
  twice the number of shuffle partitions extra rows).

Keys and counts are found exactly with a map-side combined aggregation over
the key column only. AQE's skew-join split stays on as a second line of
defence.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierbook.session import shared_root

DEFAULT_MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 256 << 20

SALT = "_salt"
SALTS = "_salts"
HOT_KEY = "_hot_key"


def fits_broadcast(
    df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS, known_rows: int | None = None, max_bytes: int = MAX_BROADCAST_BYTES
) -> bool:
    """True when the side has at most ``max_rows`` rows and ``max_bytes`` bytes.

    One aggregation measures both; a caller who knows that there are too many
    rows (``known_rows``) saves it, but no side is broadcast unmeasured.
    """
    if max_rows <= 0 or (known_rows is not None and known_rows > max_rows):
        return False
    size = F.lit(16).cast("long")
    for f in df.schema.fields:
        text = isinstance(f.dataType, (T.StringType, T.BinaryType))
        size = size + (F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) + 8 if text else F.lit(16))
    rows, total = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return rows <= max_rows and total <= max_bytes


def key_counts(fact: DataFrame, key: str) -> DataFrame:
    """Rows per key, NULL keys included as one group (map-side combined)."""
    return fact.select(key).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))


def hot_keys(fact: DataFrame, key: str, rows_per_task: int | None = None) -> DataFrame:
    """``(key, _salts)`` for every key (NULL included) holding more than
    ``rows_per_task`` rows.

    Only the key column is read. The per-key counts are checkpointed to the
    shared checkpoint folder, so it is scanned once for both the total and the
    hot-key filter. The bound is at least total / shuffle partitions, so fewer
    keys than there are shuffle partitions are hot.
    """
    spark = fact.sparkSession
    shared_root(spark)  # checkpoint folder: the session's, else a test one
    counts = key_counts(fact, key).checkpoint()
    total = counts.agg(F.sum("_rows")).first()[0] or 0
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows_per_task = max(1, math.ceil(total / max(1, partitions)), rows_per_task or 0)
    return counts.where(F.col("_rows") > F.lit(rows_per_task)).select(
        key, F.ceil(F.col("_rows") / F.lit(rows_per_task)).cast("int").alias(SALTS)
    )


def salted_left_join(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    rows_per_task: int | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Left join on ``key`` with every hot key (NULL too) split over enough tasks.

    NULL keys never match, so their rows are only spread, while the
    dimension rows of a hot non-NULL key are replicated once per salt. The
    salt is a hash of the row and of the task it comes from, so that equal rows
    of a hot key are spread too. ``counted``: rows with the same keys that are
    cheaper to read than ``fact``.
    """
    hot = F.broadcast(hot_keys(fact if counted is None else counted, key, rows_per_task).withColumnRenamed(key, HOT_KEY))
    # A pure function of the row content and the partition, so a retried map
    # task sends every row to the same reducer as the first attempt did.
    row_hash = F.xxhash64(*(F.col(c) for c in fact.columns), F.spark_partition_id())
    salted_fact = (
        fact.join(hot, fact[key].eqNullSafe(F.col(HOT_KEY)), "left")
        .withColumn(SALT, F.coalesce(F.pmod(row_hash, F.col(SALTS)), F.lit(0)).cast("int"))
        .drop(SALTS, HOT_KEY)
    )
    salted_dim = (
        dim.join(hot, dim[key] == F.col(HOT_KEY), "left")
        .withColumn(SALT, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(SALTS), F.lit(1)) - F.lit(1))))
        .drop(SALTS, HOT_KEY)
    )
    return salted_fact.join(salted_dim.hint("merge"), [key, SALT], "left").drop(SALT)


def left_join_dimension(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    dim_rows: int | None = None,
    rows_per_task: int | None = None,
) -> DataFrame:
    """``fact LEFT JOIN dim USING (key)``; duplicate dim keys fan out."""
    if fits_broadcast(dim, max_broadcast_rows, dim_rows):
        return fact.join(F.broadcast(dim), key, "left")
    return salted_left_join(fact, dim, key, rows_per_task)
