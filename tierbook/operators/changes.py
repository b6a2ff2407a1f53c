"""What changed between snapshots of one table, and the history of every key.

The layers keep whole snapshots; rows are compared here, by key. Only the key
and a digest of the row travel: equal keys of one snapshot are combined before
the shuffle into a count and two sums of row hashes, which do not depend on
order, so repeated keys compare as the multisets of their rows. The full rows are
joined only to the keys that changed.

NULL is a key like any other. Columns are compared by value, NULLs as equal.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierbook.operators.joins import fits_broadcast

_KEY, _SIDE = "_key_", "_side"


def _hashes(columns: Sequence[str]) -> tuple[Column, Column]:
    cols = [F.col(f"`{c}`") for c in columns]
    # a NULL leaves the running hash as it is, so NULLs are marked by their place
    marked = [x for c in cols for x in (c.isNull(), c)]
    return F.xxhash64(F.lit(1), *marked), F.xxhash64(F.lit(2), *marked)


def _digests(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Two hashes per row, as decimals that can be summed without overflow."""
    one, two = _hashes(columns)
    return df.select(*[F.col(f"`{k}`").alias(f"{_KEY}{i}") for i, k in enumerate(keys)], *[h.cast("decimal(20,0)").alias(n) for h, n in ((one, "_h1"), (two, "_h2"))])


def _same_keys(a: DataFrame, b: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    cond = None
    for x, y in pairs:
        one = a[x].eqNullSafe(b[y])
        cond = one if cond is None else cond & one
    return cond


def _rows_of(df: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``df`` whose key is in ``wanted`` (broadcast where a measurement allows it), with its other columns."""
    side = F.broadcast(wanted) if fits_broadcast(wanted) else wanted
    return df.join(side, _same_keys(df, wanted, [(k, f"{_KEY}{i}") for i, k in enumerate(keys)]))


def snapshot_changes(old: DataFrame, new: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Rows of the keys that differ: ``change`` (inserted, updated, deleted) and the
    columns as they are after it (of a deleted key: as they were).

    ``columns`` are compared and returned beside the keys (all others by default).
    """
    columns = list(columns) if columns is not None else [c for c in new.columns if c not in keys]
    names = [f"{_KEY}{i}" for i in range(len(keys))]
    both = _digests(old, keys, columns).withColumn(_SIDE, F.lit(0)).unionByName(_digests(new, keys, columns).withColumn(_SIDE, F.lit(1)))

    def side(n: int, value: Column) -> Column:
        return F.sum(F.when(F.col(_SIDE) == n, value))

    per_key = both.groupBy(*names).agg(
        *[side(n, F.lit(1)).alias(f"n{n}") for n in (0, 1)],
        *[side(n, F.col(h)).alias(f"{h}{n}") for n in (0, 1) for h in ("_h1", "_h2")],
    )
    change = (
        F.when(F.col("n0").isNull(), "inserted")
        .when(F.col("n1").isNull(), "deleted")
        .when((F.col("n0") != F.col("n1")) | (F.col("_h10") != F.col("_h11")) | (F.col("_h20") != F.col("_h21")), "updated")
    )
    changed = per_key.select(*names, change.alias("change")).where("change IS NOT NULL")
    parts = []
    for df, kept in ((new, "change != 'deleted'"), (old, "change = 'deleted'")):
        rows = df.select(*[F.col(f"`{c}`") for c in (*keys, *columns)])
        parts.append(_rows_of(rows, changed.where(kept), keys).select(*[F.col(f"`{k}`") for k in keys], "change", *[F.col(f"`{c}`") for c in columns]))
    return parts[0].unionByName(parts[1])


def key_history(df: DataFrame, keys: Sequence[str], stamp: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Validity intervals over all snapshots in ``df``, which ``stamp`` (columns) tells apart and orders.

    One row per row and interval in which its key did not change: the keys, the
    columns, ``valid_from`` (the stamp of the first snapshot that has it so) and
    ``valid_to`` (that of the first one that has it otherwise or no more; NULL while it holds).

    A key has as many narrow rows as there are snapshots; values are joined
    only to the first row of each interval.
    """
    columns = list(columns) if columns is not None else [c for c in df.columns if c not in (*keys, *stamp)]
    names = [f"{_KEY}{i}" for i in range(len(keys))]
    at = F.concat_ws("/", *[F.col(f"`{c}`") for c in stamp])
    # the snapshots in order: one row per load, numbered
    stamps = sorted(r[0] for r in df.select(at.alias("s")).distinct().collect())
    number = F.array_position(F.array(*[F.lit(s) for s in stamps] or [F.lit("")]), F.col("_at")).cast("int")
    one, two = _hashes(columns)
    rows = df.select(
        at.alias("_at"), *[F.col(f"`{k}`").alias(n) for k, n in zip(keys, names)],
        F.struct(one.cast("decimal(20,0)").alias("a"), two.cast("decimal(20,0)").alias("b")).alias("h"),
    )
    per_snapshot = rows.groupBy(*names, "_at").agg(F.struct(F.count("*").alias("n"), F.sum("h.a").alias("a"), F.sum("h.b").alias("b")).alias("digest"))
    per_snapshot = per_snapshot.withColumn("number", number)
    by_key = Window.partitionBy(*names).orderBy("number")
    before, last = F.lag("digest").over(by_key), F.lag("number").over(by_key)
    fresh = F.coalesce((before != F.col("digest")) | (last != F.col("number") - 1), F.lit(True))
    numbered = per_snapshot.withColumn("fresh", fresh).withColumn("island", F.sum(F.col("fresh").cast("int")).over(by_key.rowsBetween(Window.unboundedPreceding, 0)))
    spans = numbered.groupBy(*names, "island").agg(F.min("number").alias("a"), F.max("number").alias("b"))
    label = F.array(*[F.lit(s) for s in stamps] or [F.lit("")])
    spans = spans.select(*names, F.get(label, F.col("a") - 1).alias("valid_from"), F.get(label, F.col("b")).alias("valid_to"))
    source = df.select(at.alias("_at"), *[F.col(f"`{c}`") for c in (*keys, *columns)])
    side = F.broadcast(spans) if fits_broadcast(spans) else spans
    match = _same_keys(source, spans, [*zip(keys, names)]) & (source["_at"] == spans["valid_from"])
    return source.join(side, match).select(*[F.col(f"`{c}`") for c in (*keys, *columns)], "valid_from", "valid_to")
