"""Mixing sources to target token weights by entropy balancing.

Targets: the sources, ordered by code point with null last, weigh ``WEIGHTS``
(repeated) and share ``TOTAL`` times all tokens; none exceeds ``MAX_COPIES``
times its own tokens, what it cannot take is shared again by weight.

Rates: each document's rate starts at one copy and stays between 0 and
``MAX_COPIES``. Among the rates that meet a source's token target, entropy
balancing takes those nearest the start in (bounded) relative entropy. They
are an exponential tilt, odds ``exp(dual * z)`` of the document's relative
size ``z``, with one dual variable per source. The dual is convex and one
Newton step for all sources is one aggregation over a histogram of sizes (a
row per source and size); a step that leaves the bracket of a source's root
is replaced by its middle.

Copies: a rate's whole part is taken, its fraction is rounded by systematic
sampling over the source's documents in order of size and then of a hash, so
the source's total stays within about half its largest document of the
target. Positions in that order come from sums over the histogram and, inside
one cell of it, over sub-cells of a bounded number of rows; no source, size
or group of copies is ordered in one task.

Everything is DataFrame operations; the tables that Newton's steps pass on
have a row per source and are written to the shared folder.

Edge cases: null, empty and blank texts have size 0 and are never taken;
a null source is a source of its own, ordered last; sources without tokens
have target 0; rows that repeat are separate documents (equal rows of one id
share a place in the order, so they are taken alike); an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .scratch import materialise, packed_rest

WEIGHTS = (5.0, 2.0, 1.0)
TOTAL = 1.5
MAX_COPIES = 2.0
STEPS = 40
TOLERANCE = 1e-7
CELL_ROWS = 20_000
OFFSETS = 32


def token_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text (null: 0)."""
    words = F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+")
    # blanks around the text leave empty strings at the ends
    return (F.size(words) - (F.element_at(words, 1) == "").cast("int") - ((F.size(words) > 1) & (F.element_at(words, -1) == "")).cast("int")).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, total: float = TOTAL, most: float = MAX_COPIES) -> DataFrame:
    """(source, source_size, target) from (source, source_size); a row per source.

    Shares are filled like connected vessels: a source whose limit per weight
    is small fills first. With the sources in order of limit per weight, the
    level at which the rest shares by weight is the first that no later limit
    is below.
    """
    # the order of sources needs all of them in one place: a row per source, no texts
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(place - 1, F.lit(len(weights))) + 1).cast("int"))
    weighed = sizes.withColumn("weight", weight).withColumn("limit", most * F.col("source_size"))
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    everyone = Window.partitionBy()
    full = F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    rest = F.sum("weight").over(everyone) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    leveled = (
        weighed.withColumn("everything", total * F.sum("source_size").over(everyone))
        .withColumn("level", (F.col("everything") - full) / rest)
        # the level counts where the source's own limit isn't below it
        .withColumn("level", F.when(F.col("limit") / F.col("weight") >= F.col("level"), F.col("level")))
        .withColumn("level", F.max("level").over(everyone))
    )
    return leveled.select("source", "source_size", F.least("limit", F.coalesce(F.col("level") * F.col("weight"), "limit")).alias("target"))


def _rate(dual: Column, z: Column, most: float) -> Column:
    return most / (1 + F.exp(-dual * z))


def _exact_sum(x: Column) -> Column:
    """Sum in fixed point: the same in whatever order rows arrive, so that reruns agree."""
    return F.sum(F.round(x * 1024).cast("long")) / 1024


def solve_rates(cells: DataFrame, goals: DataFrame, most: float = MAX_COPIES, steps: int = STEPS, tolerance: float = TOLERANCE) -> DataFrame:
    """``goals`` with the dual variable of each source (null where its rate is the limit or nothing is to be had).

    ``cells``: source, size, n. ``goals``: source, source_size, target.
    """
    docs = cells.groupBy("source").agg(F.sum("n").alias("docs"))
    same = F.col("g.source").eqNullSafe(F.col("d.source"))
    state = materialise(
        goals.alias("g")
        .join(docs.alias("d"), same)
        .select(
            "g.source", "source_size", "target", (F.col("source_size") / F.col("docs")).alias("mean"),
            F.lit(0.0).alias("dual"), F.lit(-700.0).alias("low"), F.lit(700.0).alias("high"),
            ((F.col("target") <= 0) | (F.col("target") >= most * F.col("source_size") * (1 - 1e-12))).alias("done"),
        ),
        "duals",
    )
    for _ in range(steps):
        if state.where("NOT done").isEmpty():
            break
        z = F.col("size") / F.col("mean")
        rate = _rate(F.col("dual"), z, most)
        tokens = F.col("n") * F.col("size") * rate
        summed = (
            cells.alias("c").join(state.where("NOT done").alias("s"), F.col("c.source").eqNullSafe(F.col("s.source")))
            .groupBy(F.col("s.source").alias("of"))
            .agg(_exact_sum(tokens).alias("taken"), _exact_sum(tokens * z * (1 - rate / most)).alias("slope"))
        )
        joined = state.join(summed, F.col("source").eqNullSafe(F.col("of")) & ~F.col("done"), "left").withColumn("gap", F.col("taken") - F.col("target"))
        low = F.when(F.col("gap") < 0, F.col("dual")).otherwise(F.col("low"))
        high = F.when(F.col("gap") > 0, F.col("dual")).otherwise(F.col("high"))
        newton = F.col("dual") - F.when(F.col("slope") > 0, F.col("gap") / F.col("slope"))
        stepped = F.when((newton > F.col("new_low")) & (newton < F.col("new_high")), newton).otherwise((F.col("new_low") + F.col("new_high")) / 2)
        met = F.abs("gap") <= tolerance * F.col("target")
        state = materialise(
            joined.withColumn("new_low", low).withColumn("new_high", high).select(
                "source", "source_size", "target", "mean",
                F.when(F.col("done") | met, F.col("dual")).otherwise(stepped).alias("dual"),
                F.when(F.col("done"), F.col("low")).otherwise(F.col("new_low")).alias("low"),
                F.when(F.col("done"), F.col("high")).otherwise(F.col("new_high")).alias("high"),
                (F.col("done") | met).alias("done"),
            ),
            "duals",
        )
    return state


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=WEIGHTS,
    total: float = TOTAL,
    most: float = MAX_COPIES,
) -> DataFrame:
    """One row per input row: ``id, source, size, source_size, target, rate,
    copies, taken`` (size times copies) and the other columns, without the
    text, in the struct ``rest``."""
    sized = materialise(
        docs.select(
            F.col(id_col).alias("id"), F.col(source_col).alias("source"), token_count(F.col(text_col)).alias("size"),
            F.xxhash64(F.col(id_col), F.octet_length(text_col)).alias("key"), packed_rest(docs, id_col, text_col, source_col).alias("rest"),
        ),
        "sizes",
    )
    # a histogram with sub-cells, of documents and of the hash buckets inside each source and size
    counts = materialise(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "cells")
    goals = targets(counts.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).cast("double").alias("source_size")), weights, total, most)
    state = solve_rates(counts, goals, most)
    rate = (
        F.when(F.col("target") <= 0, 0.0)
        .when(F.col("target") >= most * F.col("source_size") * (1 - 1e-12), F.lit(most))
        .otherwise(_rate(F.col("dual"), F.col("size") / F.col("mean"), most))
    )
    rated = counts.alias("c").join(state.alias("s"), F.col("c.source").eqNullSafe(F.col("s.source"))).select(
        F.col("c.source").alias("source"), "size", "n", F.col("source_size").cast("long").alias("source_size"), "target",
        F.when(F.col("size") > 0, rate).otherwise(0.0).alias("rate"),
    )
    # before each cell: the fractions of all smaller documents of the source (a row per source and size)
    part = F.col("rate") - F.floor("rate")
    smaller = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    placed = materialise(
        rated.withColumn("part", part)
        .withColumn("before", F.coalesce(F.sum(F.col("n") * F.col("part")).over(smaller), F.lit(0.0)))
        .withColumn("subs", F.ceil(F.col("n") / CELL_ROWS)),
        "placed",
    )
    # a cell's documents are alike, so the histogram tells what each starting point would take
    offsets = [(j + 0.5) / OFFSETS for j in range(OFFSETS)]
    cell_end = F.col("before") + F.col("n") * F.col("part")
    tried = placed.groupBy("source").agg(
        *[
            F.sum(F.col("size") * (F.col("n") * F.floor("rate") + F.floor(cell_end + u) - F.floor(F.col("before") + u))).alias(f"taken_{j}")
            for j, u in enumerate(offsets)
        ],
        F.first("target").alias("goal"),
    )
    misses = F.array(*[F.struct(F.abs(F.col(f"taken_{j}") - F.col("goal")).alias("miss"), F.lit(u).alias("offset")) for j, u in enumerate(offsets)])
    chosen = tried.select("source", F.array_min(misses)["offset"].alias("offset"))
    placed = placed.alias("p").join(chosen.alias("o"), F.col("p.source").eqNullSafe(F.col("o.source"))).select("p.*", "offset")
    found = sized.alias("d").join(
        placed.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source")) & (F.col("d.size") == F.col("p.size"))
    ).select(
        "id", "d.source", "d.size", "key", "rest", "source_size", "target", "rate", "part", "before", "offset",
        F.pmod(F.col("key"), F.col("subs")).alias("sub"),
    )
    per_sub = found.groupBy("source", "size", "sub").agg(F.count("*").alias("held"))
    earlier = Window.partitionBy("source", "size").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)
    subs = per_sub.withColumn("ahead", F.coalesce(F.sum("held").over(earlier), F.lit(0)))
    inside = F.row_number().over(Window.partitionBy("source", "size", "sub").orderBy("key", "id"))
    ranked = found.withColumn("inside", inside).alias("f").join(
        subs.alias("b"),
        F.col("f.source").eqNullSafe(F.col("b.source")) & (F.col("f.size") == F.col("b.size")) & (F.col("f.sub") == F.col("b.sub")),
    )
    # systematic sampling: one more copy where the running sum of fractions passes a whole number
    start = F.col("before") + (F.col("ahead") + F.col("inside") - 1) * F.col("part")
    extra = F.floor(start + F.col("part") + F.col("offset")) - F.floor(start + F.col("offset"))
    copies = (F.floor("rate") + extra).cast("int")
    return ranked.select(
        "id", "f.source", "f.size", "source_size", "target", "rate", copies.alias("copies"),
        (F.col("f.size") * copies).alias("taken"), "rest",
    )
