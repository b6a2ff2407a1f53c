"""Per-user feature book: counts, sums, averages, minima and maxima of a
measure per listed dimension value, over the whole history and over the last
1/3/6/12 months.

Feature names are ``{stat}_{dim}_{label}[_u{k}m]``. A "last k months" window
keeps rows whose whole-month age (``int(months_between(as_of, ref))``) is at
most ``k``; future rows (negative age) are inside every window and rows with
an unparsable date are only in the whole-history features. ``qtd`` and
``sum`` are NULL, not 0, when nothing matches.

Two physical plans give identical results:

* ``one_stage``: one ``groupBy(user)`` with a conditional aggregate per
  feature (the textbook form), over the narrow rows of each user.
* ``two_stage`` (default): rows are first reduced to at most
  ``(|dim1|+1) x (|dim2|+1) x (|windows|+1)`` partial rows per user
  (count, non-null count, sum, min, max) -- map-side combined, so a user
  holding a third of all rows collapses to a handful of rows per task before
  any shuffle -- then the partial rows are hash-partitioned by user (narrow
  rows, bounded per user) and pivoted into the wide book. All statistics
  compose exactly: avg = sum / non-null count.

Both end in a wide aggregate of some 400 buffer fields (several KB a user). In the
one-stage plan and above the broadcast bound (``pivot_rows``) its input is sorted
by user within each task, so that a task holds one wide row at a time and its
memory is that of the narrow rows, however many users it has.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierbook.functions.dates import as_date, month_age, recency_flag

STATS = ("qtd", "sum", "avg", "min", "max")

# Partial-aggregate columns (see ``to_partials``).
N, C, S, MN, MX = "_n", "_c", "_s", "_mn", "_mx"
PARTIALS = (N, C, S, MN, MX)
BUCKET = "_bucket"


@dataclass(frozen=True)
class Dimension:
    """A categorical column whose listed values each get a feature family."""

    tag: str
    column: str
    values: tuple[tuple[str, str], ...]  # (value in data, label in feature name)
    stats: tuple[str, ...] = STATS

    @property
    def key(self) -> str:
        return f"_key_{self.tag}"

    def listed(self) -> list[str]:
        return [v for v, _ in self.values]


@dataclass(frozen=True)
class Feature:
    name: str
    stat: str
    dimension: Dimension
    value: str
    window: int | None  # None = whole history
    tested: int | None  # months actually tested (differs only in literal mode)


# The one value of no column: every row counts.
TOTAL = Dimension("total", "", (("", ""),))


@dataclass(frozen=True)
class BookSpec:
    dimensions: tuple[Dimension, ...]
    windows: tuple[int, ...] = (1, 3, 6, 12)
    # also {stat}_total[_u{k}m], over all rows whatever their dimension values
    totals: bool = False
    # (stat, dimension tag, window) -> months tested instead of the window.
    window_overrides: tuple[tuple[str, str, int, int], ...] = field(default_factory=tuple)

    def features(self) -> list[Feature]:
        overrides = {(s, d, w): t for s, d, w, t in self.window_overrides}
        out = []
        for dim in self.dimensions:
            for stat in dim.stats:
                for window in (None, *self.windows):
                    for value, label in dim.values:
                        suffix = f"_u{window}m" if window is not None else ""
                        tested = overrides.get((stat, dim.tag, window), window)
                        out.append(
                            Feature(f"{stat}_{dim.tag}_{label}{suffix}", stat, dim, value, window, tested)
                        )
        for stat in TOTAL.stats if self.totals else ():
            for window in (None, *self.windows):
                suffix = f"_u{window}m" if window is not None else ""
                out.append(Feature(f"{stat}_{TOTAL.tag}{suffix}", stat, TOTAL, "", window, window))
        return out

    def feature_names(self) -> list[str]:
        return [f.name for f in self.features()]

    def boundaries(self) -> list[int]:
        """Month thresholds any feature tests; the age bucket resolution."""
        return sorted({*self.windows, *(t for *_, t in self.window_overrides)})

    def with_overrides(self, overrides: tuple[tuple[str, str, int, int], ...]) -> BookSpec:
        return replace(self, window_overrides=overrides)


# ---------------------------------------------------------------------------
# Fixed values of the published book (names and matches must be exact).
# Product categories: Livros -> livros, Roupas -> roupas,
# Eletronicos -> eletr, Jogos -> jogos.
# Payment methods: Cartao Debito -> cd, PIX -> pix, Cartao Credito -> cc,
# Boleto -> boleto.
# Family order: categories qtd, sum, avg, min, max; payments qtd, sum, min,
# max, avg. Windows 1, 3, 6, 12 months.
# In the published text the 12-month count and sum per category test the
# 6-month flag; ``literal_spec`` reproduces that.
CATEGORY_VALUES = (
    ("Livros", "livros"),
    ("Roupas", "roupas"),
    ("Eletronicos", "eletr"),
    ("Jogos", "jogos"),
)
PAYMENT_VALUES = (
    ("Cartao Debito", "cd"),
    ("PIX", "pix"),
    ("Cartao Credito", "cc"),
    ("Boleto", "boleto"),
)
CATEGORY_STATS = ("qtd", "sum", "avg", "min", "max")
PAYMENT_STATS = ("qtd", "sum", "min", "max", "avg")
WINDOWS = (1, 3, 6, 12)
LITERAL_OVERRIDES = (("qtd", "pcat", 12, 6), ("sum", "pcat", 12, 6))
# ---------------------------------------------------------------------------


def make_spec(
    category_values=CATEGORY_VALUES,
    payment_values=PAYMENT_VALUES,
    category_column: str = "product_category",
    payment_column: str = "payment_method",
    windows: tuple[int, ...] = WINDOWS,
    totals: bool = False,
) -> BookSpec:
    return BookSpec(
        (
            Dimension("pcat", category_column, tuple(category_values), CATEGORY_STATS),
            Dimension("pm", payment_column, tuple(payment_values), PAYMENT_STATS),
        ),
        tuple(windows),
        totals,
    )


REFERENCE_SPEC = make_spec()


def literal_spec(spec: BookSpec) -> BookSpec:
    """The published text's variant: 12-month qtd/sum per category use 6 months."""
    return spec.with_overrides(LITERAL_OVERRIDES)


# ---------------------------------------------------------------------------
# Row-level helpers


def month_flags(
    df: DataFrame,
    as_of,
    windows: tuple[int, ...] = WINDOWS,
    date_col: str = "ref",
) -> DataFrame:
    """Add ``flag_u{k}m`` (int 0/1): 1 when the whole-month age is <= k.

    ``age <= k`` equals ``bucket <= k`` for every window k, so the age is
    resolved through the per-day lookup (``with_age_bucket``), not per row.
    """
    bucketed = with_age_bucket(df, as_of, sorted(windows), date_col)
    out = bucketed
    for k in windows:
        out = out.withColumn(f"flag_u{k}m", recency_flag(F.col(BUCKET), k))
    return out.drop(BUCKET)


def age_bucket(age: Column, boundaries: list[int]) -> Column:
    """Smallest boundary ``b`` with ``age <= b``; NULL when in no window."""
    expr = None
    for b in boundaries:
        expr = (F if expr is None else expr).when(age <= F.lit(b), F.lit(b))
    return expr


_REF, _FOUND, _LOOKED_UP = "_ref_key", "_ref_found", "_ref_bucket"


def lookup_span_days(boundaries: list[int]) -> int:
    """Days on each side of the book date that cover every tested window."""
    return 31 * (max(boundaries, default=0) + 2)


def bucket_lookup(spark, as_of, boundaries: list[int]) -> tuple[DataFrame, dt.date]:
    """Every calendar day around ``as_of`` that some window can reach, with its
    exact bucket (the same Spark expression the per-row path uses), and the
    first day covered. Its size is fixed by the widest window (62 rows a
    month), never by the data, so it is safe to broadcast."""
    center = as_date(as_of)
    span = min(lookup_span_days(boundaries), (center - dt.date.min).days)
    start = center - dt.timedelta(days=span)
    days = spark.range(2 * span + 1).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias(_REF))
    table = days.select(
        _REF,
        age_bucket(month_age(center, F.col(_REF), is_date=True), boundaries).alias(_LOOKED_UP),
        F.lit(True).alias(_FOUND),
    )
    return table, start


def with_age_bucket(df: DataFrame, as_of, boundaries: list[int], date_col: str = "ref") -> DataFrame:
    """Add ``_bucket`` = ``age_bucket(month_age(as_of, date_col))``, evaluated
    once per calendar day instead of once per row.

    ``date_col`` is ``yyyyMMdd`` text (or int), or a DATE or TIMESTAMP. Days
    within the lookup are resolved by a broadcast hash join. Days before it
    are older than every window: NULL, as the exact expression gives (8
    characters that sort before its first day are such a day or no date at
    all). Anything else (far-future days, odd text) takes the exact expression.
    """
    is_date = isinstance(df.schema[date_col].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))
    table, first_day = bucket_lookup(df.sparkSession, as_of, boundaries)
    ref = F.col(_REF)
    if is_date:
        keyed = df.withColumn(_REF, F.to_date(date_col))
        before = ref < F.lit(first_day)
    else:
        keyed = df.withColumn(_REF, F.col(date_col).cast("string"))
        table = table.withColumn(_REF, F.date_format(_REF, "yyyyMMdd"))
        before = (F.length(ref) == F.lit(8)) & (ref < F.lit(first_day.strftime("%Y%m%d")))
    exact = age_bucket(month_age(as_of, ref, is_date), boundaries)
    joined = keyed.join(F.broadcast(table), _REF, "left")
    bucket = F.when(F.col(_FOUND), F.col(_LOOKED_UP)).when(before, F.lit(None).cast("int")).otherwise(exact)
    return joined.withColumn(BUCKET, bucket).drop(_REF, _FOUND, _LOOKED_UP)


def to_partials(df: DataFrame, amount: str) -> DataFrame:
    """Express raw rows as partial aggregates of one row each."""
    a = F.col(amount)
    return (
        df.withColumn(N, F.lit(1).cast("long"))
        .withColumn(C, a.isNotNull().cast("long"))
        .withColumn(S, a)
        .withColumn(MN, a)
        .withColumn(MX, a)
    )


def combined() -> list[Column]:
    """The measures of partial rows, combined."""
    return [F.sum(N).alias(N), F.sum(C).alias(C), F.sum(S).alias(S), F.min(MN).alias(MN), F.max(MX).alias(MX)]


def combine_partials(df: DataFrame, keys: list[str]) -> DataFrame:
    """Group partial rows by ``keys``; map-side combined before the shuffle."""
    return df.groupBy(*keys).agg(*combined())


def grouped_in_order(rows: DataFrame, keys: list[str], aggs: list[Column]) -> DataFrame:
    """``groupBy(keys)`` of rows that each task holds sorted by ``keys``, a group at a time.

    The last key is taken as the first of its group: an aggregate to which the
    order matters keeps the optimizer from dropping the sort.
    """
    last = keys[-1]
    return rows.groupBy(*keys[:-1], F.col(last).alias("_of")).agg(F.first(last).alias(last), *aggs).drop("_of")


def dimension_key(dim: Dimension) -> Column:
    """1-based position of the value among the listed ones, NULL otherwise:
    unlisted values collapse into one group and the stage-2 tests become
    integer compares (narrower shuffle rows, cheaper than string equality)."""
    col = F.col(dim.column)
    expr = None
    for i, value in enumerate(dim.listed(), start=1):
        expr = (F if expr is None else expr).when(col == F.lit(value), F.lit(i))
    return expr


def _key_code(f: Feature) -> int:
    return f.dimension.listed().index(f.value) + 1


def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _condition(f: Feature, dim_col: str, months_col: str, encoded: bool = False, history_only: bool = False) -> str:
    if f.dimension is TOTAL:
        cond = "true"
    else:
        value = str(_key_code(f)) if encoded else _text(f.value)
        cond = f"{_ident(dim_col)} = {value}"
    if f.tested is not None:
        cond += f" AND {_ident(months_col)} <= {int(f.tested)}"
    elif history_only:
        cond += f" AND {_ident(months_col)} IS NULL"
    return cond


def wide_aggregates(
    spec: BookSpec, dim_col, months_col: str, measures: dict[str, str], encoded: bool = False, history_only: bool = False
) -> list[Column]:
    """One SQL aggregate per feature (plus sum/count helpers for averages).

    ``measures`` maps qtd/sum/min/max/cnt to the column each aggregates
    (``None`` for qtd means "count rows": ``sum(CASE WHEN ... THEN 1 END)``).
    Expressions are passed as SQL text: one JVM call per column instead of
    one per expression node. ``history_only``: rows without an age bucket carry
    the whole history, all others only their window.
    """
    out = []
    for f in spec.features():
        cond = _condition(f, dim_col(f.dimension), months_col, encoded, history_only)

        def agg(func: str, measure: str | None) -> str:
            value = "1" if measure is None else _ident(measure)
            return f"{func}(CASE WHEN {cond} THEN {value} END)"

        if f.stat == "qtd":
            out.append(f"{agg('sum', measures['qtd'])} AS {_ident(f.name)}")
        elif f.stat in ("sum", "min", "max"):
            out.append(f"{agg(f.stat, measures[f.stat])} AS {_ident(f.name)}")
        else:
            out.append(f"{agg('sum', measures['sum'])} AS {_ident(f.name + '__s')}")
            func, measure = measures["cnt"]
            out.append(f"{agg(func, measure)} AS {_ident(f.name + '__c')}")
    return [F.expr(e) for e in out]


def ensure_codegen_width(df: DataFrame, spec: BookSpec) -> None:
    """Raise ``spark.sql.codegen.maxFields`` to cover the wide aggregate, and
    have aggregates of sorted rows run over them in order.

    The book's aggregation buffers hold ~2.4 fields per feature; above the
    default (100) the aggregate drops out of whole-stage codegen and runs
    interpreted. The setting is decided at planning time, so it is applied
    to the session (only ever raised).
    """
    spark = df.sparkSession
    needed = 3 * len(spec.features()) + 64
    current = int(spark.conf.get("spark.sql.codegen.maxFields", "100"))
    if current < needed:
        spark.conf.set("spark.sql.codegen.maxFields", str(needed))
    # else a hash table would hold a wide row for every user of the task
    spark.conf.set("spark.sql.execution.replaceHashWithSortAgg", "true")


def finish_book(grouped: DataFrame, spec: BookSpec, user: str, ref: str | Column, ts_proc: str) -> DataFrame:
    """The book's columns; ``ref`` is one text for all rows, or a column."""
    if isinstance(ref, str):
        ref = F.lit(ref)
    grouped = grouped.withColumn("_book_ref", ref)
    cols = [_ident(user), "_book_ref AS ref", f"{_text(ts_proc)} AS ts_proc"]
    for f in spec.features():
        name = _ident(f.name)
        if f.stat == "qtd":
            cols.append(name)
        elif f.stat == "avg":
            s_, c_ = _ident(f.name + "__s"), _ident(f.name + "__c")
            cols.append(f"CAST({s_} AS DOUBLE) / nullif({c_}, 0) AS {name}")
        else:
            cols.append(f"CAST({name} AS DOUBLE) AS {name}")
    return grouped.selectExpr(*cols)


# ---------------------------------------------------------------------------
# One-stage plan


def feature_book_one_stage(
    df: DataFrame,
    spec: BookSpec,
    as_of,
    ref: str,
    ts_proc: str,
    user: str = "user_id",
    amount: str = "amount",
    date_col: str = "ref",
) -> DataFrame:
    """One ``groupBy(user)`` with a conditional aggregate per feature.

    The window tests use the age bucket (``bucket <= k`` iff ``age <= k``
    for every tested k), resolved once per day like the two-stage plan.
    """
    dims = [d.column for d in spec.dimensions]
    narrow = df.select(user, amount, date_col, *dims)
    base = with_age_bucket(narrow, as_of, spec.boundaries(), date_col)
    measures = {"qtd": None, "sum": amount, "min": amount, "max": amount, "cnt": ("count", amount)}
    aggs = wide_aggregates(spec, lambda d: d.column, BUCKET, measures)
    ensure_codegen_width(df, spec)
    dealt = base.repartition(user).sortWithinPartitions(user)
    return finish_book(grouped_in_order(dealt, [user], aggs), spec, user, ref, ts_proc)


# ---------------------------------------------------------------------------
# Two-stage plan


def book_stage_keys(spec: BookSpec, user: str = "user_id") -> list[str]:
    return [user, *(d.key for d in spec.dimensions), BUCKET]


def prepare_stage_input(
    df: DataFrame,
    spec: BookSpec,
    as_of,
    user: str = "user_id",
    amount: str = "amount",
    date_col: str = "ref",
    keep: tuple[str, ...] = (),
    dimensions: tuple[Dimension, ...] | None = None,
) -> DataFrame:
    """Narrow projection: user, dimension keys, age bucket, measure (and the columns to ``keep``).

    ``dimensions``: those whose columns are there already (all by default).
    """
    chosen = spec.dimensions if dimensions is None else dimensions
    dims = [d.key if d.key in df.columns else d.column for d in chosen]
    narrow = df.select(user, amount, date_col, *dims, *keep)
    return with_age_bucket(narrow, as_of, spec.boundaries(), date_col).select(
        F.col(user),
        *(F.col(c) for c in keep),
        # a key already present (computed on a dimension table) is reused
        *(F.col(d.key) if d.key in df.columns else dimension_key(d).alias(d.key) for d in chosen),
        F.col(BUCKET),
        F.col(amount),
    )


def pivot_partials(
    partials: DataFrame,
    spec: BookSpec,
    ref: str,
    ts_proc: str,
    user: str = "user_id",
    dealt: bool = False,
) -> DataFrame:
    """Second stage: partial rows (bounded per user) -> one wide row per user.

    The explicit hash repartition on ``user`` ships the narrow partial rows;
    the wide aggregate then needs no further exchange. ``dealt``: the rows are
    partitioned by user already; they are taken a user at a time.
    """
    measures = {"qtd": N, "sum": S, "min": MN, "max": MX, "cnt": ("sum", C)}
    aggs = wide_aggregates(spec, lambda d: d.key, BUCKET, measures, encoded=True)
    ensure_codegen_width(partials, spec)
    if dealt:
        wide = grouped_in_order(partials.sortWithinPartitions(user), [user], aggs)
    else:
        wide = partials.repartition(user).groupBy(user).agg(*aggs)
    return finish_book(wide, spec, user, ref, ts_proc)


def pivot_rows(
    narrow: DataFrame,
    spec: BookSpec,
    ref: str,
    ts_proc: str,
    user: str = "user_id",
    amount: str = "amount",
) -> DataFrame:
    """Both stages behind one exchange by user, of the narrow rows themselves:
    for rows that have been shuffled apart, where combining them before the
    exchange saves less than shipping five measures a row and a second
    exchange cost."""
    keys = book_stage_keys(spec, user)
    ensure_codegen_width(narrow, spec)
    rows = narrow.select(*keys, amount).repartition(user).sortWithinPartitions(*keys)
    return pivot_partials(grouped_in_order(to_partials(rows, amount), keys, combined()), spec, ref, ts_proc, user, dealt=True)


def feature_book_two_stage(
    df: DataFrame,
    spec: BookSpec,
    as_of,
    ref: str,
    ts_proc: str,
    user: str = "user_id",
    amount: str = "amount",
    date_col: str = "ref",
) -> DataFrame:
    narrow = prepare_stage_input(df, spec, as_of, user, amount, date_col)
    partials = combine_partials(to_partials(narrow, amount), book_stage_keys(spec, user))
    return pivot_partials(partials, spec, ref, ts_proc, user)


def feature_book(
    df: DataFrame,
    spec: BookSpec,
    as_of,
    ref: str,
    ts_proc: str,
    user: str = "user_id",
    amount: str = "amount",
    date_col: str = "ref",
    method: str = "two_stage",
) -> DataFrame:
    """Wide feature book over enriched sales rows (one row per user)."""
    build = {"two_stage": feature_book_two_stage, "one_stage": feature_book_one_stage}[method]
    return build(df, spec, as_of, ref, ts_proc, user=user, amount=amount, date_col=date_col)
