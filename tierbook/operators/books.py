"""Feature books of many dates in one scan of the sales (training sets).

A single book asks of every sale which windows it is in on one date. Here every
calendar day is looked up once: the first book date that knows it, and the
dates (with their age bucket) on which it lies in some window. Days that agree
in all of that form a *cell*. Sales go by user and dimension keys, four narrow
columns, and are reduced there, in order, to partial aggregates per user, dimension
keys and cell (no hash table holds a task's groups), which go to their user. Each
partial is spread over the dates of its windows, and the whole history of a date is the
running sum, minimum and maximum over the dates so far, so that a sale is not
repeated for every later date. One pivot per user and date ends it.

With ``past_only`` (what a book built on that date could know) a sale counts
from its day on: its windows cover a few dates, however many books are asked
for. Without it every book is the one ``feature_book`` builds of the same rows:
sales after the date are recent to it, undated ones are in the whole history.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierbook.functions.dates import as_date, month_age, parse_ref, ref_stamp
from tierbook.operators.book import (
    BUCKET,
    MN,
    MX,
    N,
    C,
    PARTIALS,
    S,
    BookSpec,
    age_bucket,
    combined,
    dimension_key,
    ensure_codegen_width,
    finish_book,
    grouped_in_order,
    lookup_span_days,
    to_partials,
    wide_aggregates,
)

DATE = "_book"  # a book date's position
CELL, FIRST, HITS, WHOLE = "_cell", "_first", "_hits", "_whole"
OLD, UNDATED, LATER = -1, -2, -3  # days that no lookup holds
HISTORY = -(10**6)  # bucket of the rows that carry a date's whole history


def _literal_dates(dates: Sequence[dt.date]) -> Column:
    return F.array(*[F.struct(F.lit(i).alias("i"), F.lit(d).alias("d")) for i, d in enumerate(dates)])


def day_table(spark, dates: Sequence[dt.date], boundaries: list[int], past_only: bool) -> tuple[DataFrame, DataFrame, dt.date, dt.date]:
    """(day -> cell, cell -> first date and hits, first day, last day).

    Both are as large as the days between the dates, never as the data.
    """
    span = lookup_span_days(boundaries)
    start = dates[0] - dt.timedelta(days=min(span, (dates[0] - dt.date.min).days))
    end = dates[-1] if past_only else dates[-1] + dt.timedelta(days=span)
    days = spark.range((end - start).days + 1).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("day"))
    each = days.select("day", F.explode(_literal_dates(dates)).alias("b")).select("day", "b.i", "b.d")
    bucket = age_bucket(F.months_between("d", "day").cast("int"), boundaries)
    if past_only:
        bucket = F.when(F.col("d") >= F.col("day"), bucket)
    known = F.min(F.when(F.col("d") >= F.col("day"), F.col("i"))) if past_only else F.lit(0)
    hits = F.sort_array(F.collect_list(F.when(F.col("bucket").isNotNull(), F.struct("i", "bucket"))))
    per_day = each.withColumn("bucket", bucket).groupBy("day").agg(known.alias(FIRST), hits.alias(HITS))
    # the days' number is the number of their cell's first day
    cell = F.datediff(F.min("day").over(Window.partitionBy(FIRST, HITS)), F.lit(start))
    per_day = per_day.withColumn(CELL, cell)
    cells = per_day.select(CELL, FIRST, HITS).distinct()
    everywhere = F.transform(_literal_dates(dates), lambda b: F.struct(b["i"].alias("i"), F.lit(boundaries[0]).alias("bucket")))
    none = F.array().cast("array<struct<i:int,bucket:int>>")
    extra = [(OLD, 0, False), (UNDATED, None if past_only else 0, False), (LATER, None if past_only else 0, not past_only)]
    beyond = spark.createDataFrame(extra, f"{CELL} int, {FIRST} int, whole boolean")
    beyond = beyond.select(CELL, FIRST, F.when(F.col("whole"), everywhere).otherwise(none).alias(HITS))
    return per_day.select("day", CELL), cells.unionByName(beyond), start, end


def with_cell(df: DataFrame, days: DataFrame, start: dt.date, end: dt.date, date_col: str) -> DataFrame:
    """Add each row's cell, looked up by its day (``yyyyMMdd`` text or int, DATE or TIMESTAMP)."""
    is_date = isinstance(df.schema[date_col].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))
    if is_date:
        keyed, exact = df.withColumn("_day", F.to_date(date_col)), F.col("_day")
    else:
        keyed = df.withColumn("_day", F.col(date_col).cast("string"))
        days, exact = days.withColumn("day", F.date_format("day", "yyyyMMdd")), parse_ref("_day")
    beyond = F.when(exact.isNull(), F.lit(UNDATED)).when(exact < F.lit(start), F.lit(OLD)).otherwise(F.lit(LATER))
    joined = keyed.join(F.broadcast(days.withColumnsRenamed({"day": "_day", CELL: "_found"})), "_day", "left")
    return joined.withColumn(CELL, F.coalesce("_found", beyond)).drop("_day", "_found")


def feature_books(
    df: DataFrame,
    spec: BookSpec,
    dates: Sequence[str | dt.date],
    ts_proc: str,
    user: str = "user_id",
    amount: str = "amount",
    date_col: str = "ref",
    past_only: bool = True,
) -> DataFrame:
    """A row per user and book date, with the columns of ``feature_book``; ``ref`` is the book's date.

    A user is in the books of the dates on which some sale is known.
    """
    dates = sorted({as_date(d) for d in dates})
    if not dates:
        raise ValueError("no book dates")
    spark = df.sparkSession
    days, cells, start, end = day_table(spark, dates, spec.boundaries(), past_only)
    keys = [d.key for d in spec.dimensions]
    # a key already present (computed on a dimension table) is reused
    own = [F.col(d.key) if d.key in df.columns else dimension_key(d).alias(d.key) for d in spec.dimensions]
    named = [d.key if d.key in df.columns else d.column for d in spec.dimensions]
    rows = with_cell(df.select(user, amount, date_col, *named), days, start, end, date_col)
    ensure_codegen_width(df, spec)
    # behind the exchange a sale may become a row for every date, and one more: so many times the session's tasks
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions")) * (1 + len(dates))
    by_cell = [user, *keys, CELL]
    dealt = rows.select(user, *own, CELL, amount).repartition(tasks, user, *keys).sortWithinPartitions(*by_cell)
    partials = grouped_in_order(to_partials(dealt, amount), by_cell, combined())

    spread = partials.repartition(tasks, user).join(F.broadcast(cells), CELL).where(F.col(FIRST).isNotNull())
    to_dates = F.concat(F.array(F.struct(F.col(FIRST).alias("i"), F.lit(HISTORY).alias("bucket"))), F.col(HITS))
    spread = spread.select(user, *keys, *PARTIALS, F.explode(to_dates).alias("hit"))
    spread = spread.select(
        user, *keys, *PARTIALS, F.col("hit.i").alias(DATE), F.col("hit.bucket").alias(BUCKET), (F.col("hit.bucket") == HISTORY).alias(WHOLE)
    )
    # sorted once for the sums and the running totals, and once for the pivot: a task holds narrow rows only
    ordered = [user, *keys, WHOLE, DATE, BUCKET]
    per_date = grouped_in_order(spread.sortWithinPartitions(*ordered), ordered, combined())

    # whole history: running over the dates on which something new is known, valid until the next of them
    history = F.col(WHOLE)
    so_far = Window.partitionBy(user, *keys, WHOLE).orderBy(DATE)
    running = so_far.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = {N: F.sum(N), C: F.sum(C), S: F.sum(S), MN: F.min(MN), MX: F.max(MX)}
    until = F.when(history, F.coalesce(F.lead(DATE).over(so_far), F.lit(len(dates))) - 1).otherwise(F.col(DATE))
    filled = per_date.select(
        user, *keys, F.when(~history, F.col(BUCKET)).alias(BUCKET),
        *[F.when(history, agg.over(running)).otherwise(F.col(c)).alias(c) for c, agg in totals.items()],
        F.col(DATE), until.alias("_until"),
    )
    filled = filled.withColumn(DATE, F.explode(F.sequence(F.col(DATE), F.col("_until"))))
    measures = {"qtd": N, "sum": S, "min": MN, "max": MX, "cnt": ("sum", C)}
    aggs = wide_aggregates(spec, lambda d: d.key, BUCKET, measures, encoded=True, history_only=True)
    wide = grouped_in_order(filled.sortWithinPartitions(user, DATE), [user, DATE], aggs)
    refs = F.array(*[F.lit(ref_stamp(d)) for d in dates])
    return finish_book(wide.withColumn("_ref", F.get(refs, F.col(DATE))), spec, user, F.col("_ref"), ts_proc)


def feature_books_one_by_one(df: DataFrame, spec: BookSpec, dates, ts_proc: str, past_only: bool = True, **options) -> DataFrame:
    """The same by a scan per date: the union of single books."""
    from functools import reduce

    from tierbook.operators.book import feature_book

    date_col = options.get("date_col", "ref")
    is_date = isinstance(df.schema[date_col].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))
    books = []
    for d in sorted({as_date(d) for d in dates}):
        known = df.where(month_age(d, date_col, is_date).isNotNull() & ((F.to_date(date_col) if is_date else parse_ref(date_col)) <= F.lit(d))) if past_only else df
        books.append(feature_book(known, spec, d, ref_stamp(d), ts_proc, **options))
    return reduce(DataFrame.unionByName, books)
