"""Books of many dates, changes between snapshots, profiles, planned reads."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import plan_text
from tierbook.operators.book import make_spec
from tierbook.operators.books import feature_books, feature_books_one_by_one
from tierbook.operators.changes import key_history, snapshot_changes
from tierbook.operators.profile import distance, merge, profile, summary
from tierbook.sources.splits import split_bounds, split_predicates

SPEC = make_spec((("A", "a"), ("B", "b")), (("x", "x"), ("y", "y")))
DATES = ("2020-01-31", "2020-02-29", "2020-03-31", "2020-12-31", "2021-01-30")


def _sales(spark, rows=400, kind="text"):
    rng = random.Random(rows)
    out = []
    for i in range(rows):
        day = dt.date(2018, 6, 1) + dt.timedelta(days=int(rng.random() * 1200))
        ref = day.strftime("%Y%m%d") if rng.random() < 0.9 else rng.choice([None, "bad", "20200230", "18000101", "99991231", "2020"])
        amount = None if rng.random() < 0.1 else Decimal(rng.randint(-500, 5000)) / 100
        out.append((rng.choice(["u1", "u1", "u2", "u3", None]), rng.choice(["A", "B", "C", None]), rng.choice(["x", "y", "z", None]), amount, ref))
    df = spark.createDataFrame(out, "user_id string, product_category string, payment_method string, amount decimal(18,2), ref string")
    return df if kind == "text" else df.withColumn("ref", F.try_to_date("ref", "yyyyMMdd"))


@pytest.mark.parametrize("past_only", [True, False])
@pytest.mark.parametrize("kind", ["text", "date"])
def test_books_equal_the_single_books(spark, past_only, kind):
    sales = _sales(spark, kind=kind)
    got = feature_books(sales, SPEC, DATES, "20210201000000", past_only=past_only)
    want = feature_books_one_by_one(sales, SPEC, DATES, "20210201000000", past_only=past_only)
    assert got.columns == want.columns
    key = lambda r: (r.ref, r.user_id or "")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert len({key(r) for r in got.collect()}) == got.count() > 12


def test_books_scan_once_and_shuffle_by_user_once(spark, tmp_path):
    _sales(spark).write.parquet(str(tmp_path / "sales"))
    books = feature_books(spark.read.parquet(str(tmp_path / "sales")), SPEC, DATES, "20210201000000")
    plan = plan_text(books, "simple")
    assert plan.count("FileScan parquet") == 1
    assert plan.count("Exchange hashpartitioning(user_id") == 2  # the partials' combination, then by user alone
    assert plan.count("Exchange hashpartitioning(user_id#") == 2 and "CartesianProduct" not in plan


def test_books_of_no_sales_and_early_dates(spark):
    none = feature_books(_sales(spark).limit(0), SPEC, DATES, "x")
    assert none.count() == 0
    assert feature_books(_sales(spark).where("ref > '20190101'"), SPEC, ["2018-01-31"], "x").count() == 0
    with pytest.raises(ValueError):
        feature_books(_sales(spark), SPEC, [], "x")


PRODUCT = "k string, name string, price double"


def _changes(spark, old, new):
    found = snapshot_changes(spark.createDataFrame(old, PRODUCT), spark.createDataFrame(new, PRODUCT), ["k"])
    return sorted(map(tuple, found.collect()), key=repr)


def test_snapshot_changes(spark):
    old = [("1", "a", 1.0), ("2", "b", None), ("3", None, 3.0), ("4", "d", 4.0), (None, "n", 0.0), ("6", "x", 1.0), ("6", "y", 1.0), ("7", "t", 1.0)]
    new = [("1", "a", 1.0), ("2", None, None), ("3", None, 3.0), ("5", "e", 5.0), (None, "m", 0.0), ("6", "y", 1.0), ("6", "x", 1.0), ("7", "t", 1.0), ("7", "t", 1.0)]
    assert _changes(spark, old, new) == sorted([
        ("2", "updated", None, None), ("4", "deleted", "d", 4.0), ("5", "inserted", "e", 5.0), (None, "updated", "m", 0.0),
        ("7", "updated", "t", 1.0), ("7", "updated", "t", 1.0),
    ], key=repr)
    assert _changes(spark, old, old) == [] and len(_changes(spark, [], old)) == 8 and len(_changes(spark, old, [])) == 8
    # NULL in one column is not NULL in the next
    assert len(_changes(spark, [("1", None, 1.0)], [("1", "1.0", None)])) == 1


def test_key_history(spark):
    rows = [
        ("s1", "1", "a"), ("s2", "1", "a"), ("s3", "1", "b"), ("s4", "1", "a"),
        ("s1", "2", "x"), ("s3", "2", "x"), ("s4", "2", "x"),
        ("s2", "3", None), ("s3", "3", None),
        ("s1", None, "n"), ("s2", None, "n"), ("s3", None, "n"), ("s4", None, "n"),
    ]
    found = key_history(spark.createDataFrame(rows, "s string, k string, v string"), ["k"], ["s"])
    got = sorted((r.k, r.v, r.valid_from, r.valid_to) for r in found.where("k IS NOT NULL").collect())
    assert got == [("1", "a", "s1", "s3"), ("1", "a", "s4", None), ("1", "b", "s3", "s4"), ("2", "x", "s1", "s2"), ("2", "x", "s3", None), ("3", None, "s2", "s4")]
    assert [tuple(r) for r in found.where("k IS NULL").collect()] == [(None, "n", "s1", None)]
    assert key_history(spark.createDataFrame([], "s string, k string, v string"), ["k"], ["s"]).count() == 0


def test_profile_bounds_and_merge(spark):
    one = spark.range(40_000).select(F.lit("b1").alias("b"), (F.col("id") % 10_000).alias("x"), F.when(F.col("id") % 4 == 0, None).otherwise(F.date_add(F.lit("2020-01-01"), (F.col("id") % 100).cast("int"))).alias("d"), F.lit("t").alias("t"))
    two = spark.range(40_000).select(F.lit("b2").alias("b"), (F.col("id") % 10_000 + 5_000).alias("x"), F.lit(dt.date(2020, 1, 1)).alias("d"), F.lit("t").alias("t"))
    stored = profile(one.unionByName(two), ["b"]).cache()
    got = {(r.b, r.column): r for r in summary(stored).collect()}
    x = got["b1", "x"]
    assert (x.rows, x.nulls, x.least, x.greatest) == (40_000, 0, "0", "9999") and got["b1", "d"].nulls == 10_000
    assert abs(x.n_distinct / 10_000 - 1) < 0.05 and got["b1", "t"].n_distinct == 1 and got["b1", "t"].quantile is None
    assert all(abs(q / 10_000 - s) < 0.03 for q, s in zip(x.quantile, (0.25, 0.5, 0.75)))
    whole = {r.column: r for r in summary(merge(stored)).collect()}
    assert whole["x"].rows == 80_000 and abs(whole["x"].n_distinct / 15_000 - 1) < 0.05 and abs(whole["x"].quantile[1] / 7_500 - 1) < 0.05
    far = {r.column: r for r in distance(stored.where("b = 'b1'"), stored.where("b = 'b2'")).collect()}
    assert abs(far["x"].rank_shift - 0.5) < 0.04 and abs(far["x"].distinct_ratio - 1) < 0.05 and far["x"].null_shift == 0
    assert far["d"].null_shift == -0.25 and far["t"].rank_shift is None
    same = {r.column: r for r in distance(stored.where("b = 'b1'"), stored.where("b = 'b1'")).collect()}
    assert same["x"].rank_shift == 0 and same["x"].distinct_ratio == 1
    assert profile(one.limit(0), ["b"]).count() == 0
    assert summary(profile(one.limit(0))).where("column = 'x'").first().quantile is None


@pytest.mark.parametrize("kind", ["long", "date", "decimal"])
def test_planned_reads_cover_every_row_once(spark, kind):
    key = F.when(F.col("id") % 3 == 0, 1_000_000 + F.col("id") % 97).otherwise(F.col("id"))
    rows = spark.range(30_000).select(F.when(F.col("id") % 50 == 1, None).otherwise(key).alias("k"))
    if kind == "date":
        rows = rows.select(F.date_add(F.lit("1990-01-01"), (F.col("k") % 20_000).cast("int")).alias("k"))
    if kind == "decimal":
        rows = rows.select(F.col("k").cast("decimal(12,1)").alias("k"))
    predicates = split_predicates(rows, "k", 10)
    sizes = [rows.where(p).count() for p in predicates]
    assert sum(sizes) == 30_000 and len(predicates) == 11
    ranged = sizes[:-1]
    assert sizes[-1] == 600 and max(ranged) <= 1.5 * sum(ranged) / len(ranged)
    met = rows.select(sum(F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in predicates).alias("n")).distinct().collect()
    assert [r.n for r in met] == [1]


def test_planned_reads_of_odd_keys(spark):
    one = spark.range(100).selectExpr("cast(7 as long) k")
    assert split_bounds(one, "k", 5) == [] and split_predicates(one, "k", 5) == ["k IS NOT NULL", "k IS NULL"]
    none = spark.createDataFrame([], "k long")
    assert split_predicates(none, "k", 5, "`K`") == ["`K` IS NOT NULL", "`K` IS NULL"]
    heavy = spark.range(1000).selectExpr("case when id % 3 = 0 then 5 else id end k")
    assert sum(heavy.where(p).count() for p in split_predicates(heavy, "k", 8)) == 1000
    with pytest.raises(ValueError):
        split_bounds(spark.createDataFrame([("a",)], "k string"), "k", 3)
