"""The once-per-day bucket lookup equals the exact per-row expression."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tierbook.functions.dates import month_age
from tierbook.operators.book import BUCKET, age_bucket, lookup_span_days, month_flags, with_age_bucket

BOUNDS = [1, 3, 6, 12]
ODD = [None, "", "2024", "202409", "20240230", "20241301", "2024091a", " 20240901", "20240901 ",
       "120240901", "99991231", "00000101", "19000101", "20240931", "2024-09-01", "+20240901"]


def _days(as_of: dt.date, bounds=BOUNDS) -> list:
    span = lookup_span_days(bounds) + 40
    return [as_of + dt.timedelta(days=d) for d in range(-span, span)]


def _refs(as_of: dt.date, bounds=BOUNDS) -> list:
    days = _days(as_of, bounds)
    far = [dt.date(1970, 1, 31), dt.date(2099, 2, 28), dt.date(2400, 2, 29)]
    return [d.strftime("%Y%m%d") for d in days + far] + ODD


@pytest.mark.parametrize("as_of", [dt.date(2024, 9, 30), dt.date(2024, 2, 29), dt.date(2001, 7, 31), dt.date(2023, 1, 15)])
def test_lookup_matches_exact(spark, as_of):
    df = spark.createDataFrame([(r,) for r in _refs(as_of)], "ref string")
    fast = with_age_bucket(df, as_of, BOUNDS).select("ref", F.col(BUCKET).alias("fast"))
    exact = df.select("ref", age_bucket(month_age(as_of, "ref"), BOUNDS).alias("exact"))
    got = {r.ref: r.fast for r in fast.collect()}
    want = {r.ref: r.exact for r in exact.collect()}
    assert got == want


def test_month_flags_match_exact_flags(spark):
    from tierbook.functions.dates import recency_flag
    from tierbook.operators.book import month_flags

    as_of = dt.date(2024, 9, 30)
    df = spark.createDataFrame([(r,) for r in _refs(as_of)], "ref string")
    got = {r.ref: tuple(r[1:]) for r in month_flags(df, as_of).collect()}
    age = month_age(as_of, "ref")
    want = {
        r.ref: tuple(r[1:])
        for r in df.select("ref", *(recency_flag(age, k).alias(f"flag_u{k}m") for k in (1, 3, 6, 12))).collect()
    }
    assert got == want


@pytest.mark.parametrize("bounds", [[24], [12, 24, 36], [1, 60]])
def test_long_windows_match_exact(spark, bounds):
    as_of = dt.date(2024, 9, 30)
    df = spark.createDataFrame([(r,) for r in _refs(as_of, bounds)], "ref string")
    fast = {r.ref: r[1] for r in with_age_bucket(df, as_of, bounds).select("ref", BUCKET).collect()}
    exact = {r.ref: r[1] for r in df.select("ref", age_bucket(month_age(as_of, "ref"), bounds)).collect()}
    assert fast == exact


def test_flags_of_long_windows(spark):
    df = spark.createDataFrame([("20220929",), ("20220831",), ("20211001",), ("20210930",), ("20210829",)], "ref string")
    got = {r.ref: tuple(r[1:]) for r in month_flags(df, dt.date(2024, 9, 30), (12, 24, 36)).collect()}
    assert got == {
        "20220929": (0, 1, 1), "20220831": (0, 0, 1), "20211001": (0, 0, 1), "20210930": (0, 0, 1), "20210829": (0, 0, 0)
    }


@pytest.mark.parametrize("kind", ["date", "timestamp"])
def test_date_columns_are_used_as_they_are(spark, kind):
    as_of = dt.date(2024, 9, 30)
    df = spark.createDataFrame([(d,) for d in [*_days(as_of), dt.date(1970, 1, 1), dt.date(2400, 1, 1), None]], "d date").select(
        F.col("d"), F.col("d").cast(kind).alias("x")
    )
    fast = {r.d: r[1] for r in with_age_bucket(df, as_of, BOUNDS, "x").select("d", BUCKET).collect()}
    text = df.select("d", F.date_format("d", "yyyyMMdd").alias("ref"))
    exact = {r.d: r[1] for r in text.select("d", age_bucket(month_age(as_of, "ref"), BOUNDS)).collect()}
    assert fast == exact and fast[dt.date(2024, 9, 1)] == 1
