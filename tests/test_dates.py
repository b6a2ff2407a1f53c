"""Month age and recency flags at the boundaries (book date 2024-09-30)."""

import pytest
from pyspark.sql import functions as F

from tierbook.functions.dates import lookback_start, month_age, recency_flag

AS_OF = "2024-09-30"

CASES = [
    ("20240930", 0),  # same day
    ("20240801", 1),  # under two months
    ("20240731", 2),  # month-end pair -> whole months
    ("20240831", 1),  # month-end pair
    ("20230915", 12),  # 12.x months truncates to 12
    ("20230830", 13),  # 13 months: in no window
    ("20250301", -5),  # future: negative, inside every window
    ("202409", None),  # malformed -> NULL (no ANSI error)
    (None, None),
]


@pytest.fixture(scope="module")
def ages(spark):
    df = spark.createDataFrame([(r,) for r, _ in CASES], "ref string")
    rows = df.select("ref", month_age(AS_OF, "ref").alias("age")).collect()
    return {r["ref"]: r["age"] for r in rows}


@pytest.mark.parametrize("ref,expected", CASES)
def test_month_age(ages, ref, expected):
    assert ages[ref] == expected


def test_flags_follow_age(spark):
    df = spark.createDataFrame([(r,) for r, _ in CASES], "ref string")
    age = month_age(AS_OF, "ref")
    out = df.select("ref", *(recency_flag(age, k).alias(f"u{k}") for k in (1, 3, 6, 12))).collect()
    expected = dict(CASES)
    for row in out:
        a = expected[row["ref"]]
        for k in (1, 3, 6, 12):
            assert row[f"u{k}"] == (1 if a is not None and a <= k else 0), (row, k)


def test_int_ref_is_accepted(spark):
    df = spark.createDataFrame([(20240801,)], "ref int")
    assert df.select(month_age(AS_OF, F.col("ref"))).first()[0] == 1


def test_lookback_start_is_whole_month():
    # 365 days before 2024-09-30 is 2023-10-01 (the span contains 29 Feb).
    assert lookback_start("2024-09-30") == "20231001"
    assert lookback_start("2025-09-30") == "20240901"
    assert lookback_start("2001-07-31") == "20000701"


def test_window_start_cuts_no_window():
    import datetime as dt

    from tierbook.functions.dates import window_start

    assert window_start("2024-09-30") == "20230801" and window_start("2024-01-31", 1) == "20231101" and window_start("2024-12-31", 12) == "20231101"

    def age(e, r):  # int(months_between)
        months = 12 * (e.year - r.year) + e.month - r.month
        last = lambda d: (d + dt.timedelta(days=1)).day == 1
        return months if e.day == r.day or (last(e) and last(r)) else int((31 * months + e.day - r.day) / 31)

    for e in (dt.date(2024, 9, 30), dt.date(2024, 2, 29), dt.date(2023, 3, 31), dt.date(2024, 1, 1)):
        for k in (1, 3, 6, 12):
            first = dt.datetime.strptime(window_start(e, k), "%Y%m%d").date()
            for back in range(1, 60):
                assert age(e, first - dt.timedelta(days=back)) > k
