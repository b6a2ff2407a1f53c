"""Month-age and recency expressions (all JVM-side built-ins)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

REF_FORMAT = "yyyyMMdd"


def as_date(value: str | dt.date) -> dt.date:
    """Accept ``date``, ``'yyyy-MM-dd'`` or ``'yyyyMMdd'``."""
    if isinstance(value, dt.date):
        return value
    text = value.replace("-", "")
    return dt.date(int(text[:4]), int(text[4:6]), int(text[6:8]))


def ref_stamp(value: str | dt.date) -> str:
    """``yyyyMMdd`` text of a date, as stored in ``ref``."""
    return as_date(value).strftime("%Y%m%d")


def parse_ref(ref: Column | str) -> Column:
    """``yyyyMMdd`` text (or int) to DATE; malformed or NULL -> NULL (ANSI-safe)."""
    col = F.col(ref) if isinstance(ref, str) else ref
    return F.try_to_date(col.cast("string"), REF_FORMAT)


def month_age(as_of: str | dt.date, ref: Column | str = "ref", is_date: bool = False) -> Column:
    """Whole months between ``ref`` and the book date, truncated toward zero.

    ``int(months_between(as_of, ref))``: same day-of-month or both month-ends
    give whole months, otherwise the day difference counts in 31sts. A ref in
    the future gives a negative age; an unparsable ref gives NULL. With
    ``is_date`` the column is a DATE or TIMESTAMP and is taken as it is (the
    time of day doesn't count).
    """
    day = F.to_date(ref) if is_date else parse_ref(ref)
    return F.months_between(F.lit(as_date(as_of)), day).cast("int")


def recency_flag(age: Column, months: int) -> Column:
    """1 when ``age <= months`` ("last k months"), else 0 (NULL age -> 0)."""
    return F.when(age <= F.lit(months), F.lit(1)).otherwise(F.lit(0))


def lookback_start(as_of: str | dt.date, days: int = 365) -> str:
    """First day of the month ``days`` before ``as_of`` as ``yyyyMM01``."""
    start = as_date(as_of) - dt.timedelta(days=days)
    return start.strftime("%Y%m01")


def window_start(as_of: str | dt.date, months: int = 12) -> str:
    """First day of the month that a "last ``months`` months" window can reach, as ``yyyyMM01``.

    A row is in it up to just under ``months + 1`` months of age, month-ends
    included, so that no column of the window changes if older refs are left out.
    """
    day = as_date(as_of)
    first = 12 * day.year + day.month - 1 - (months + 1)
    return f"{first // 12:04d}{first % 12 + 1:02d}01"
