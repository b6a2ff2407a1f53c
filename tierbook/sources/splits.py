"""Where to cut a table so that a parallel extract has equal parts.

Ranges of equal width put most rows into few reads when the key is skewed. The
bounds here are quantiles of the key, from a sketch over rows that look like the
table's (the last snapshot of it, or the key column itself): one aggregation.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ACCURACY = 100_000  # rank error of a bound: 1 / ACCURACY of the rows


def _text(value) -> str:
    """A bound as a literal of the database's SQL."""
    if isinstance(value, (dt.date, dt.datetime)):
        return f"'{value}'"
    return str(value)


def split_bounds(keys: DataFrame, column: str, parts: int, accuracy: int = ACCURACY) -> list:
    """At most ``parts - 1`` rising bounds that cut the rows of ``keys`` into equal shares.

    A single value that holds more than a share makes one part of its own size;
    neither it nor an empty part is cut further.
    """
    kind = keys.schema[column].dataType
    if not isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        raise ValueError(f"{column} is {kind.simpleString()}: quantiles need a number, date or timestamp")
    if parts < 2:
        return []
    shares = [i / parts for i in range(1, parts)]
    bounds = keys.agg(F.percentile_approx(F.col(f"`{column}`"), shares, accuracy)).first()[0] or []
    least = keys.agg(F.min(f"`{column}`")).first()[0]
    return [b for b in sorted(set(bounds)) if b != least]


def split_predicates(keys: DataFrame, column: str, parts: int, quoted: str | None = None, accuracy: int = ACCURACY) -> list[str]:
    """One condition per read; every row, NULL keys too, meets exactly one.

    ``quoted`` is the column's name as the database wants it.
    """
    name = quoted or column
    bounds = [_text(int(b) if isinstance(b, Decimal) and b == b.to_integral_value() else b) for b in split_bounds(keys, column, parts, accuracy)]
    if not bounds:
        return [f"{name} IS NOT NULL", f"{name} IS NULL"]
    inner = [f"{name} >= {a} AND {name} < {b}" for a, b in zip(bounds, bounds[1:])]
    return [f"{name} < {bounds[0]}", *inner, f"{name} >= {bounds[-1]}", f"{name} IS NULL"]
