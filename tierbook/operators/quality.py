"""Schema and key checks (the reference prints the schema; here it is asserted)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


class SchemaMismatch(ValueError):
    pass


def assert_schema(df: DataFrame, expected: T.StructType, check_nullability: bool = False) -> DataFrame:
    """Fail unless ``df`` has exactly the expected column names, order and types."""

    def shape(schema: T.StructType):
        return [(f.name, f.dataType, f.nullable if check_nullability else None) for f in schema.fields]

    if shape(df.schema) != shape(expected):
        raise SchemaMismatch(f"expected {expected.simpleString()}, got {df.schema.simpleString()}")
    return df


class LostRows(ValueError):
    """Other rows than were written, or than a commit reports."""


class TooManyRejects(ValueError):
    pass


def assert_rows(df: DataFrame, expected: int, what: str) -> DataFrame:
    """Fail unless ``df`` (files of one load: only their footers are read) has the number of rows its commit reports."""
    found = df.count()
    if found != expected:
        raise LostRows(f"{what}: {expected} rows were committed, {found} are there")
    return df


class DuplicateKeys(ValueError):
    pass


def assert_unique(df: DataFrame, key: str) -> DataFrame:
    """Fail if any ``key`` value occurs twice (one distributed aggregation;
    only a single offending key is brought back, for the message)."""
    dup = df.groupBy(key).count().where("count > 1").select(key).limit(1).collect()
    if dup:
        raise DuplicateKeys(f"{key}={dup[0][0]!r} occurs more than once")
    return df
