"""Subject specifications: the typed silver schema of each source table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Lineage / batch columns carried by every silver row.
LINEAGE_FIELDS = [
    T.StructField("ref", T.StringType()),
    T.StructField("ts_file_generation", T.StringType()),
    T.StructField("ts_proc", T.StringType()),
]


@dataclass(frozen=True)
class SubjectSpec:
    """One source table: its name and typed business columns."""

    name: str
    columns: T.StructType

    @property
    def raw_schema(self) -> T.StructType:
        """Bronze CSV schema: same names, all strings (header, no inference)."""
        return T.StructType([T.StructField(f.name, T.StringType()) for f in self.columns])

    @property
    def stored_schema(self) -> T.StructType:
        """What a silver load writes: typed columns, and what is kept of rejected rows."""
        extra = [T.StructField(FAULTS, T.StringType()), T.StructField(RAW, self.raw_schema)]
        return T.StructType(list(self.silver_schema.fields) + extra)

    @property
    def silver_schema(self) -> T.StructType:
        """Silver column order: lineage first, then the typed business columns."""
        return T.StructType(LINEAGE_FIELDS + list(self.columns.fields))


PRODUCTS = SubjectSpec(
    "products",
    T.StructType(
        [
            T.StructField("product_id", T.StringType()),
            T.StructField("product_des", T.StringType()),
            T.StructField("product_category", T.StringType()),
        ]
    ),
)

# The sales silver job is not published upstream; column names come from
# their use in the book, types are chosen so that min/max compare numerically.
SALES = SubjectSpec(
    "sales",
    T.StructType(
        [
            T.StructField("transaction_id", T.StringType()),
            T.StructField("user_id", T.StringType()),
            T.StructField("product_id", T.StringType()),
            T.StructField("dat_creation", T.DateType()),
            T.StructField("amount", T.DecimalType(18, 2)),
            T.StructField("payment_method", T.StringType()),
        ]
    ),
)

# Only the existence of the users subject is known; it gates the book.
USERS = SubjectSpec(
    "users",
    T.StructType(
        [
            T.StructField("user_id", T.StringType()),
            T.StructField("user_name", T.StringType()),
            T.StructField("segment", T.StringType()),
        ]
    ),
)

# Of a row with a value that its column's type can't hold: the columns, and the text of all.
FAULTS, RAW = "_faults", "_raw"

SUBJECTS = {s.name: s for s in (PRODUCTS, SALES, USERS)}

CONTROL_SCHEMA = T.StructType(
    [
        T.StructField("assunto", T.StringType()),
        T.StructField("ts_file_generation", T.StringType()),
        T.StructField("ts_proc", T.StringType()),
        T.StructField("qtd_registros", T.LongType()),
        T.StructField("ref", T.StringType()),
    ]
)

# What the audit row of a load holds beside that.
LOAD_REPORT_SCHEMA = T.StructType(
    CONTROL_SCHEMA.fields
    + [
        T.StructField("rejected", T.LongType()),
        T.StructField("faults", T.MapType(T.StringType(), T.LongType())),
        T.StructField("version", T.LongType()),
    ]
)
