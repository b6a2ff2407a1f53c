"""


The oracle SQL below is written independently of the library: its feature
list, age rule and joins are spelled out here in plain DuckDB SQL, so a bug in
the Spark spec generator cannot be shared by the oracle.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from tierbook.plans.registry import QUERIES  # noqa: E402

# The pipeline operators are an optional subpackage: they are added only where
# it (and the pipeline module over it) can be imported.
try:
    from tierbook.llm import queries as llm_queries  # noqa: E402
except ImportError:
    llm_queries = None
try:
    import corpus_pipeline  # noqa: E402
except ImportError:
    corpus_pipeline = None

FLAGSHIP_SF_DIR = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the 203-column per-user feature book on sf0.001."""
    return QUERIES["feature_book"](spark, FLAGSHIP_SF_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = dict(QUERIES)
    if llm_queries is not None:
        found.update(llm_queries.queries())
    if corpus_pipeline is not None:
        found["pipeline"] = corpus_pipeline.run
    return found


# ---------------------------------------------------------------------------

AS_OF = "2001-07-31"
BOOK_REF = "20010731"
BOOK_TS = "20010801060000"
LOOKBACK = "20000701"  # first day of the month 365 days before AS_OF

# Listed values per dimension; anything else is in no feature.
CATEGORIES = [("ECONOMY", "economy"), ("LARGE", "large"), ("PROMO", "promo"), ("SMALL", "small")]
PAYMENTS = [("1-URGENT", "urgent"), ("2-HIGH", "high"), ("3-MEDIUM", "medium"), ("5-LOW", "low")]

SALES = """
sales AS (
  SELECT CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS transaction_id,
         o.o_custkey AS user_id,
         l.l_partkey AS product_id,
         CAST(o.o_orderdate AS DATE) AS dat_creation,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS amount,
         o.o_orderpriority AS payment_method,
         strftime(o.o_orderdate, '%Y%m%d') AS ref,
         strftime(o.o_orderdate, '%Y%m%d') || '000000' AS ts_file_generation,
         strftime(o.o_orderdate, '%Y%m') || '01000000' AS ts_proc
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
)"""

PRODUCTS = """
products AS (
  SELECT p_partkey AS product_id, p_name AS product_des, p_type AS product_category,
         '20010731' AS ref, '20010731000000' AS ts_file_generation, '20010731120000' AS ts_proc
  FROM part
)"""

ENRICHED = """
enriched AS (
  SELECT s.*, p.product_category
  FROM sales s LEFT JOIN products p ON s.product_id = p.product_id
)"""

# int(months_between(e, r)): whole months when same day-of-month or both
# month-ends, else months + day difference / 31, truncated toward zero.
AGED = f"""
dated AS (
  SELECT *, CAST(try_strptime(ref, '%Y%m%d') AS DATE) AS r_date, DATE '{AS_OF}' AS e_date FROM enriched
),
aged AS (
  SELECT *,
    CASE WHEN r_date IS NULL THEN NULL
         WHEN day(r_date) = day(e_date) OR (r_date = last_day(r_date) AND e_date = last_day(e_date))
           THEN CAST(12 * (year(e_date) - year(r_date)) + month(e_date) - month(r_date) AS INTEGER)
         ELSE CAST(trunc((31 * (12 * (year(e_date) - year(r_date)) + month(e_date) - month(r_date))
                          + day(e_date) - day(r_date)) / 31.0) AS INTEGER)
    END AS age
  FROM dated
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


def _feature_sql(literal: bool = False) -> list[tuple[str, str, str]]:
    """(name, family, SQL expression) for every book column."""
    out = []
    plan = [
        ("pcat", "product_category", CATEGORIES, ["qtd", "sum", "avg", "min", "max"]),
        ("pm", "payment_method", PAYMENTS, ["qtd", "sum", "min", "max", "avg"]),
    ]
    for tag, column, values, families in plan:
        for fam in families:
            for months in [None, 1, 3, 6, 12]:
                for value, label in values:
                    name = f"{fam}_{tag}_{label}" + ("" if months is None else f"_u{months}m")
                    tested = months
                    if literal and tag == "pcat" and fam in ("qtd", "sum") and months == 12:
                        tested = 6
                    cond = f"{column} = '{value}'" + ("" if tested is None else f" AND age <= {tested}")
                    if fam == "qtd":
                        expr = f"CAST(SUM(CASE WHEN {cond} THEN 1 END) AS BIGINT)"
                    elif fam == "sum":
                        expr = f"CAST(SUM(CASE WHEN {cond} THEN amount END) AS DOUBLE)"
                    elif fam == "min":
                        expr = f"CAST(MIN(CASE WHEN {cond} THEN amount END) AS DOUBLE)"
                    elif fam == "max":
                        expr = f"CAST(MAX(CASE WHEN {cond} THEN amount END) AS DOUBLE)"
                    else:
                        expr = (
                            f"CAST(SUM(CASE WHEN {cond} THEN amount END) AS DOUBLE)"
                            f" / NULLIF(COUNT(CASE WHEN {cond} THEN amount END), 0)"
                        )
                    out.append((name, f"{fam}_{tag}", expr))
    return out


def _book_sql(literal: bool = False, family: str | None = None, where: str = "", sales: str = SALES) -> str:
    feats = [f for f in _feature_sql(literal) if family is None or f[1] == family]
    head = ["user_id"] if family else ["user_id", f"'{BOOK_REF}' AS ref", f"'{BOOK_TS}' AS ts_proc"]
    cols = ",\n  ".join(head + [f"{expr} AS {name}" for name, _, expr in feats])
    return _with(sales, PRODUCTS, ENRICHED, AGED) + f"\nSELECT\n  {cols}\nFROM aged {where}\nGROUP BY user_id"


# The same with every window on the sale's date instead of the snapshot's ref.
SALE_DATED = AGED.replace("CAST(try_strptime(ref, '%Y%m%d') AS DATE) AS r_date", "dat_creation AS r_date")


def _sale_date_book(sales: str = SALES) -> str:
    return _book_sql(sales=sales).replace(AGED, SALE_DATED)


# Sales after the bronze CSV -> silver load: every row carries the snapshot's
# ref (so all ages are equal) and the ids are text.
SALES_SILVER = """
sales AS (
  SELECT CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS transaction_id,
         CAST(o.o_custkey AS VARCHAR) AS user_id,
         CAST(l.l_partkey AS VARCHAR) AS product_id,
         CAST(o.o_orderdate AS DATE) AS dat_creation,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS amount,
         o.o_orderpriority AS payment_method,
         '20010731' AS ref,
         '20010731230000' AS ts_file_generation,
         '20010801000000' AS ts_proc
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
)"""

PRODUCT_TEXT = "CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_des, p_type AS product_category"


def _product_rows(ref: str, tsf: str, ts_proc: str) -> str:
    return (
        f"SELECT '{ref}' AS ref, '{tsf}' AS ts_file_generation, '{ts_proc}' AS ts_proc, {PRODUCT_TEXT} FROM part"
    )


def _control_sql() -> str:
    sales_rows = "(SELECT COUNT(*) FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"
    return (
        "SELECT 'users' AS assunto, '20010731' AS ref, '20010731000000' AS ts_file_generation,"
        " '20010731130000' AS ts_proc, (SELECT COUNT(*) FROM customer) AS qtd_registros"
        " UNION ALL SELECT 'products', '20010731', '20010731000000', '20010731120000', (SELECT COUNT(*) FROM part)"
        f" UNION ALL SELECT 'sales', '20010731', '20010731230000', '20010801000000', {sales_rows}"
    )


SALES_OUT = (
    "transaction_id, user_id, product_id, dat_creation, CAST(amount AS DOUBLE) AS amount, "
    "payment_method, ref, ts_file_generation, ts_proc"
)


def _totals_sql() -> str:
    cols = []
    for months in (None, 1, 3, 6, 12):
        tail, cond = ("", "true") if months is None else (f"_u{months}m", f"age <= {months}")
        amount, n = f"CASE WHEN {cond} THEN amount END", f"CAST(SUM(CASE WHEN {cond} THEN 1 END) AS BIGINT)"
        cols += [f"{n} AS qtd_total{tail}", f"CAST(SUM({amount}) AS DOUBLE) / NULLIF(COUNT({amount}), 0) AS avg_total{tail}"]
        cols += [f"CAST({fn}({amount}) AS DOUBLE) AS {fn.lower()}_total{tail}" for fn in ("SUM", "MIN", "MAX")]
    return _with(SALES, PRODUCTS, ENRICHED, AGED) + f"\nSELECT user_id, {', '.join(cols)} FROM aged GROUP BY user_id"


BOOK_DATES = ("2000-06-30", "2001-01-31", "2001-07-31")


def _books_sql(where: str = "") -> str:
    books = [
        _book_sql(where=where.format(d)).replace(f"DATE '{AS_OF}'", f"DATE '{d}'").replace(f"'{BOOK_REF}' AS ref,", f"'{d.replace('-', '')}' AS ref,")
        for d in BOOK_DATES
    ]
    return " UNION ALL ".join(f"SELECT * FROM ({b})" for b in books)


# three product snapshots: all; some gone, some renamed; some gone, some back, some new
SNAPSHOTS = f"""
first AS (SELECT p_partkey AS k, p_name AS d, p_type AS c FROM part),
second AS (SELECT k, CASE WHEN k % 7 = 0 THEN d || ' 2' ELSE d END AS d, c FROM first WHERE k % 13 <> 0),
third AS (
  SELECT * FROM second WHERE k % 11 <> 0 UNION ALL SELECT * FROM first WHERE k % 26 = 0 UNION ALL SELECT -k - 1, d, c FROM first WHERE k % 17 = 0
)"""

CHANGES = f"""
WITH {SNAPSHOTS}
SELECT CAST(k AS VARCHAR) AS product_id, d AS product_des, c AS product_category, change FROM (
  SELECT *, 'inserted' AS change FROM third WHERE k NOT IN (SELECT k FROM second)
  UNION ALL SELECT *, 'deleted' FROM second WHERE k NOT IN (SELECT k FROM third)
  UNION ALL SELECT third.*, 'updated' FROM third JOIN second USING (k) WHERE third.d <> second.d OR third.c <> second.c
)"""

# per key the names it has in the three snapshots (NULL: not there); an interval ends where the next one differs
HISTORY = f"""
WITH {SNAPSHOTS},
seen AS (SELECT k, 1 AS s, d, c FROM first UNION ALL SELECT k, 2, d, c FROM second UNION ALL SELECT k, 3, d, c FROM third),
started AS (
  SELECT seen.* FROM seen LEFT JOIN seen p ON p.k = seen.k AND p.s = seen.s - 1 AND p.d = seen.d AND p.c = seen.c WHERE p.k IS NULL
),
ended AS (
  SELECT started.*, (SELECT min(x.s) FROM (VALUES (2), (3), (4)) x(s) WHERE x.s > started.s AND NOT EXISTS (
    SELECT 1 FROM seen n WHERE n.k = started.k AND n.s = x.s AND n.d = started.d AND n.c = started.c)) AS e FROM started
)
SELECT CAST(k AS VARCHAR) AS product_id, d AS product_des, c AS product_category,
  '200107' || (28 + s) || '000000' AS valid_from, CASE WHEN e <= 3 THEN '200107' || (28 + e) || '000000' END AS valid_to
FROM ended
"""

# firing, subject, stamp, file stamp and the table whose rows were loaded
ARRIVALS = " UNION ALL ".join(
    f"SELECT {n}::BIGINT AS firing, '{subject}' AS assunto, '{ts_proc}' AS ts_proc, '{tsf}' AS ts_file_generation, count(*) AS qtd_registros FROM {rows}"
    for n, subject, ts_proc, tsf, rows in (
        (1, "users", "20010731130000", "20010731000000", "customer"),
        (1, "products", "20010731120000", "20010731000000", "part"),
        (1, "sales", "20010801000000", "20010731230000", "lineitem JOIN orders ON l_orderkey = o_orderkey"),
        (2, "products", "20010802000000", "20010801000000", "part"),
        (2, "users", "20010802010000", "20010801000000", "customer"),
        (2, "sales", "20010802020000", "20010801230000", "lineitem JOIN orders ON l_orderkey = o_orderkey"),
    )
)

REJECTS = """
WITH t AS (
  SELECT l_orderkey || '-' || l_linenumber AS transaction_id, l_orderkey + l_linenumber AS k,
    strftime(l_shipdate, '%Y-%m-%d') AS d, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS a FROM lineitem
),
r AS (
  SELECT transaction_id, CASE WHEN k % 11 = 0 THEN 'no date' ELSE d END AS dat_creation,
    CASE k % 7 WHEN 0 THEN 'x' WHEN 1 THEN a || '5' WHEN 2 THEN NULL ELSE a END AS amount,
    CASE WHEN k % 11 = 0 AND k % 7 < 2 THEN 'dat_creation,amount' WHEN k % 11 = 0 THEN 'dat_creation' WHEN k % 7 < 2 THEN 'amount' ELSE '' END AS faults
  FROM t
)
SELECT * FROM r
UNION ALL
SELECT 'control', 'date:' || count(*) FILTER (faults LIKE 'dat%'), 'amount:' || count(*) FILTER (faults LIKE '%amount'),
  count(*) FILTER (faults = '') || ':' || count(*) FILTER (faults <> '') FROM r
"""

NULLS = """
WITH t AS (
  SELECT CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE CAST(p_partkey AS VARCHAR) END AS id,
    CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 3 = 0 THEN '' WHEN p_partkey % 3 = 1 THEN '"' || p_name || '", ' || chr(10) ELSE p_name END AS name
  FROM part
)
SELECT id, name, 2 AS columns FROM t UNION ALL SELECT NULL, name, 1 FROM t
"""


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL per query name (same column names as the Spark side)."""
    book = _book_sql()
    sql = {
        "feature_book": book,
        "feature_book_one_stage": book,
        "feature_book_shuffle_join": book,
        "feature_book_literal": _book_sql(literal=True),
        "feature_book_lookback": _book_sql(where=f"WHERE ref >= '{LOOKBACK}'"),
        "month_age": _with(SALES, PRODUCTS, ENRICHED, AGED)
        + "\nSELECT transaction_id, user_id, ref, age AS month_age FROM aged",
        "recency_flags": _with(SALES, PRODUCTS, ENRICHED, AGED)
        + "\nSELECT transaction_id, user_id, ref, product_category, dat_creation,"
        " CAST(amount AS DOUBLE) AS amount, payment_method,"
        " CASE WHEN age <= 1 THEN 1 ELSE 0 END AS flag_u1m,"
        " CASE WHEN age <= 3 THEN 1 ELSE 0 END AS flag_u3m,"
        " CASE WHEN age <= 6 THEN 1 ELSE 0 END AS flag_u6m,"
        " CASE WHEN age <= 12 THEN 1 ELSE 0 END AS flag_u12m FROM aged",
        "category_enrichment": _with(SALES, PRODUCTS, ENRICHED)
        + f"\nSELECT {SALES_OUT}, product_category FROM enriched",
        "batch_histogram": _with(SALES)
        + "\nSELECT ts_proc || ts_file_generation AS dedup_key, COUNT(*) AS n_rows FROM sales GROUP BY 1",
        "latest_batch_proc_first": _with(SALES)
        + f"\nSELECT {SALES_OUT} FROM sales"
        " WHERE ts_proc || ts_file_generation = (SELECT MAX(ts_proc || ts_file_generation) FROM sales)",
        "latest_batch_file_first": _with(SALES)
        + f"\nSELECT {SALES_OUT} FROM sales"
        " WHERE ts_file_generation || ts_proc = (SELECT MAX(ts_file_generation || ts_proc) FROM sales)",
        "lookback_filter": _with(SALES) + f"\nSELECT {SALES_OUT} FROM sales WHERE ref >= '{LOOKBACK}'",
    }
    sql.update(
        {
            "bronze_roundtrip": f"SELECT {PRODUCT_TEXT} FROM part",
            "silver_products": _product_rows("20010731", "20010731000000", "20010731120000"),
            "silver_sales": _with(SALES_SILVER)
            + "\nSELECT ref, ts_file_generation, ts_proc, transaction_id, user_id, product_id, dat_creation,"
            " CAST(amount AS DOUBLE) AS amount, payment_method FROM sales",
            "latest_file": "SELECT CAST(p_partkey AS VARCHAR) AS product_id,"
            " 'products_20010731_20010731000000.csv' AS filename, '20010731' AS ref,"
            " '20010731000000' AS ts_file_generation FROM part",
            "lineage_columns": "SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey,"
            " CAST(l_linenumber AS VARCHAR) AS l_linenumber,"
            " 'order_items_20010731_20010731221500.csv' AS filename, '20010731' AS ref,"
            " '20010731221500' AS ts_file_generation, '20010801010000' AS ts_proc FROM lineitem",
            "control_rows": _control_sql(),
            # previous book at 20010731125000: users and sales arrived since, products not.
            "readiness": "SELECT assunto, ts_proc, qtd_registros, ts_proc > '20010731125000' AS received,"
            f" false AS ready FROM ({_control_sql()}) c",
            "silver_latest_batch": _product_rows("20010731", "20010731000000", "20010731110000"),
            "gold_roundtrip": book,
            "gold_from_silver": _book_sql(sales=SALES_SILVER),
            "gold_job": _book_sql(sales=SALES_SILVER),
            "recency_flags_long": _with(SALES, PRODUCTS, ENRICHED, SALE_DATED)
            + "\nSELECT transaction_id, user_id, dat_creation,"
            " CASE WHEN age <= 12 THEN 1 ELSE 0 END AS flag_u12m,"
            " CASE WHEN age <= 24 THEN 1 ELSE 0 END AS flag_u24m,"
            " CASE WHEN age <= 36 THEN 1 ELSE 0 END AS flag_u36m FROM aged",
            "feature_book_sale_date": _sale_date_book(),
            "gold_job_sale_date": _sale_date_book(SALES_SILVER),
            "silver_two_snapshots_one_stamp": _product_rows("20010731", "20010731000000", "20010731120000")
            + " UNION ALL "
            + _product_rows("20010731", "20010731060000", "20010731120000"),
            "control_rerun": "SELECT 'products' AS assunto, '20010730' AS ref, '20010730000000' AS ts_file_generation,"
            " '20010730120000' AS ts_proc, (SELECT COUNT(*) FROM part) AS qtd_registros"
            " UNION ALL SELECT 'products', '20010731', '20010731000000', '20010731120000', (SELECT COUNT(*) FROM part)",
            "readiness_ready": "SELECT assunto, ts_proc, CASE assunto WHEN 'products' THEN 2 ELSE 1 END * qtd_registros"
            f" AS qtd_registros, true AS received, true AS ready FROM ({_control_sql()}) c",
            "latest_file_committed": "SELECT CAST(p_partkey AS VARCHAR) AS product_id,"
            " 'products_20010730_20010730000000.csv' AS filename, '20010730' AS ref,"
            " '20010730000000' AS ts_file_generation FROM part",
            "stream_control": "SELECT 'products' AS assunto, '20010730' AS ref, '20010730000000' AS ts_file_generation,"
            " '20010801030000' AS ts_proc, (SELECT COUNT(*) FROM part) AS qtd_registros"
            " UNION ALL SELECT 'products', '20010731', '20010731000000', '20010801030000', 0",
            "silver_latest_of_loads": _product_rows("20010731", "20010731000000", "20010731110000"),
            "silver_latest_of_loads_proc_first": _product_rows("20010730", "20010730000000", "20010731120000"),
            "feature_book_totals": _totals_sql(),
            "feature_book_windows": _with(SALES, PRODUCTS, ENRICHED, AGED) + "\nSELECT user_id, "
            + ", ".join(f"{expr} AS {name}" for name, _, expr in _feature_sql() if name.endswith("m") and "_u" in name)
            # a user without a row in any window has no row in the pruned book
            + " FROM aged GROUP BY user_id HAVING count(CASE WHEN ref >= '20000601' THEN 1 END) > 0",
            "feature_books_by_date": _books_sql("WHERE r_date <= DATE '{}'"),
            "feature_books_all_rows": _books_sql(),
            "snapshot_changes": CHANGES,
            "silver_history": HISTORY,
            "batch_profile": _with(SALES) + " UNION ALL ".join(
                f"\nSELECT ts_proc, '{c}' AS \"column\", count(*) AS rows, count(*) FILTER ({c} IS NULL) AS nulls,"
                f" CAST(min({c}) AS VARCHAR) AS least, CAST(max({c}) AS VARCHAR) AS greatest FROM sales GROUP BY ts_proc"
                for c in ("transaction_id", "user_id", "product_id", "dat_creation", "amount", "payment_method")
            ),
            "extract_splits": "SELECT count(*) + 1 AS rows, 1 AS most_reads, 1 AS least_reads, true AS even FROM lineitem",
            "arrival_gate_stream": ARRIVALS,
            "silver_recovered": _product_rows("20010731", "20010731000000", "20010731120000"),
            "silver_rejects": REJECTS,
            "bronze_nulls": NULLS,
            "stream_external": " UNION ALL ".join(
                f"SELECT ref, ts_file_generation, product_id, product_des, product_category FROM ({_product_rows(f'200107{d}', f'200107{d}000000', '')})"
                for d in ("30", "31")
            ),
            "stream_silver": _product_rows("20010730", "20010730000000", "20010801030000")
            + " UNION ALL "
            + _product_rows("20010731", "20010731000000", "20010801030000"),
        }
    )
    sql["category_enrichment_shuffle"] = sql["category_enrichment"]
    sql["latest_batch_by_key"] = sql["latest_batch_proc_first"]
    for fam in ("qtd", "sum", "avg", "min", "max"):
        for tag in ("pcat", "pm"):
            sql[f"book_{fam}_{tag}"] = _book_sql(family=f"{fam}_{tag}")
    if llm_queries is not None:
        sql.update(llm_queries.oracle_sql())
    return sql
