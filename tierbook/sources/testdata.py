"""Map the driver's star-schema tables onto the lake's subjects.

sales row   = lineitem joined to its order (every line has an order)
user_id     = o_custkey           product_id     = l_partkey
amount      = l_extendedprice as decimal(18,2)
payment     = o_orderpriority     dat_creation   = o_orderdate
ref         = yyyyMMdd of the order date
batch stamps: ts_file_generation = order day ``yyyyMMdd000000``,
              ts_proc = order month ``yyyyMM01000000``
products    = part (p_partkey, p_name, p_type), one snapshot batch
users       = customer
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierbook.operators.book import BookSpec, make_spec
from tierbook.sources.files import CSV_OPTIONS
from tierbook.sources.storage import list_folder, remove, rename

# Fixed values for the driver data: which p_type / o_orderpriority values get
# feature columns (the others stay unlisted), the book date and run stamps.
TESTDATA_CATEGORY_VALUES = (
    ("ECONOMY", "economy"),
    ("LARGE", "large"),
    ("PROMO", "promo"),
    ("SMALL", "small"),
)
TESTDATA_PAYMENT_VALUES = (
    ("1-URGENT", "urgent"),
    ("2-HIGH", "high"),
    ("3-MEDIUM", "medium"),
    ("5-LOW", "low"),
)
AS_OF = "2001-07-31"
BOOK_REF = "20010731"
BOOK_TS_PROC = "20010801060000"
PRODUCTS_REF = "20010731"
PRODUCTS_TSF = "20010731000000"
PRODUCTS_TS_PROC = "20010731120000"
USERS_REF = "20010731"
USERS_TSF = "20010731000000"
USERS_TS_PROC = "20010731130000"


def testdata_spec() -> BookSpec:
    return make_spec(TESTDATA_CATEGORY_VALUES, TESTDATA_PAYMENT_VALUES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales rows with lineage stamps (typed, not yet through silver)."""
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority").hint("merge")
    joined = line.join(orders, line.l_orderkey == orders.o_orderkey, "inner")
    day = F.date_format("o_orderdate", "yyyyMMdd")
    return joined.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias(
            "transaction_id"
        ),
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("product_id"),
        F.to_date("o_orderdate").alias("dat_creation"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"),
        F.col("o_orderpriority").alias("payment_method"),
        day.alias("ref"),
        F.concat(day, F.lit("000000")).alias("ts_file_generation"),
        F.concat(F.date_format("o_orderdate", "yyyyMM"), F.lit("01000000")).alias("ts_proc"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product snapshot (one batch) with lineage stamps."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_des"),
        F.col("p_type").alias("product_category"),
        F.lit(PRODUCTS_REF).alias("ref"),
        F.lit(PRODUCTS_TSF).alias("ts_file_generation"),
        F.lit(PRODUCTS_TS_PROC).alias("ts_proc"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("user_name"),
        F.col("c_mktsegment").alias("segment"),
    )


def put_file(df: DataFrame, path: str) -> str:
    """``df`` as one CSV file named ``path``, as a program outside Spark delivers a
    snapshot: one task writes it, and it appears under its name at once."""
    spark, (folder, name) = df.sparkSession, path.rsplit("/", 1)
    temporary = f"{folder}/_put-{uuid.uuid4().hex}"
    df.select(*(F.col(f"`{c}`").cast("string").alias(c) for c in df.columns)).coalesce(1).write.options(**CSV_OPTIONS).csv(temporary)
    part = next(e.name for e in list_folder(spark, temporary) if e.name.endswith(".csv"))
    rename(spark, f"{temporary}/{part}", f"{folder}/{name}")
    remove(spark, temporary)
    return path
