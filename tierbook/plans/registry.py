"""Named queries over the driver's test tables, one per operator.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
tables. Money leaves as DOUBLE (decimal inside), counts as BIGINT, flags and
ages as INT, stamps as text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierbook.functions.dates import lookback_start, month_age, window_start
from tierbook.operators import latest
from tierbook.operators.book import literal_spec, month_flags
from tierbook.operators.books import feature_books
from tierbook.operators.changes import key_history, snapshot_changes
from tierbook.operators.enrich import category_enrichment
from tierbook.operators.control import readiness
from tierbook.operators.lookback import lookback_filter
from tierbook.operators.profile import profile
from tierbook.operators.silver import lineage_columns
from tierbook.plans.bronze import snapshot_to_bronze
from tierbook.plans.gold import build_book
from tierbook.plans.silver import load_subject
from tierbook.schemas import PRODUCTS, SALES, USERS
from tierbook.session import scratch_path
from tierbook.sinks import commits
from tierbook.sinks.writers import bronze_snapshot_path, commit_snapshot, write_gold
from tierbook.sources import testdata as td
from tierbook.sources.files import latest_snapshot, read_bronze
from tierbook.sources.splits import split_predicates
from tierbook.sources.lake import read_control, read_gold, read_latest_load, read_load_report, read_rejects, read_silver
from tierbook.streaming.arrivals import firings, run_gate
from tierbook.streaming.silver_stream import run_silver_stream

Query = Callable[[SparkSession, str], DataFrame]

def _money(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


def _book(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    spec = kw.pop("spec", td.testdata_spec())
    return build_book(
        td.sales(spark, sf_dir),
        td.products(spark, sf_dir),
        spec,
        td.AS_OF,
        td.BOOK_REF,
        td.BOOK_TS_PROC,
        latest_sales=False,
        **kw,
    )


def q_feature_book(spark, sf_dir):
    return _book(spark, sf_dir)


def q_feature_book_one_stage(spark, sf_dir):
    return _book(spark, sf_dir, method="one_stage")


def q_feature_book_shuffle_join(spark, sf_dir):
    # Force the above-the-broadcast-bound path: shuffle join with salted hot keys.
    return _book(spark, sf_dir, max_broadcast_rows=0)


def q_feature_book_literal(spark, sf_dir):
    return _book(spark, sf_dir, spec=literal_spec(td.testdata_spec()))


def _family(stat: str, dim: str) -> Query:
    def run(spark, sf_dir):
        spec = td.testdata_spec()
        names = [f.name for f in spec.features() if f.stat == stat and f.dimension.tag == dim]
        return _book(spark, sf_dir).select("user_id", *names)

    run.__name__ = f"q_book_{stat}_{dim}"
    return run


def q_month_age(spark, sf_dir):
    s = td.sales(spark, sf_dir)
    return s.select("transaction_id", "user_id", "ref", month_age(td.AS_OF, "ref").alias("month_age"))


def _enriched(spark, sf_dir):
    return category_enrichment(td.sales(spark, sf_dir), td.products(spark, sf_dir))


def q_category_enrichment(spark, sf_dir):
    return _money(_enriched(spark, sf_dir), "amount")


def q_category_enrichment_shuffle(spark, sf_dir):
    out = category_enrichment(td.sales(spark, sf_dir), td.products(spark, sf_dir), max_broadcast_rows=0)
    return _money(out, "amount")


def q_recency_flags(spark, sf_dir):
    cols = ["transaction_id", "user_id", "ref", "product_category", "dat_creation", "amount", "payment_method"]
    flagged = month_flags(_enriched(spark, sf_dir).select(*cols), td.AS_OF)
    return _money(flagged, "amount")


def q_batch_histogram(spark, sf_dir):
    return latest.batch_histogram(td.sales(spark, sf_dir), latest.PROC_FIRST)


def q_latest_batch_proc_first(spark, sf_dir):
    return _money(latest.latest_batch(td.sales(spark, sf_dir), latest.PROC_FIRST), "amount")


def q_latest_batch_file_first(spark, sf_dir):
    return _money(latest.latest_batch(td.sales(spark, sf_dir), latest.FILE_FIRST), "amount")


def q_latest_batch_by_key(spark, sf_dir):
    return _money(latest.latest_batch_by_key(td.sales(spark, sf_dir), latest.PROC_FIRST), "amount")


def q_lookback_filter(spark, sf_dir):
    out = lookback_filter(td.sales(spark, sf_dir), lookback_start(td.AS_OF))
    return _money(out, "amount")


def q_feature_book_totals(spark, sf_dir):
    spec = replace(td.testdata_spec(), totals=True)
    return _book(spark, sf_dir, spec=spec).select("user_id", *[n for n in spec.feature_names() if "_total" in n])


def q_feature_book_windows(spark, sf_dir):
    # refs that no window reaches are never read; the windows' columns are those of the whole book
    spec = td.testdata_spec()
    book = _book(spark, sf_dir, lookback_start=window_start(td.AS_OF, max(spec.boundaries())))
    return book.select("user_id", *[f.name for f in spec.features() if f.window])


def q_feature_book_lookback(spark, sf_dir):
    return _book(spark, sf_dir, lookback_start=lookback_start(td.AS_OF))


# ---------------------------------------------------------------------------
# Lake layers: every query writes into a fresh folder under the shared root
# (spark.checkpoint.dir), then reads back with a declared schema.

SALES_REF, SALES_TSF, SALES_TS_PROC = "20010731", "20010731230000", "20010801000000"
STREAM_BASE_TS_PROC = "20010801030000"
SINCE_TS_PROC = "20010731125000"  # stamp of the previous book (readiness gate)
SUBJECT_NAMES = ("users", "products", "sales")


class Lake:
    def __init__(self, spark: SparkSession, purpose: str):
        root = scratch_path(spark, purpose)
        self.bronze = f"{root}/0000_bronze"
        self.silver = f"{root}/0001_silver"
        self.gold = f"{root}/0002_gold"
        self.control = f"{root}/0003_control"
        self.checkpoints = f"{root}/checkpoints"

    def silver_of(self, subject: str) -> str:
        return f"{self.silver}/{subject}"

    def control_of(self, subject: str) -> str:
        return f"{self.control}/{subject}"


def _products_source(spark, sf_dir):
    return td.products(spark, sf_dir).select(*PRODUCTS.columns.fieldNames())


def _sales_source(spark, sf_dir):
    return td.sales(spark, sf_dir).select(*SALES.columns.fieldNames())


def _users_source(spark, sf_dir):
    return td.users(spark, sf_dir).select(*USERS.columns.fieldNames())


def _load(spark, lake: Lake, spec, source, ref, tsf, ts_proc):
    path = snapshot_to_bronze(source, lake.bronze, spec.name, ref, tsf)
    return load_subject(
        spark, spec, lake.bronze, lake.silver_of(spec.name), lake.control_of(spec.name), ts_proc, path
    )


def q_bronze_roundtrip(spark, sf_dir):
    lake = Lake(spark, "bronze-roundtrip")
    path = snapshot_to_bronze(_products_source(spark, sf_dir), lake.bronze, "products", td.PRODUCTS_REF, td.PRODUCTS_TSF)
    return read_bronze(spark, path, with_lineage=False)


def q_silver_products(spark, sf_dir):
    lake = Lake(spark, "silver-products")
    _load(spark, lake, PRODUCTS, _products_source(spark, sf_dir), td.PRODUCTS_REF, td.PRODUCTS_TSF, td.PRODUCTS_TS_PROC)
    return read_silver(spark, lake.silver_of("products"), PRODUCTS)


def q_silver_sales(spark, sf_dir):
    lake = Lake(spark, "silver-sales")
    _load(spark, lake, SALES, _sales_source(spark, sf_dir), SALES_REF, SALES_TSF, SALES_TS_PROC)
    return _money(read_silver(spark, lake.silver_of("sales"), SALES), "amount")


def q_latest_file(spark, sf_dir):
    lake = Lake(spark, "latest-file")
    src = _products_source(spark, sf_dir)
    snapshot_to_bronze(src, lake.bronze, "products", "20010730", "20010730000000")
    snapshot_to_bronze(src, lake.bronze, "products", "20010731", "20010731000000")
    path = latest_snapshot(spark, f"{lake.bronze}/products", "products")
    rows = lineage_columns(read_bronze(spark, path), td.PRODUCTS_TS_PROC)
    return rows.select("product_id", "filename", "ref", "ts_file_generation")


def q_lineage_columns(spark, sf_dir):
    # A subject whose name contains "_", one folder level deeper than usual.
    lake = Lake(spark, "lineage")
    items = td.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    path = snapshot_to_bronze(items, f"{lake.bronze}/erp", "order_items", "20010731", "20010731221500")
    rows = lineage_columns(read_bronze(spark, path), "20010801010000")
    return rows.select("l_orderkey", "l_linenumber", "filename", "ref", "ts_file_generation", "ts_proc")


def _three_loads(spark, sf_dir, lake):
    _load(spark, lake, USERS, _users_source(spark, sf_dir), td.USERS_REF, td.USERS_TSF, td.USERS_TS_PROC)
    _load(spark, lake, PRODUCTS, _products_source(spark, sf_dir), td.PRODUCTS_REF, td.PRODUCTS_TSF, td.PRODUCTS_TS_PROC)
    _load(spark, lake, SALES, _sales_source(spark, sf_dir), SALES_REF, SALES_TSF, SALES_TS_PROC)


def q_control_rows(spark, sf_dir):
    lake = Lake(spark, "control")
    _three_loads(spark, sf_dir, lake)
    return read_control(spark, *(lake.control_of(s) for s in SUBJECT_NAMES))


def q_readiness(spark, sf_dir):
    lake = Lake(spark, "readiness")
    _three_loads(spark, sf_dir, lake)
    control = read_control(spark, *(lake.control_of(s) for s in SUBJECT_NAMES))
    return readiness(spark, control, SUBJECT_NAMES, SINCE_TS_PROC)


def q_silver_latest_batch(spark, sf_dir):
    # Two product loads; the newest file wins (file-first order), read with
    # partition pruning on the silver layout.
    lake = Lake(spark, "silver-latest")
    src = _products_source(spark, sf_dir)
    _load(spark, lake, PRODUCTS, src, "20010730", "20010730000000", "20010731120000")
    _load(spark, lake, PRODUCTS, src, "20010731", "20010731000000", "20010731110000")
    silver = read_silver(spark, lake.silver_of("products"), PRODUCTS)
    return latest.latest_batch(silver, latest.FILE_FIRST)


def q_gold_roundtrip(spark, sf_dir):
    from pyspark.sql import types as T

    lake = Lake(spark, "gold")
    spec = td.testdata_spec()
    write_gold(_book(spark, sf_dir, spec=spec), lake.gold, td.BOOK_REF, td.BOOK_TS_PROC)
    return read_gold(spark, lake.gold, spec, T.LongType())


def q_gold_from_silver(spark, sf_dir):
    # End to end: bronze -> silver (sales, products) -> latest batches -> book.
    lake = Lake(spark, "gold-from-silver")
    _load(spark, lake, PRODUCTS, _products_source(spark, sf_dir), td.PRODUCTS_REF, td.PRODUCTS_TSF, td.PRODUCTS_TS_PROC)
    _load(spark, lake, SALES, _sales_source(spark, sf_dir), SALES_REF, SALES_TSF, SALES_TS_PROC)
    return build_book(
        read_silver(spark, lake.silver_of("sales"), SALES),
        read_silver(spark, lake.silver_of("products"), PRODUCTS),
        td.testdata_spec(),
        td.AS_OF,
        td.BOOK_REF,
        td.BOOK_TS_PROC,
    )


def q_gold_job(spark, sf_dir):
    # The published job end to end: loads, then the gold job reads silver,
    # picks both latest batches and writes the book.
    from pyspark.sql import types as T

    from tierbook.plans.gold import gold_job

    lake = Lake(spark, "gold-job")
    _load(spark, lake, PRODUCTS, _products_source(spark, sf_dir), td.PRODUCTS_REF, td.PRODUCTS_TSF, td.PRODUCTS_TS_PROC)
    _load(spark, lake, SALES, _sales_source(spark, sf_dir), SALES_REF, SALES_TSF, SALES_TS_PROC)
    spec = td.testdata_spec()
    gold_job(
        spark, lake.silver_of("sales"), lake.silver_of("products"), lake.gold, spec, td.AS_OF, td.BOOK_TS_PROC,
    )
    return read_gold(spark, lake.gold, spec, T.StringType())


def q_recency_flags_long(spark, sf_dir):
    # windows of one, two and three years, on the sale's date
    s = td.sales(spark, sf_dir).select("transaction_id", "user_id", "dat_creation")
    return month_flags(s, td.AS_OF, (12, 24, 36), "dat_creation")


def q_feature_book_sale_date(spark, sf_dir):
    return _book(spark, sf_dir, date_col="dat_creation")


def q_gold_job_sale_date(spark, sf_dir):
    # ages from the sale's date, through bronze and silver; batches from the control rows
    from pyspark.sql import types as T

    from tierbook.plans.gold import gold_job

    lake = Lake(spark, "gold-sale-date")
    _load(spark, lake, PRODUCTS, _products_source(spark, sf_dir), td.PRODUCTS_REF, td.PRODUCTS_TSF, td.PRODUCTS_TS_PROC)
    _load(spark, lake, SALES, _sales_source(spark, sf_dir), SALES_REF, SALES_TSF, SALES_TS_PROC)
    spec = td.testdata_spec()
    gold_job(
        spark, lake.silver_of("sales"), lake.silver_of("products"), lake.gold, spec, td.AS_OF, td.BOOK_TS_PROC,
        sales_control=lake.control_of("sales"), products_control=lake.control_of("products"), date_col="dat_creation",
    )
    return read_gold(spark, lake.gold, spec, T.StringType())


def q_silver_two_snapshots_one_stamp(spark, sf_dir):
    lake = Lake(spark, "silver-two")
    src = _products_source(spark, sf_dir)
    for tsf in ("20010731000000", "20010731060000"):
        _load(spark, lake, PRODUCTS, src, "20010731", tsf, "20010731120000")
    return read_silver(spark, lake.silver_of("products"), PRODUCTS)


def q_control_rerun(spark, sf_dir):
    # two loads, then one of them again: one row per load
    lake = Lake(spark, "control-rerun")
    src = _products_source(spark, sf_dir)
    for day in ("30", "31"):
        path = snapshot_to_bronze(src, lake.bronze, "products", f"200107{day}", f"200107{day}000000")
        for _ in range(1 if day == "30" else 2):
            load_subject(
                spark, PRODUCTS, lake.bronze, lake.silver_of("products"), lake.control_of("products"), f"200107{day}120000", path
            )
    return read_control(spark, lake.control_of("products"))


def q_readiness_ready(spark, sf_dir):
    # every subject arrived; two product snapshots under one stamp count together
    lake = Lake(spark, "readiness-ready")
    _three_loads(spark, sf_dir, lake)
    _load(spark, lake, PRODUCTS, _products_source(spark, sf_dir), td.PRODUCTS_REF, "20010731060000", td.PRODUCTS_TS_PROC)
    control = read_control(spark, *(lake.control_of(s) for s in SUBJECT_NAMES))
    return readiness(spark, control, SUBJECT_NAMES, "20010731000000")


def q_latest_file_committed(spark, sf_dir):
    # a newer snapshot whose write never finished is not taken
    lake = Lake(spark, "latest-committed")
    src = _products_source(spark, sf_dir)
    snapshot_to_bronze(src, lake.bronze, "products", "20010730", "20010730000000")
    src.write.option("header", "true").csv(bronze_snapshot_path(lake.bronze, "products", "20010731", "20010731000000"))
    path = latest_snapshot(spark, f"{lake.bronze}/products", "products")
    rows = lineage_columns(read_bronze(spark, path), td.PRODUCTS_TS_PROC)
    return rows.select("product_id", "filename", "ref", "ts_file_generation")


def q_stream_control(spark, sf_dir):
    # a header-only snapshot gets its zero row from the stream
    lake = Lake(spark, "stream-control")
    src = _products_source(spark, sf_dir)
    snapshot_to_bronze(src, lake.bronze, "products", "20010730", "20010730000000")
    snapshot_to_bronze(src.where("false"), lake.bronze, "products", "20010731", "20010731000000")
    run_silver_stream(
        spark, PRODUCTS, lake.bronze, lake.silver_of("products"), lake.control_of("products"), f"{lake.checkpoints}/products", STREAM_BASE_TS_PROC
    )
    return read_control(spark, lake.control_of("products"))


def _two_product_loads(spark, sf_dir, purpose):
    lake = Lake(spark, purpose)
    src = _products_source(spark, sf_dir)
    _load(spark, lake, PRODUCTS, src, "20010730", "20010730000000", "20010731120000")
    _load(spark, lake, PRODUCTS, src, "20010731", "20010731000000", "20010731110000")
    return read_silver(spark, lake.silver_of("products"), PRODUCTS), read_control(spark, lake.control_of("products"))


def q_silver_latest_of_loads(spark, sf_dir):
    return latest.latest_batch_of_loads(*_two_product_loads(spark, sf_dir, "latest-loads"), latest.FILE_FIRST)


def q_silver_latest_of_loads_proc_first(spark, sf_dir):
    return latest.latest_batch_of_loads(*_two_product_loads(spark, sf_dir, "latest-loads-proc"), latest.PROC_FIRST)


def q_stream_silver(spark, sf_dir):
    lake = Lake(spark, "stream")
    src = _products_source(spark, sf_dir)
    snapshot_to_bronze(src, lake.bronze, "products", "20010730", "20010730000000")
    snapshot_to_bronze(src, lake.bronze, "products", "20010731", "20010731000000")
    run_silver_stream(
        spark,
        PRODUCTS,
        lake.bronze,
        lake.silver_of("products"),
        lake.control_of("products"),
        f"{lake.checkpoints}/products",
        STREAM_BASE_TS_PROC,
    )
    return read_silver(spark, lake.silver_of("products"), PRODUCTS)


def q_arrival_gate_stream(spark, sf_dir):
    # arrivals in several micro-batches, a replayed load between them: two firings
    lake = Lake(spark, "arrivals")
    dirs = {s: lake.control_of(s) for s in SUBJECT_NAMES}
    take_in = partial(run_gate, spark, dirs, f"{lake.checkpoints}/gate", f"{lake.gold}/_firings")
    products = _products_source(spark, sf_dir)
    take_in()
    _load(spark, lake, USERS, _users_source(spark, sf_dir), td.USERS_REF, td.USERS_TSF, td.USERS_TS_PROC)
    take_in()
    first = snapshot_to_bronze(products, lake.bronze, "products", td.PRODUCTS_REF, td.PRODUCTS_TSF)
    load = partial(load_subject, spark, PRODUCTS, lake.bronze, lake.silver_of("products"), lake.control_of("products"))
    load(td.PRODUCTS_TS_PROC, first)
    take_in()
    load(td.PRODUCTS_TS_PROC, first)  # once more: no arrival
    _load(spark, lake, SALES, _sales_source(spark, sf_dir), SALES_REF, SALES_TSF, SALES_TS_PROC)
    take_in()
    take_in()
    _load(spark, lake, PRODUCTS, products, "20010801", "20010801000000", "20010802000000")
    take_in()
    _load(spark, lake, USERS, _users_source(spark, sf_dir), "20010801", "20010801000000", "20010802010000")
    _load(spark, lake, SALES, _sales_source(spark, sf_dir), "20010801", "20010801230000", "20010802020000")
    take_in()
    return firings(spark, f"{lake.gold}/_firings").select("firing", "assunto", "ts_proc", "ts_file_generation", "qtd_registros")


def q_silver_recovered(spark, sf_dir):
    # a load of the newest batch that died after half its files, and one that never committed at all
    lake = Lake(spark, "recovered")
    src = _products_source(spark, sf_dir)
    for day in ("30", "31"):
        _load(spark, lake, PRODUCTS, src, f"200107{day}", f"200107{day}000000", f"200107{day}120000")
    half = src.where("product_id % 2 = 0").select(*[F.col(c).cast("string") for c in PRODUCTS.columns.fieldNames()])
    for stamps in (("20010731", "20010731120000", "20010731000000"), ("20010801", "20010801120000", "20010801000000")):
        dead = commits.begin(spark, lake.silver_of("products"), **dict(zip(commits.KEYS, stamps)))
        half.write.parquet(dead.path)
    return read_latest_load(spark, lake.silver_of("products"), PRODUCTS, latest.FILE_FIRST)


def q_silver_rejects(spark, sf_dir):
    # amounts and dates that their columns can't hold, by a rule on the line: loaded and rejected rows together
    lake = Lake(spark, "rejects")
    line = td.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_shipdate")
    amount = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    key = F.col("l_orderkey") + F.col("l_linenumber")
    src = line.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("transaction_id"),
        F.col("l_orderkey").cast("string").alias("user_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.when(key % 11 == 0, "no date").otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("dat_creation"),
        F.when(key % 7 == 0, "x").when(key % 7 == 1, F.concat(amount, F.lit("5"))).when(key % 7 == 2, None).otherwise(amount).alias("amount"),
        F.lit("PIX").alias("payment_method"),
    )
    _load(spark, lake, SALES, src, SALES_REF, SALES_TSF, SALES_TS_PROC)
    good = read_silver(spark, lake.silver_of("sales"), SALES).select(
        "transaction_id", F.col("dat_creation").cast("string").alias("dat_creation"), F.col("amount").cast("string").alias("amount"), F.lit("").alias("faults")
    )
    bad = read_rejects(spark, lake.silver_of("sales"), SALES).select("transaction_id", "dat_creation", "amount", F.array_join("faults", ",").alias("faults"))
    report = read_load_report(spark, lake.control_of("sales")).select(
        F.lit("control").alias("transaction_id"),
        F.concat_ws(":", F.lit("date"), F.col("faults")["dat_creation"]).alias("dat_creation"),
        F.concat_ws(":", F.lit("amount"), F.col("faults")["amount"]).alias("amount"),
        F.concat_ws(":", "qtd_registros", "rejected").alias("faults"),
    )
    return good.unionByName(bad).unionByName(report)


def q_bronze_nulls(spark, sf_dir):
    # NULL, empty text and rows of nothing but NULL come back; a one-column table too
    lake = Lake(spark, "bronze-nulls")
    key = F.col("p_partkey")
    part = td.table(spark, sf_dir, "part").select(
        F.when(key % 5 == 0, None).otherwise(key).alias("id"),
        F.when(key % 5 == 0, None).when(key % 3 == 0, "").when(key % 3 == 1, F.concat(F.lit('"'), "p_name", F.lit('", \n'))).otherwise(F.col("p_name")).alias("name"),
    )
    wide = read_bronze(spark, snapshot_to_bronze(part, lake.bronze, "parts", "20010731", "20010731000000"), with_lineage=False)
    one = read_bronze(spark, snapshot_to_bronze(part.select("name"), lake.bronze, "names", "20010731", "20010731000000"), with_lineage=False)
    return wide.select("id", "name", F.lit(2).alias("columns")).unionByName(one.select(F.lit(None).cast("string").alias("id"), "name", F.lit(1).alias("columns")))


def q_stream_external(spark, sf_dir):
    # a file put by another program and a committed folder; the file is committed later on as well
    lake = Lake(spark, "stream-external")
    src = _products_source(spark, sf_dir)
    stream = partial(
        run_silver_stream, spark, PRODUCTS, lake.bronze, lake.silver_of("products"), lake.control_of("products"), f"{lake.checkpoints}/products"
    )
    stream("20010801030000")  # nothing there yet
    td.put_file(src, bronze_snapshot_path(lake.bronze, "products", "20010730", "20010730000000"))
    stream("20010801040000")
    commit_snapshot(spark, lake.bronze, "products", bronze_snapshot_path(lake.bronze, "products", "20010730", "20010730000000"))
    snapshot_to_bronze(src, lake.bronze, "products", "20010731", "20010731000000")
    stream("20010801050000")
    silver = read_silver(spark, lake.silver_of("products"), PRODUCTS)
    return silver.select("ref", "ts_file_generation", "product_id", "product_des", "product_category")


BOOK_DATES = ("2000-06-30", "2001-01-31", "2001-07-31")


def q_feature_books_by_date(spark, sf_dir):
    # what books built on these dates could know
    return feature_books(_enriched(spark, sf_dir), td.testdata_spec(), BOOK_DATES, td.BOOK_TS_PROC)


def q_feature_books_all_rows(spark, sf_dir):
    # the books of the same dates over all rows: later sales are recent
    return feature_books(_enriched(spark, sf_dir), td.testdata_spec(), BOOK_DATES, td.BOOK_TS_PROC, past_only=False)


def _product_snapshots(spark, sf_dir, lake):
    """Three product loads: all; some gone and some renamed; some back, some new."""
    src = _products_source(spark, sf_dir)
    key = F.col("product_id")
    second = src.where(key % 13 != 0).withColumn("product_des", F.when(key % 7 == 0, F.concat("product_des", F.lit(" 2"))).otherwise(F.col("product_des")))
    third = second.where(key % 11 != 0).unionByName(src.where(key % 26 == 0)).unionByName(src.where(key % 17 == 0).withColumn("product_id", -key - 1))
    for day, rows in (("29", src), ("30", second), ("31", third)):
        _load(spark, lake, PRODUCTS, rows, f"200107{day}", f"200107{day}000000", f"200107{day}120000")
    return read_silver(spark, lake.silver_of("products"), PRODUCTS)


def q_snapshot_changes(spark, sf_dir):
    lake = Lake(spark, "changes")
    silver = _product_snapshots(spark, sf_dir, lake)
    old, new = (silver.where(F.col("ref") == f"200107{day}") for day in ("30", "31"))
    return snapshot_changes(old, new, ["product_id"], ["product_des", "product_category"])


def q_silver_history(spark, sf_dir):
    lake = Lake(spark, "history")
    silver = _product_snapshots(spark, sf_dir, lake)
    return key_history(silver, ["product_id"], ["ts_file_generation"], ["product_des", "product_category"])


def q_batch_profile(spark, sf_dir):
    # the exact fields, per batch of sales
    found = profile(td.sales(spark, sf_dir), ["ts_proc"], ["transaction_id", "user_id", "product_id", "dat_creation", "amount", "payment_method"])
    return found.select("ts_proc", "column", "rows", "nulls", "least", "greatest")


def q_extract_splits(spark, sf_dir):
    # rows of the table per planned read, by user (skewed: every third row moved into a narrow range)
    user = F.when(F.col("l_linenumber") % 3 == 0, F.col("l_orderkey") % 50).otherwise(F.col("l_orderkey"))
    rows = td.table(spark, sf_dir, "lineitem").select(user.alias("user_id")).unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS user_id"))
    predicates = split_predicates(rows, "user_id", 8)
    met = F.array_compact(F.array(*[F.when(F.expr(p), F.lit(i)) for i, p in enumerate(predicates)]))
    per_read = rows.select(F.size(met).alias("reads"), F.get(met, F.lit(0)).alias("read")).groupBy("reads", "read").agg(F.count("*").alias("n"))
    ranged = per_read.where(f"read < {len(predicates) - 1}")
    even = ranged.agg((F.max("n") <= 1.5 * F.avg("n")).alias("even")).select("even")
    return per_read.agg(F.sum("n").alias("rows"), F.max("reads").alias("most_reads"), F.min("reads").alias("least_reads")).join(F.broadcast(even))


QUERIES: dict[str, Query] = {
    "feature_book": q_feature_book,
    "feature_book_one_stage": q_feature_book_one_stage,
    "feature_book_shuffle_join": q_feature_book_shuffle_join,
    "feature_book_literal": q_feature_book_literal,
    "feature_book_lookback": q_feature_book_lookback,
    "feature_book_totals": q_feature_book_totals,
    "feature_book_windows": q_feature_book_windows,
    "month_age": q_month_age,
    "recency_flags": q_recency_flags,
    **{f"book_{s}_{d}": _family(s, d) for d in ("pcat", "pm") for s in ("qtd", "sum", "avg", "min", "max")},
    "category_enrichment": q_category_enrichment,
    "category_enrichment_shuffle": q_category_enrichment_shuffle,
    "batch_histogram": q_batch_histogram,
    "latest_batch_proc_first": q_latest_batch_proc_first,
    "latest_batch_file_first": q_latest_batch_file_first,
    "latest_batch_by_key": q_latest_batch_by_key,
    "lookback_filter": q_lookback_filter,
    "bronze_roundtrip": q_bronze_roundtrip,
    "silver_products": q_silver_products,
    "silver_sales": q_silver_sales,
    "latest_file": q_latest_file,
    "lineage_columns": q_lineage_columns,
    "control_rows": q_control_rows,
    "readiness": q_readiness,
    "silver_latest_batch": q_silver_latest_batch,
    "gold_roundtrip": q_gold_roundtrip,
    "gold_from_silver": q_gold_from_silver,
    "gold_job": q_gold_job,
    "stream_silver": q_stream_silver,
    "recency_flags_long": q_recency_flags_long,
    "feature_book_sale_date": q_feature_book_sale_date,
    "gold_job_sale_date": q_gold_job_sale_date,
    "silver_two_snapshots_one_stamp": q_silver_two_snapshots_one_stamp,
    "control_rerun": q_control_rerun,
    "readiness_ready": q_readiness_ready,
    "latest_file_committed": q_latest_file_committed,
    "stream_control": q_stream_control,
    "silver_latest_of_loads": q_silver_latest_of_loads,
    "silver_latest_of_loads_proc_first": q_silver_latest_of_loads_proc_first,
    "arrival_gate_stream": q_arrival_gate_stream,
    "silver_recovered": q_silver_recovered,
    "silver_rejects": q_silver_rejects,
    "bronze_nulls": q_bronze_nulls,
    "stream_external": q_stream_external,
    "feature_books_by_date": q_feature_books_by_date,
    "feature_books_all_rows": q_feature_books_all_rows,
    "snapshot_changes": q_snapshot_changes,
    "silver_history": q_silver_history,
    "batch_profile": q_batch_profile,
    "extract_splits": q_extract_splits,
}
