"""Bronze -> silver -> control round trips and their edge cases."""

import time

import pytest
from pyspark.sql import types as T

from tierbook.operators.control import readiness
from tierbook.plans.bronze import snapshot_to_bronze
from tierbook.plans.silver import load_subject
from tierbook.schemas import PRODUCTS, SALES, SubjectSpec
from tierbook.sinks.writers import commit_snapshot
from tierbook.sources.files import NoSnapshotError, latest_snapshot, list_snapshots, read_bronze
from tierbook.sources.lake import read_control, read_silver

PRODUCT_ROWS = [
    ("1", 'a "quoted", value', "Livros"),
    ("2", "first line\nsecond line", "Roupas"),
    ("3", "", "Jogos"),
    ("4", None, "Outros"),
]


def _products(spark, rows=PRODUCT_ROWS):
    return spark.createDataFrame(rows, "product_id string, product_des string, product_category string").repartition(2)


def test_csv_fidelity_quotes_newlines_empty_and_null(spark, lake):
    path = snapshot_to_bronze(_products(spark), lake.bronze, "products", "20240930", "20240930120000")
    back = read_bronze(spark, path, with_lineage=False)
    # Quotes, commas, newlines, empty text and NULL all come back as they were.
    assert sorted(map(tuple, back.collect()), key=lambda r: r[0]) == PRODUCT_ROWS


def test_silver_load_types_lineage_and_control(spark, lake):
    snapshot_to_bronze(_products(spark), lake.bronze, "products", "20240930", "20240930120000")
    res = load_subject(spark, PRODUCTS, lake.bronze, lake.silver_of("products"), lake.control_of("products"), "20241001080000")
    assert (res.ref, res.ts_file_generation, res.rows) == ("20240930", "20240930120000", 4)
    silver = read_silver(spark, lake.silver_of("products"), PRODUCTS)
    assert silver.columns == ["ref", "ts_file_generation", "ts_proc", "product_id", "product_des", "product_category"]
    assert all(f.dataType == T.StringType() for f in silver.schema.fields)
    assert {(r.ref, r.ts_file_generation, r.ts_proc) for r in silver.collect()} == {
        ("20240930", "20240930120000", "20241001080000")
    }
    ctl = read_control(spark, lake.control_of("products")).collect()
    assert [tuple(r) for r in ctl] == [("products", "20240930", "20240930120000", "20241001080000", 4)]


def test_rerun_same_stamp_is_idempotent(spark, lake):
    path = snapshot_to_bronze(_products(spark), lake.bronze, "products", "20240930", "20240930120000")
    for _ in range(2):
        load_subject(spark, PRODUCTS, lake.bronze, lake.silver_of("products"), lake.control_of("products"), "20241001080000", path)
    assert read_silver(spark, lake.silver_of("products"), PRODUCTS).count() == 4


def test_empty_snapshot_gives_zero_control_row(spark, lake):
    empty = spark.createDataFrame([], "product_id string, product_des string, product_category string")
    snapshot_to_bronze(empty, lake.bronze, "products", "20240930", "20240930120000")
    res = load_subject(spark, PRODUCTS, lake.bronze, lake.silver_of("products"), lake.control_of("products"), "20241001080000")
    assert res.rows == 0
    assert read_control(spark, lake.control_of("products")).first()["qtd_registros"] == 0


SALES_ROWS = [
    ("t1", "u1", "p1", "2024-09-01", "9.50", "PIX"),
    ("t2", "u1", "p1", "not a date", "abc", "PIX"),
    ("t3", "u2", "p1", "2024-09-02", "12.345", "PIX"),
    ("t4", "u2", None, None, None, None),
    ("t5", "u2", "p1", "2024-09-03", "7.100", ""),
]


def _load_sales(spark, lake, **options):
    src = spark.createDataFrame(SALES_ROWS, ",".join(f"{c} string" for c in SALES.columns.fieldNames()))
    snapshot_to_bronze(src, lake.bronze, "sales", "20240930", "20240930120000")
    return load_subject(spark, SALES, lake.bronze, lake.silver_of("sales"), lake.control_of("sales"), "20241001080000", **options)


def test_typed_silver_uses_try_cast(spark, lake):
    res = _load_sales(spark, lake, keep_misfits=True)
    assert (res.rows, res.rejected, res.faults) == (5, 0, {"dat_creation": 1, "amount": 2})
    got = {r.transaction_id: r for r in read_silver(spark, lake.silver_of("sales"), SALES).collect()}
    assert str(got["t1"].amount) == "9.50" and str(got["t1"].dat_creation) == "2024-09-01"
    assert got["t2"].amount is None and got["t2"].dat_creation is None
    assert got["t5"].payment_method == "" and got["t4"].payment_method is None


def test_rejected_rows_are_kept_and_counted(spark, lake):
    from tierbook.sources.lake import read_load_report, read_rejects

    res = _load_sales(spark, lake)
    assert (res.rows, res.rejected, res.faults) == (3, 2, {"dat_creation": 1, "amount": 2})
    got = {r.transaction_id: str(r.amount) for r in read_silver(spark, lake.silver_of("sales"), SALES).collect()}
    assert got == {"t1": "9.50", "t4": "None", "t5": "7.10"}
    bad = {r.transaction_id: r for r in read_rejects(spark, lake.silver_of("sales"), SALES).collect()}
    assert (bad["t2"].faults, bad["t2"].amount, bad["t2"].dat_creation) == (["dat_creation", "amount"], "abc", "not a date")
    assert (bad["t3"].faults, bad["t3"].amount, bad["t3"].ref) == (["amount"], "12.345", "20240930")
    report = read_load_report(spark, lake.control_of("sales")).first()
    assert (report.qtd_registros, report.rejected, report.faults) == (3, 2, {"dat_creation": 1, "amount": 2})
    assert read_control(spark, lake.control_of("sales")).columns == ["assunto", "ref", "ts_file_generation", "ts_proc", "qtd_registros"]


def test_too_many_rejects_fail_the_load(spark, lake):
    from tierbook.operators.quality import TooManyRejects

    with pytest.raises(TooManyRejects):
        _load_sales(spark, lake, max_rejected=0.3)
    assert read_silver(spark, lake.silver_of("sales"), SALES).count() == 0
    assert read_control(spark, lake.control_of("sales"), missing_ok=True).count() == 0


def test_subject_with_underscore(spark, lake):
    spec = SubjectSpec("order_items", T.StructType([T.StructField("item", T.StringType())]))
    src = spark.createDataFrame([("x",)], "item string")
    snapshot_to_bronze(src, lake.bronze, "order_items", "20240930", "20240930120000")
    # a different subject sharing the prefix must not be picked up
    snapshot_to_bronze(src, lake.bronze, "order", "20241231", "20241231120000")
    res = load_subject(spark, spec, lake.bronze, lake.silver_of("order_items"), lake.control_of("order_items"), "20241001080000")
    assert (res.ref, res.ts_file_generation) == ("20240930", "20240930120000")


def test_latest_file_is_by_modification_time(spark, lake):
    src = _products(spark)
    snapshot_to_bronze(src, lake.bronze, "products", "20240930", "20240930120000")
    time.sleep(1.1)
    later = snapshot_to_bronze(src, lake.bronze, "products", "20240929", "20240929120000")  # older stamp, written last
    assert latest_snapshot(spark, f"{lake.bronze}/products", "products").endswith(later.split("/", 3)[-1])
    assert list_snapshots(spark, f"{lake.bronze}/products", "products").count() == 2


def test_no_snapshot_is_an_explicit_error(spark, lake):
    snapshot_to_bronze(_products(spark), lake.bronze, "users", "20240930", "20240930120000")
    with pytest.raises(NoSnapshotError):
        latest_snapshot(spark, f"{lake.bronze}/users", "products")
    with pytest.raises(NoSnapshotError):
        latest_snapshot(spark, f"{lake.bronze}/missing", "products")


def test_readiness_gate(spark):
    rows = [
        ("users", "20240930", "x", "20241001100000", 5),
        ("products", "20240930", "x", "20241001110000", 4),
        ("sales", "20240930", "x", "20240930230000", 9),
        ("sales", "20240929", "x", "20240929230000", 8),
    ]
    control = spark.createDataFrame(rows, "assunto string, ref string, ts_file_generation string, ts_proc string, qtd_registros bigint")
    subjects = ("users", "products", "sales")
    state = {r.assunto: r for r in readiness(spark, control, subjects, "20241001000000").collect()}
    assert state["users"].received and state["products"].received and not state["sales"].received
    assert state["sales"].qtd_registros == 9 and not state["sales"].ready
    state = {r.assunto: r for r in readiness(spark, control, subjects, "20240930120000").collect()}
    assert all(r.ready for r in state.values())
    missing = readiness(spark, control.where("assunto <> 'users'"), subjects, None).collect()
    assert {r.assunto: r.received for r in missing}["users"] is False


def test_quality_checks(spark):
    from tierbook.operators.enrich import category_enrichment
    from tierbook.operators.quality import DuplicateKeys, SchemaMismatch, assert_schema

    sales = spark.createDataFrame([("t1", "p2")], "transaction_id string, product_id string")
    products = spark.createDataFrame([("p2", "Livros"), ("p2", "Livros")], "product_id string, product_category string")
    assert category_enrichment(sales, products).count() == 2  # fan-out kept by default
    with pytest.raises(DuplicateKeys):
        category_enrichment(sales, products, validate_unique=True)
    with pytest.raises(SchemaMismatch):
        assert_schema(sales, T.StructType([T.StructField("transaction_id", T.StringType())]))


def test_gold_job_and_last_stamp(spark, lake):
    from tierbook.operators.book import REFERENCE_SPEC
    from tierbook.plans.gold import gold_job, last_book_stamp

    assert last_book_stamp(spark, lake.gold) is None
    snapshot_to_bronze(_products(spark), lake.bronze, "products", "20240930", "20240930120000")
    sales = spark.createDataFrame(
        [("t1", "u1", "1", "2024-09-01", "9.50", "PIX")], ",".join(f"{c} string" for c in SALES.columns.fieldNames())
    )
    snapshot_to_bronze(sales, lake.bronze, "sales", "20240930", "20240930130000")
    for spec in (PRODUCTS, SALES):
        load_subject(spark, spec, lake.bronze, lake.silver_of(spec.name), lake.control_of(spec.name), "20241001080000")
    gold_job(spark, lake.silver_of("sales"), lake.silver_of("products"), lake.gold,
             REFERENCE_SPEC, "2024-09-30", "20241001090000")
    from tierbook.sources.lake import read_gold

    book = read_gold(spark, lake.gold, REFERENCE_SPEC).collect()
    assert len(book) == 1 and book[0].qtd_pcat_livros == 1 and book[0].qtd_pm_pix_u1m == 1
    assert last_book_stamp(spark, lake.gold) == "20241001090000"


def test_book_follows_the_newest_batch_and_reruns_are_idempotent(spark, lake):
    from tierbook.operators.book import REFERENCE_SPEC
    from tierbook.plans.gold import gold_job
    from tierbook.sources.lake import read_gold

    cols = ",".join(f"{c} string" for c in SALES.columns.fieldNames())
    snapshot_to_bronze(_products(spark), lake.bronze, "products", "20240930", "20240930120000")
    load_subject(spark, PRODUCTS, lake.bronze, lake.silver_of("products"), lake.control_of("products"), "20241001080000")

    first = spark.createDataFrame([("t1", "u1", "1", "2024-09-01", "9.50", "PIX")], cols)
    snapshot_to_bronze(first, lake.bronze, "sales", "20240930", "20240930130000")
    load_subject(spark, SALES, lake.bronze, lake.silver_of("sales"), lake.control_of("sales"), "20241001080000")
    args = (lake.silver_of("sales"), lake.silver_of("products"), lake.gold, REFERENCE_SPEC)
    gold_job(spark, *args, "2024-09-30", "20241001090000")

    second = spark.createDataFrame(
        [("t2", "u1", "1", "2024-09-20", "5.00", "Boleto"), ("t3", "u2", "3", "2024-09-20", "1.00", "PIX")], cols
    )
    snapshot_to_bronze(second, lake.bronze, "sales", "20241001", "20241001130000")
    load_subject(spark, SALES, lake.bronze, lake.silver_of("sales"), lake.control_of("sales"), "20241002080000")
    for _ in range(2):  # same stamp twice: the partition is replaced, not duplicated
        gold_job(spark, *args, "2024-10-01", "20241002090000")

    gold = read_gold(spark, lake.gold, REFERENCE_SPEC)
    assert gold.where("ts_proc = '20241001090000'").count() == 1
    latest = {r.user_id: r for r in gold.where("ts_proc = '20241002090000'").collect()}
    assert set(latest) == {"u1", "u2"}
    assert latest["u1"].qtd_pm_boleto == 1 and latest["u1"].qtd_pm_pix is None  # only the newest sales batch


def test_bronze_files_are_capped_for_parallel_reads(spark, lake):
    import glob

    from tierbook.sinks.writers import write_bronze_snapshot

    src = spark.range(10).selectExpr("cast(id as string) as product_id", "'d' as product_des", "'c' as product_category").coalesce(1)
    path = write_bronze_snapshot(src, lake.bronze, "products", "20240930", "20240930120000", max_records_per_file=3)
    local = path.replace("file:", "")
    assert len(glob.glob(f"{local}/part-*.csv")) == 4
    assert read_bronze(spark, path).count() == 10


def test_extra_columns_dropped_missing_column_fails(spark, lake):
    from pyspark.errors import AnalysisException

    extra = spark.createDataFrame([("1", "a", "Livros", "x")], "product_id string, product_des string, product_category string, note string")
    snapshot_to_bronze(extra, lake.bronze, "products", "20240930", "20240930120000")
    load_subject(spark, PRODUCTS, lake.bronze, lake.silver_of("products"), lake.control_of("products"), "20241001080000")
    assert "note" not in read_silver(spark, lake.silver_of("products"), PRODUCTS).columns

    missing = spark.createDataFrame([("1", "a")], "product_id string, product_des string")
    snapshot_to_bronze(missing, lake.bronze, "products", "20241001", "20241001120000")
    with pytest.raises(AnalysisException):
        load_subject(spark, PRODUCTS, lake.bronze, lake.silver_of("products"), lake.control_of("products"), "20241002080000")


def test_readiness_with_a_subject_never_loaded(spark, lake):
    from tierbook.operators.book import REFERENCE_SPEC
    from tierbook.plans.gold import gold_when_ready

    snapshot_to_bronze(_products(spark), lake.bronze, "products", "20240930", "20240930120000")
    load_subject(spark, PRODUCTS, lake.bronze, lake.silver_of("products"), lake.control_of("products"), "20241001080000")
    control = read_control(spark, lake.control_of("users"), lake.control_of("products"), missing_ok=True)
    state = {r.assunto: r for r in readiness(spark, control, ("users", "products"), None).collect()}
    assert state["products"].received and not state["users"].received and not state["users"].ready
    ran = gold_when_ready(spark, lake.silver, lake.control, lake.gold, REFERENCE_SPEC, "2024-09-30", "20241001090000")
    assert ran is False
    assert read_control(spark, lake.control_of("users"), missing_ok=True).count() == 0


def test_text_keeps_its_blanks(spark, lake):
    rows = [("1", "  padded  ", "Livros "), ("2", "tab\t", " Jogos"), ("3", "plain", "Roupas")]
    path = snapshot_to_bronze(_products(spark, rows), lake.bronze, "products", "20240930", "20240930120000")
    assert sorted(map(tuple, read_bronze(spark, path, with_lineage=False).collect())) == rows


def test_file_without_line_breaks_is_split(spark, lake):
    src = spark.range(60_000).selectExpr("cast(id as string) product_id", "repeat('x', 90) product_des", "'Livros' product_category").coalesce(1)
    path = snapshot_to_bronze(src, lake.bronze, "products", "20240930", "20240930120000")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        assert read_bronze(spark, path).rdd.getNumPartitions() > 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_unfinished_snapshot_is_not_the_latest(spark, lake):
    done = snapshot_to_bronze(_products(spark), lake.bronze, "products", "20240930", "20240930120000")
    _products(spark).write.option("header", "true").csv(f"{lake.bronze}/products/products_20241001_20241001120000.csv")
    assert latest_snapshot(spark, f"{lake.bronze}/products", "products").endswith(done.rsplit("/", 1)[1])
    # the write is taken up again under the same name
    snapshot_to_bronze(_products(spark), lake.bronze, "products", "20241001", "20241001120000")
    assert "20241001120000" in latest_snapshot(spark, f"{lake.bronze}/products", "products")
    with pytest.raises(FileExistsError):
        snapshot_to_bronze(_products(spark), lake.bronze, "products", "20241001", "20241001120000")


def test_empty_rerun_replaces_the_batch(spark, lake):
    path = snapshot_to_bronze(_products(spark), lake.bronze, "products", "20240930", "20240930120000")
    args = (spark, PRODUCTS, lake.bronze, lake.silver_of("products"), lake.control_of("products"), "20241001080000", path)
    load_subject(*args)
    _products(spark).limit(0).write.mode("overwrite").option("header", "true").csv(path)
    commit_snapshot(spark, lake.bronze, "products", path, rows=0)  # delivered anew, now without rows
    load_subject(*args)
    assert read_silver(spark, lake.silver_of("products"), PRODUCTS).count() == 0
    assert [r.qtd_registros for r in read_control(spark, lake.control_of("products")).collect()] == [0]


def test_latest_batch_of_loads_opens_no_older_batch(spark, lake):
    from conftest import plan_text
    from tierbook.operators.latest import FILE_FIRST, PROC_FIRST, latest_batch_of_loads

    for day, stamp in (("28", "20241001090000"), ("30", "20241001080000")):
        path = snapshot_to_bronze(_products(spark), lake.bronze, "products", f"202409{day}", f"202409{day}120000")
        load_subject(spark, PRODUCTS, lake.bronze, lake.silver_of("products"), lake.control_of("products"), stamp, path)
    silver = read_silver(spark, lake.silver_of("products"), PRODUCTS)
    control = read_control(spark, lake.control_of("products"))
    for order, ref in ((PROC_FIRST, "20240928"), (FILE_FIRST, "20240930")):
        found = latest_batch_of_loads(silver, control, order)
        plan = plan_text(found)
        assert "ts_file_generation" in plan.split("PartitionFilters")[1].split("]")[0]
        assert {r.ref for r in found.collect()} == {ref} and found.count() == 4
        assert len(found.inputFiles()) >= 1


def test_extract_needs_its_splits():
    from tierbook.sources.jdbc import extract_table

    with pytest.raises(ValueError):
        extract_table(None, "jdbc:none", "products")
