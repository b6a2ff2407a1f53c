"""File-triggered silver loads: once per new snapshot, nothing on rerun."""

from tierbook.plans.bronze import snapshot_to_bronze
from tierbook.schemas import PRODUCTS
from tierbook.sources.lake import read_control, read_silver
from tierbook.streaming.silver_stream import batch_ts_proc, run_silver_stream

BASE = "20241001000000"


def _run(spark, lake):
    run_silver_stream(
        spark, PRODUCTS, lake.bronze, lake.silver_of("products"), lake.control_of("products"),
        f"{lake.checkpoints}/products", BASE,
    )


def test_batch_stamp_is_fixed_width():
    assert batch_ts_proc(BASE, 0) == BASE
    assert batch_ts_proc("20241231235959", 1) == "20250101000000"


def test_stream_loads_new_files_once(spark, lake):
    src = spark.createDataFrame([("1", "a", "Livros"), ("2", "b", "Jogos")], "product_id string, product_des string, product_category string")
    snapshot_to_bronze(src, lake.bronze, "products", "20240930", "20240930120000")
    _run(spark, lake)
    silver = read_silver(spark, lake.silver_of("products"), PRODUCTS)
    assert silver.count() == 2
    assert {r.ts_proc for r in silver.collect()} == {BASE}

    _run(spark, lake)  # nothing new: nothing written
    assert read_silver(spark, lake.silver_of("products"), PRODUCTS).count() == 2
    assert read_control(spark, lake.control_of("products")).count() == 1

    snapshot_to_bronze(src, lake.bronze, "products", "20241001", "20241001120000")
    _run(spark, lake)
    silver = read_silver(spark, lake.silver_of("products"), PRODUCTS)
    assert silver.count() == 4
    ctl = {(r.ref, r.ts_proc): r.qtd_registros for r in read_control(spark, lake.control_of("products")).collect()}
    assert ctl == {("20240930", BASE): 2, ("20241001", "20241001000001"): 2}


def _committed(spark, lake, n, rows=8, day=30):
    src = spark.range(rows).selectExpr("cast(id as string) product_id", "'a' product_des", "'Livros' product_category").repartition(n)
    return snapshot_to_bronze(src, lake.bronze, "products", f"202409{day}", f"202409{day}120000")


def test_snapshot_in_progress_is_ignored_and_never_split(spark, lake):
    _committed(spark, lake, 2)
    # part files of another snapshot are there, but its manifest row isn't
    spark.range(4).selectExpr("cast(id as string) product_id", "'b' product_des", "'Jogos' product_category").write.option(
        "header", "true"
    ).csv(f"{lake.bronze}/products/products_20241001_20241001120000.csv")
    _run(spark, lake)
    silver = read_silver(spark, lake.silver_of("products"), PRODUCTS)
    assert silver.count() == 8 and {r.ref for r in silver.collect()} == {"20240930"}


def test_replay_keeps_the_first_stamp(spark, lake):
    import glob
    import os

    _committed(spark, lake, 2)
    args = (spark, PRODUCTS, lake.bronze, lake.silver_of("products"), lake.control_of("products"), f"{lake.checkpoints}/products")
    run_silver_stream(*args, BASE)
    before = sorted(map(tuple, read_silver(spark, lake.silver_of("products"), PRODUCTS).collect()))
    control = [tuple(r) for r in read_control(spark, lake.control_of("products")).collect()]
    local = lake.checkpoints.removeprefix("file:")
    last = sorted(glob.glob(f"{local}/products/commits/[0-9]*"))[-1]
    for f in (last, os.path.join(os.path.dirname(last), f".{os.path.basename(last)}.crc")):
        if os.path.exists(f):
            os.remove(f)  # as if the driver had been lost before the commit
    run_silver_stream(*args, "20241002000000")
    assert sorted(map(tuple, read_silver(spark, lake.silver_of("products"), PRODUCTS).collect())) == before
    assert [tuple(r) for r in read_control(spark, lake.control_of("products")).collect()] == control


def test_header_only_snapshot_gets_a_zero_row(spark, lake):
    _committed(spark, lake, 1, rows=0)
    _run(spark, lake)
    assert [r.qtd_registros for r in read_control(spark, lake.control_of("products")).collect()] == [0]
