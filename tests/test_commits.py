"""Loads become visible as a whole: interrupted, repeated, empty and replaced ones."""

import os
import time

import pytest
from pyspark.sql import types as T

from tierbook.operators.latest import FILE_FIRST, PROC_FIRST
from tierbook.operators.quality import LostRows
from tierbook.plans.bronze import snapshot_to_bronze
from tierbook.plans.silver import load_subject
from tierbook.schemas import PRODUCTS
from tierbook.sinks import commits
from tierbook.sources.files import Log, latest_snapshot, read_manifest
from tierbook.sources.lake import read_control, read_latest_load, read_load_report, read_silver
from tierbook.sources.storage import list_folder

STAMPS = ("20240930", "20241001080000", "20240930120000")


def _source(spark, n, tag="a"):
    return spark.range(n).selectExpr("cast(id as string) product_id", f"'{tag}' product_des", "'Livros' product_category")


def _load(spark, lake, n, ts_proc=STAMPS[1], day=30, path=None):
    path = path or snapshot_to_bronze(_source(spark, n), lake.bronze, "products", f"202409{day}", f"202409{day}120000")
    return load_subject(spark, PRODUCTS, lake.bronze, lake.silver_of("products"), lake.control_of("products"), ts_proc, path)


def _silver(spark, lake):
    return read_silver(spark, lake.silver_of("products"), PRODUCTS)


def test_a_dead_load_changes_nothing(spark, lake):
    _load(spark, lake, 8)
    dead = commits.begin(spark, lake.silver_of("products"), **dict(zip(commits.KEYS, STAMPS)))
    _source(spark, 3).write.parquet(dead.path)
    newer = commits.begin(spark, lake.silver_of("products"), ref="20241001", ts_proc="20241002080000", ts_file_generation="20241001120000")
    _source(spark, 5).write.parquet(newer.path)
    assert _silver(spark, lake).count() == 8
    for order in (PROC_FIRST, FILE_FIRST):
        assert read_latest_load(spark, lake.silver_of("products"), PRODUCTS, order).count() == 8
    commits.commit(spark, newer, 5)
    assert _silver(spark, lake).count() == 13
    assert {r.ref for r in read_latest_load(spark, lake.silver_of("products"), PRODUCTS).collect()} == {"20241001"}


def test_a_first_load_that_died_is_not_read(spark, lake):
    dead = commits.begin(spark, lake.silver_of("products"), **dict(zip(commits.KEYS, STAMPS)))
    _source(spark, 3).write.parquet(dead.path)
    assert _silver(spark, lake).count() == 0
    assert read_latest_load(spark, lake.silver_of("products"), PRODUCTS).count() == 0


def test_vacuum_removes_what_no_commit_names(spark, lake):
    root = lake.silver_of("products")
    path = _load(spark, lake, 8).snapshot_path
    _load(spark, lake, 8, path=path)  # replaces the first
    dead = commits.begin(spark, root, **dict(zip(commits.KEYS, STAMPS)))
    _source(spark, 3).write.parquet(dead.path)
    assert commits.vacuum(spark, root, older_than_ms=0) == []
    later = int(time.time() * 1000) + 60_000
    gone = commits.vacuum(spark, root, later)
    assert len(gone) == 2 and dead.folder in gone
    assert commits.vacuum(spark, root, later) == [] and _silver(spark, lake).count() == 8


def test_control_row_of_a_load_that_died_after_its_commit(spark, lake):
    _load(spark, lake, 8)
    load = commits.begin(spark, lake.silver_of("products"), ref="20241001", ts_proc="20241002080000", ts_file_generation="20241001120000")
    _source(spark, 5).write.parquet(load.path)
    commits.commit(spark, load, 5)  # and no control row
    _load(spark, lake, 2, "20241003080000", 29)
    rows = {r.ref: r.qtd_registros for r in read_control(spark, lake.control_of("products")).collect()}
    assert rows == {"20240930": 8, "20241001": 5, "20240929": 2}
    assert {r.version for r in read_load_report(spark, lake.control_of("products")).collect()} == {1, 2, 3}


def test_lost_bronze_rows_fail_the_load(spark, lake):
    path = _load(spark, lake, 8).snapshot_path
    _source(spark, 5).write.mode("overwrite").option("header", "true").csv(path)  # files changed behind the manifest
    with pytest.raises(LostRows):
        _load(spark, lake, 8, path=path)
    assert _silver(spark, lake).count() == 8


def test_lost_silver_rows_fail_the_book(spark, lake):
    _load(spark, lake, 8)
    folder = commits.live_loads(spark, lake.silver_of("products")).first()["folder"]
    _source(spark, 5).write.mode("overwrite").parquet(f"{lake.silver_of('products')}/{folder}")
    with pytest.raises(LostRows):
        read_latest_load(spark, lake.silver_of("products"), PRODUCTS)


def test_empty_gold_rerun_shows_an_empty_book(spark, lake):
    from tierbook.operators.book import REFERENCE_SPEC
    from tierbook.plans.gold import gold_job, last_book_stamp
    from tierbook.schemas import SALES
    from tierbook.sources.lake import read_gold

    _load(spark, lake, 8)
    src = spark.createDataFrame([("t1", "u1", "1", "2024-09-01", "9.50", "PIX")], ",".join(f"{c} string" for c in SALES.columns.fieldNames()))
    path = snapshot_to_bronze(src, lake.bronze, "sales", "20240930", "20240930120000")
    load_subject(spark, SALES, lake.bronze, lake.silver_of("sales"), lake.control_of("sales"), "20241001080000", path)
    job = (spark, lake.silver_of("sales"), lake.silver_of("products"), lake.gold, REFERENCE_SPEC, "2024-09-30", "20241001090000")
    assert last_book_stamp(spark, lake.gold) is None
    gold_job(*job)
    assert read_gold(spark, lake.gold, REFERENCE_SPEC).count() == 1
    load = commits.begin(spark, lake.silver_of("sales"), ref="20240930", ts_proc="20241001080000", ts_file_generation="20240930120000")
    spark.createDataFrame([], SALES.stored_schema).drop(*commits.KEYS).write.parquet(load.path)
    commits.commit(spark, load, 0)
    gold_job(*job)
    assert read_gold(spark, lake.gold, REFERENCE_SPEC).count() == 0
    assert last_book_stamp(spark, lake.gold) == "20241001090000"


def test_latest_load_opens_one_folder(spark, lake):
    for day, stamp in ((28, "20241001090000"), (29, "20241001070000"), (30, "20241001080000")):
        _load(spark, lake, day, stamp, day)
    for order, n in ((PROC_FIRST, 28), (FILE_FIRST, 30)):
        found = read_latest_load(spark, lake.silver_of("products"), PRODUCTS, order)
        folders = {os.path.dirname(f) for f in found.inputFiles()}
        assert len(folders) == 1 and found.count() == n
    assert read_latest_load(spark, lake.silver_of("products"), PRODUCTS, PROC_FIRST, "20240929").count() == 30


def test_table_of_another_program_is_read_as_it_lies(spark, lake):
    rows = spark.createDataFrame([("20240930", "20241001080000", "20240930120000", "1", "a", "Livros")], ",".join(f"{c} string" for c in PRODUCTS.silver_schema.fieldNames()))
    rows.write.partitionBy("ref", "ts_proc").parquet(lake.silver_of("products"))
    assert [tuple(r) for r in _silver(spark, lake).collect()] == [tuple(r) for r in rows.collect()]
    assert read_latest_load(spark, lake.silver_of("products"), PRODUCTS).count() == 1


def test_log_folds_its_entries(spark, lake, monkeypatch):
    from tierbook.sources import log

    monkeypatch.setattr(log, "FOLD_AFTER", 3)
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("m", T.MapType(T.StringType(), T.LongType()))])
    table = Log(spark, f"{lake.control}/log", schema)
    assert table.rows().count() == 0 and not table.exists()
    most = 0
    for i in range(11):
        assert table.append({"name": f"n{i}", "m": {"x": i}}) == i + 1
        most = max(most, sum(len(list_folder(spark, f"{table.path}/{k}")) for k in ("entries", "base")))
    assert most <= 5
    assert sorted((r.version, r.name, r.m["x"]) for r in table.rows().collect()) == [(i + 1, f"n{i}", i) for i in range(11)]
    # a fold that died after writing its file: every row still counts once
    table._write("base", table._versions("entries")[-1], table.rows(), "overwrite")
    assert table.rows().count() == 11


def test_discovery_does_not_list_part_files(spark, lake, monkeypatch):
    """What is listed and opened to find the newest snapshot, with few and with many part files and manifest rows."""
    from tierbook.sources import files, log

    monkeypatch.setattr(log, "FOLD_AFTER", 4)
    listed = []
    for module in (files, log):
        real = module.list_folder
        monkeypatch.setattr(module, "list_folder", lambda *a, real=real: listed.extend(found := real(*a)) or found)
    sizes = []
    for i, parts in enumerate((1, 12, 1, 12, 1, 12, 1, 12)):
        snapshot_to_bronze(_source(spark, 24).repartition(parts), lake.bronze, "products", "20240930", f"202409301200{i:02d}")
        listed.clear()
        assert latest_snapshot(spark, f"{lake.bronze}/products", "products").endswith(f"{i:02d}.csv")
        sizes.append(len(listed))
        assert len(read_manifest(spark, f"{lake.bronze}/products").inputFiles()) <= 5
    assert max(sizes) <= 8 + 1 + 2 * 5  # a name per snapshot, the manifest, its files
