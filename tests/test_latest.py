"""Latest-batch selection (proc-first vs file-first) and its pruning plan."""

from conftest import plan_text
from pyspark.sql import functions as F

from tierbook.operators import latest
from tierbook.operators.lookback import lookback_filter
from tierbook.schemas import PRODUCTS
from tierbook.sinks.writers import write_silver
from tierbook.sources.lake import read_silver

SCHEMA = "id string, ref string, ts_file_generation string, ts_proc string"
ROWS = [
    # batch A: processed last, from an older file
    ("a1", "20240930", "20240930080000", "20241001120000"),
    ("a2", "20240929", "20240930080000", "20241001120000"),  # same batch, other ref: kept
    # batch B: newest file, processed earlier
    ("b1", "20240930", "20240930230000", "20241001090000"),
    # NULL stamp never wins
    ("n1", "20240930", None, "20241002000000"),
]


def _ids(df):
    return sorted(r["id"] for r in df.collect())


def test_proc_first_and_file_first_disagree(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert _ids(latest.latest_batch(df, latest.PROC_FIRST)) == ["a1", "a2"]
    assert _ids(latest.latest_batch(df, latest.FILE_FIRST)) == ["b1"]


def test_pruned_equals_concatenated_key(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    for order in (latest.PROC_FIRST, latest.FILE_FIRST):
        assert _ids(latest.latest_batch(df, order)) == _ids(latest.latest_batch_by_key(df, order))


def test_newest_stamp_without_complete_key_falls_back(spark):
    # n1 has the newest ts_proc but no file stamp: the concatenated key of
    # that batch is NULL, so the newest complete batch (a1, a2) wins.
    rows = ROWS + [("n2", "20240930", None, "20241003000000")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert _ids(latest.latest_batch(df, latest.PROC_FIRST)) == ["a1", "a2"]
    assert _ids(latest.latest_batch_by_key(df, latest.PROC_FIRST)) == ["a1", "a2"]


def test_histogram(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    hist = {r["dedup_key"]: r["n_rows"] for r in latest.batch_histogram(df).collect()}
    assert hist == {"2024100112000020240930080000": 2, "2024100109000020240930230000": 1, None: 1}


def test_latest_batch_prunes_silver_partitions(spark, lake):
    rows = [("p1", "d", "c", "20240930", "20240930000000", "20241001090000"), ("p2", "d", "c", "20240930", "20240930000000", "20241001120000")]
    df = spark.createDataFrame(rows, "product_id string, product_des string, product_category string, ref string, ts_file_generation string, ts_proc string")
    for ref, tsf, ts in [r[3:] for r in rows]:
        write_silver(df.where(F.col("ts_proc") == ts), lake.silver_of("products"), ref, ts, tsf)
    silver = read_silver(spark, lake.silver_of("products"), PRODUCTS)
    out = latest.latest_batch(silver, latest.PROC_FIRST)
    assert [r["product_id"] for r in out.collect()] == ["p2"]
    plan = plan_text(out)
    # Both stamps are partition columns: older batches are pruned statically.
    assert any("PartitionFilters:" in l and "(ts_proc#" in l and "= 20241001120000)" in l for l in plan.splitlines())
    assert any("PartitionFilters:" in l and "= 20240930000000)" in l for l in plan.splitlines())


def test_lookback_prunes_ref_partitions(spark, lake):
    rows = [("p1", "d", "c", "20220101", "20220101000000", "20220101000000"), ("p2", "d", "c", "20240930", "20240930000000", "20240930000000")]
    df = spark.createDataFrame(rows, "product_id string, product_des string, product_category string, ref string, ts_file_generation string, ts_proc string")
    for ref, tsf, ts in [r[3:] for r in rows]:
        write_silver(df.where(F.col("ts_proc") == ts), lake.silver_of("products"), ref, ts, tsf)
    silver = read_silver(spark, lake.silver_of("products"), PRODUCTS)
    out = lookback_filter(silver, "20230901")
    assert [r["product_id"] for r in out.collect()] == ["p2"]
    plan = plan_text(out)
    assert any("PartitionFilters:" in l and ">= 20230901" in l for l in plan.splitlines())
    assert lookback_filter(silver, None) is silver
