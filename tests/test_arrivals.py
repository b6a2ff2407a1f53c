"""External snapshots in the stream, the arrival gate, single files read in parallel."""

import pytest

from tierbook.plans.bronze import snapshot_to_bronze
from tierbook.schemas import PRODUCTS
from tierbook.sinks.writers import bronze_snapshot_path, commit_snapshot
from tierbook.sources.files import has_line_breaks, latest_snapshot, read_bronze
from tierbook.sources.lake import read_control, read_silver
from tierbook.sources.testdata import put_file
from tierbook.streaming.arrivals import firings, run_gate
from tierbook.streaming.silver_stream import run_silver_stream


def _source(spark, n, tag="a"):
    return spark.range(n).selectExpr("cast(id as string) product_id", f"'{tag}' product_des", "'Livros' product_category")


def _run(spark, lake, base):
    run_silver_stream(
        spark, PRODUCTS, lake.bronze, lake.silver_of("products"), lake.control_of("products"), f"{lake.checkpoints}/products", base
    )


def _loads(spark, lake):
    return sorted((r.ref, r.ts_proc, r.qtd_registros) for r in read_control(spark, lake.control_of("products"), missing_ok=True).collect())


def test_single_files_trigger_the_stream(spark, lake):
    _run(spark, lake, "20241001000000")  # nothing there at all
    assert _loads(spark, lake) == []
    path = put_file(_source(spark, 4), bronze_snapshot_path(lake.bronze, "products", "20240929", "20240929120000"))
    put_file(_source(spark, 9), bronze_snapshot_path(f"{lake.bronze}", "products", "20240929", "20240929120000").replace("products_", "products_old_"))
    assert latest_snapshot(spark, f"{lake.bronze}/products", "products") == path
    _run(spark, lake, "20241001000000")
    _run(spark, lake, "20241001000000")
    assert [(r, n) for r, _, n in _loads(spark, lake)] == [("20240929", 4)]
    commit_snapshot(spark, lake.bronze, "products", path)  # seen by both streams now
    snapshot_to_bronze(_source(spark, 3), lake.bronze, "products", "20240930", "20240930120000")
    _run(spark, lake, "20241002000000")
    assert [(r, n) for r, _, n in _loads(spark, lake)] == [("20240929", 4), ("20240930", 3)]
    assert len({p for _, p, _ in _loads(spark, lake)}) == 2
    assert read_silver(spark, lake.silver_of("products"), PRODUCTS).count() == 7


def test_folded_manifest_loads_nothing_twice(spark, lake, monkeypatch):
    from tierbook.sources import log

    monkeypatch.setattr(log, "FOLD_AFTER", 2)
    for i in range(6):
        snapshot_to_bronze(_source(spark, i), lake.bronze, "products", "20240930", f"2024093012000{i}")
        if i % 2:
            _run(spark, lake, "20241001000000")
    loads = _loads(spark, lake)
    assert sorted(n for _, _, n in loads) == list(range(6))


def _control(spark, lake, subject, ts_proc, tsf="20240930120000", n=1, version=1):
    from tierbook.operators.control import control_row
    from tierbook.sinks.writers import write_control

    row = control_row(spark, subject, "20240930", tsf, ts_proc, n, version=version)
    write_control(row, lake.control_of(subject), "20240930", ts_proc, tsf)


@pytest.fixture()
def gate(spark, lake):
    told = []
    dirs = {s: lake.control_of(s) for s in ("users", "products", "sales")}

    def run(checkpoint="gate"):
        run_gate(spark, dirs, f"{lake.checkpoints}/{checkpoint}", f"{lake.gold}/_firings", lambda n, rows: told.append((n, [(r.assunto, r.ts_proc) for r in rows])))
        return told

    run.told = told
    return run


def test_gate_fires_once_per_set(spark, lake, gate):
    assert gate() == []
    _control(spark, lake, "users", "20241001010000")
    assert gate() == []
    _control(spark, lake, "products", "20241001020000")
    _control(spark, lake, "users", "20241001030000")  # again: the newest counts
    assert gate() == []
    _control(spark, lake, "sales", "20241001040000")
    first = (1, [("products", "20241001020000"), ("sales", "20241001040000"), ("users", "20241001030000")])
    assert gate() == [first] and gate() == [first]
    _control(spark, lake, "sales", "20241001040000", n=7, version=9)  # a rerun's row is no arrival
    _control(spark, lake, "products", "20241002020000")
    _control(spark, lake, "users", "20241002030000")
    assert gate() == [first]
    _control(spark, lake, "sales", "20241002040000")
    _control(spark, lake, "sales", "20241002050000")  # after the set is complete: received for the next book
    assert len(gate()) == 2
    _control(spark, lake, "users", "20241003030000")
    _control(spark, lake, "products", "20241003020000")
    assert len(gate()) == 3
    assert gate.told[2][1] == [("products", "20241003020000"), ("sales", "20241002050000"), ("users", "20241003030000")]
    assert firings(spark, f"{lake.gold}/_firings").count() == 9


def test_a_firing_that_is_seen_again_is_not_told_again(spark, lake, gate):
    for s, hour in (("users", 1), ("products", 2), ("sales", 3)):
        _control(spark, lake, s, f"2024100100{hour:02d}00")
    assert len(gate()) == 1
    assert len(gate("lost checkpoint")) == 1  # everything is read anew, the log knows the firing


def test_line_breaks_are_measured(spark, lake):
    plain = put_file(_source(spark, 60_000, "x" * 40), bronze_snapshot_path(lake.bronze, "products", "20240929", "20240929120000"))
    quoted = spark.createDataFrame([("1", 'a "b"\n, c', "d"), ("2", 'say ""', "e"), ("3", "line\rline", "f")], "product_id string, product_des string, product_category string")
    broken = put_file(quoted, bronze_snapshot_path(lake.bronze, "products", "20240930", "20240930120000"))
    doubled = put_file(quoted.where("product_id = '2'"), bronze_snapshot_path(lake.bronze, "products", "20240930", "20240930130000"))
    assert [has_line_breaks(spark, p) for p in (plain, broken, doubled)] == [False, True, False]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512k")
    try:
        rows = read_bronze(spark, plain, with_lineage=False, schema=PRODUCTS.raw_schema)
        assert rows.rdd.getNumPartitions() > 3 and rows.count() == 60_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(map(tuple, read_bronze(spark, broken, with_lineage=False).collect())) == sorted(map(tuple, quoted.collect()))
