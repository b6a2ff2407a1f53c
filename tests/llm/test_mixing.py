import random

import pytest
from pyspark.sql import functions as F

import cases
from tierbook.llm import mixing


def _targets(sizes):
    """Sources in order (null last) with weights 5, 2, 1: water filling in plain Python."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    total, open_, target = 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        share = {s: total * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = [s for s in open_ if share[s] > 2 * sizes[s]]
        if not full:
            return target | share
        for s in full:
            target[s] = 2.0 * sizes[s]
            total -= target[s]
            open_.remove(s)
    return target


def _check(rows, found, slack=0.02):
    sizes, largest, taken = {}, {}, {}
    for _, text, _, source in rows:
        n = len(cases.words(text))
        sizes[source] = sizes.get(source, 0) + n
        largest[source] = max(largest.get(source, 0), n)
    want = _targets(sizes)
    for r in found:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]], rel=1e-9, abs=1e-6)
        assert 0 <= r["copies"] <= 2 and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    for s, t in want.items():
        assert abs(taken.get(s, 0) - t) <= max(largest[s], slack * t)


def test_targets_and_taken(spark):
    rng = random.Random(6)
    rows = [(i, cases.prose(rng, int(rng.paretovariate(1.1) * 20) % 3000), "x", rng.choice("aaaaaabbcdefg")) for i in range(1500)]
    rows += [(5000 + i, "one copy of the same text", "x", "a") for i in range(400)]
    found = mixing.mix(cases.table(spark, rows)).collect()
    assert len(found) == len(rows)
    _check(rows, found)


def test_odd_rows_and_reruns(spark):
    rows = cases.odd_rows()
    first = mixing.mix(cases.table(spark, rows)).drop("rest").collect()
    _check(rows, first)
    again = mixing.mix(cases.table(spark, rows, 7)).drop("rest").collect()
    assert sorted(map(str, first)) == sorted(map(str, again))
    assert all(r["taken"] == 0 for r in first if r["size"] == 0)


def test_cells_are_cut(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CELL_ROWS", 7)
    rows = [(i, "the same size", "x", "ab"[i % 2]) for i in range(101)]
    found = mixing.mix(cases.table(spark, rows)).collect()
    _check(rows, found)


def test_only_native_operators(spark):
    from conftest import plan_text

    plan = plan_text(mixing.mix(cases.table(spark, cases.odd_rows())), "extended")
    assert not any(word in plan for word in ("Python", "Pandas", "ArrowEval", "MapInArrow", "CartesianProduct"))


def test_nothing_to_mix(spark):
    assert mixing.mix(cases.empty(spark)).count() == 0
    assert [r["taken"] for r in mixing.mix(cases.table(spark, [(1, None, None, None), (2, " ", "x", "s")])).collect()] == [0, 0]


def test_token_count(spark):
    texts = [None, "", " ", "a", " a", "a ", "\ta\n b \r\n", "a b", "  x y", "a\x0bb\x0cc"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [tuple(r) for r in df.select("t", mixing.token_count(F.col("t"))).collect()]
    assert got == [(t, len(cases.words(t))) for t in texts]
