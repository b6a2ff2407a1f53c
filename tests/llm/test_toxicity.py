import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import cases
from tierbook.llm import langmix, toxicity as tx

BAD = "rotten vile wretch oaf".split()


@pytest.fixture(scope="module")
def labelled():
    """Documents, a third of them labelled; toxic ones hold one to three bad words."""
    rng = random.Random(8)
    docs, marks, truth = [], [], {}
    for i in range(1500):
        w = cases.prose(rng, rng.randint(3, 80), 3000).split(" ")
        truth[i] = rng.random() < 0.12
        if truth[i]:
            for b in rng.sample(BAD, rng.randint(1, 3)):
                w.insert(rng.randrange(len(w) + 1), rng.choice([b, b.upper(), b + "!"]))
        docs.append((i, " ".join(w), "xx", "s"))
        if rng.random() < 0.4:
            marks.append((i, 1, int(truth[i])))
    return docs, marks, truth


def _labels(spark, marks):
    return spark.createDataFrame([(*m, "x") for m in marks], "doc_id long, quality int, toxic int, text string")


def test_held_out_documents(spark, labelled):
    docs, marks, truth = labelled
    table = cases.table(spark, docs)
    model = tx.learn(table.where(~langmix.held_out()), _labels(spark, marks))
    found = {r["id"]: r for r in tx.score(table, model).collect()}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    toxic = [found[i]["predicted"] for i in held if truth[i]]
    clean = [found[i]["predicted"] for i in held if not truth[i]]
    assert len(toxic) > 20 and np.mean(toxic) > 0.9 and np.mean(clean) < 0.02
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found.values())
    assert np.array_equal(model, tx.learn(table.repartition(7).where(~langmix.held_out()), _labels(spark, marks)))  # reruns agree


def test_scores_match_a_plain_version(spark, labelled):
    docs, marks, _ = labelled
    model = tx.learn(cases.table(spark, docs), _labels(spark, marks))
    rows = [(r[0], r[1], r[2], r[3]) for r in cases.odd_rows()] + docs[:50]
    want = []
    for i, text, *_ in rows:
        words = set("".join(c if c.isascii() and c.isalnum() or not c.isascii() else " " for c in (text or "").translate(cases.LOWER)).split(" ")) - {""}
        slots = {int(tx.word_slots([w.encode()], tx.SLOTS)[1][0]) for w in words}
        margin = float(model[-1]) + sum(float(model[s]) for s in slots)
        want.append((i, 1 / (1 + np.exp(-margin))))
    got = [(r["id"], r["score"]) for r in tx.score(cases.table(spark, rows), model).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    for g, w in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert g[0] == w[0] and abs(g[1] - w[1]) < 1e-6


def test_risk_and_its_gradient():
    """The risk is the corrected one; its gradient that of finite differences, reversed where the corrected part is negative."""
    rng = np.random.default_rng(1)
    dense = [rng.random((n, 6)) < 0.4 for n in (12, 30)]
    pairs = [(*np.nonzero(d),) for d in dense]
    with_bias = [np.hstack([d, np.ones((len(d), 1))]) for d in dense]

    def risk(w, prior):
        sp, su = (1 / (1 + np.exp(-(x @ w))) for x in with_bias)
        return prior * (1 - sp).mean(), su.mean() - prior * sp.mean()

    reversed_ = 0
    for prior in (0.1, 0.9):
        for scale in (0.3, 3.0):
            w = rng.normal(size=7) * scale
            plus, minus, g = tx.risk_gradient(w, pairs[0], 12, pairs[1], 30, prior)
            assert np.allclose((plus, minus), risk(w, prior))
            for k in range(7):
                step = np.zeros(7)
                step[k] = 1e-6
                up, down = risk(w + step, prior), risk(w - step, prior)
                slope = sum(up) - sum(down) if minus >= 0 else down[1] - up[1]
                assert abs(g[k] - slope / 2e-6) < 1e-4
            reversed_ += minus < 0
    assert 0 < reversed_ < 4


def test_bounds_are_parameters(spark, labelled):
    docs, marks, truth = labelled
    model = tx.learn(cases.table(spark, docs), _labels(spark, marks), positives=20, unlabelled=200)
    found = tx.score(cases.table(spark, docs), model)
    toxic = found.where(F.col("id").isin([i for i in truth if truth[i]])).agg(F.avg("predicted")).first()[0]
    assert toxic > 0.6


def test_labels_of_all_kinds(spark, labelled):
    docs, marks, _ = labelled
    more = marks + [(marks[0][0], None, None), (None, 0, 1), (10**9, 0, 1)] + marks[:50]
    one, two = (tx.learn(cases.table(spark, docs), _labels(spark, m)) for m in (marks, more))
    assert np.allclose(one, two)


def test_nothing(spark):
    none = tx.learn(cases.empty(spark), _labels(spark, []))
    assert none is None
    assert tx.score(cases.empty(spark), none).count() == 0
    row = tx.score(cases.table(spark, [(1, None, None, None)]), none).first()
    assert (row["id"], row["score"], row["predicted"]) == (1, 0.0, 0)
    assert tx.learn(cases.table(spark, [(1, "a b", None, None)]), _labels(spark, [(1, 0, 0)])) is None


def test_unseen_forms_of_a_toxic_stem(spark):
    """Forms that no document of the training has count by their first bytes; words that share fewer don't."""
    rng = random.Random(5)
    docs, marks = [], []
    for i in range(1500):
        w = cases.prose(rng, rng.randint(5, 60), 3000).split(" ")
        toxic = rng.random() < 0.12
        if toxic:
            w += [f"gramo{rng.choice(['ta', 'ñer', 'lis', 'dun'])}" for _ in range(rng.randint(1, 3))]
        docs.append((i, " ".join(w), "xx", "s"))
        if rng.random() < 0.5:
            marks.append((i, 1, int(toxic)))
    model = tx.learn(cases.table(spark, docs), _labels(spark, marks))
    rows = [(10_000, "Gramoxel w1 w2", "xx", "s"), (10_001, "w1 gramoé!", "xx", "s"), (10_002, "gram w1 w2", "xx", "s"), (10_003, "w1 grim", "xx", "s")]
    found = {r["id"]: r["predicted"] for r in tx.score(cases.table(spark, rows), model).collect()}
    assert found == {10_000: 1, 10_001: 1, 10_002: 0, 10_003: 0}
    # a stem of few confirmed documents says nothing, nor one of many others
    few = tx.stem_weights(np.array([9, 40, 40]), 100, np.array([9, 80, 900]), 2000, 0.1, -3.0)
    assert few[0] == 0 and few[1] > 3 and few[2] == 0
