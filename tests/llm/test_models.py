import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import cases
from tierbook.llm import langmix, lm

SYLLABLES = {"aa": "the an of ing er th ou ed".split(), "bb": "der die und ung ein sch ß ü".split(), "cc": "le la que tion é è eau oi".split()}


def _sentence(rng, lang, n):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def labelled():
    rng = random.Random(2)
    rows = []
    for i in range(240):
        lang = rng.choice(sorted(SYLLABLES))
        rows.append((i, _sentence(rng, lang, rng.randint(5, 80)), lang, "s"))
    return rows


def _predicted(spark, rows, model):
    found = langmix.predict(cases.table(spark, rows).select("doc_id", "text"), model)
    return {r["id"]: (r["lang_pred"], r["score"]) for r in found.collect()}


def test_held_out_accuracy(spark, labelled):
    docs = cases.table(spark, labelled)
    model = langmix.learn(docs.where(~langmix.held_out()))
    assert model[0] == sorted(SYLLABLES)
    got = _predicted(spark, labelled, model)
    test = [r for r in labelled if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert len(test) > 20
    assert sum(got[i][0] == lang for i, _, lang, _ in test) / len(test) > 0.97
    marked = {r["doc_id"] for r in docs.where(langmix.held_out()).collect()}
    assert marked == {r[0] for r in test}


def test_mixtures_and_odd_texts(spark, labelled):
    model = langmix.learn(cases.table(spark, labelled))
    rng = random.Random(4)
    mixed = _sentence(rng, "aa", 70) + " " + _sentence(rng, "bb", 30)
    rows = [(1, mixed, None, None), (2, None, None, None), (3, "", None, None), (4, " 12 !? ", None, None), (5, _sentence(rng, "cc", 4000), None, None),
            (6, "é", None, None), (7, _sentence(rng, "aa", 60).upper(), None, None)]
    got = _predicted(spark, rows, model)
    assert got[1][0] == "aa" and 0.55 < got[1][1] < 0.85
    assert got[2] == got[3] == got[4] == ("und", 0.0)
    assert got[5][0] == "cc" and got[5][1] == 1.0
    assert got[6][0] in SYLLABLES and got[7][0] == "aa"


def test_proportions_choose_the_set():
    rng = np.random.default_rng(0)
    model = rng.dirichlet(np.full(64, 0.2), 3).astype(np.float32)
    model = (model + 1e-4) / (model + 1e-4).sum(axis=1, keepdims=True)
    counts = np.stack([rng.multinomial(3000, m / m.sum()) for m in (model[0].astype(float), 0.5 * model[1].astype(float) + 0.5 * model[2].astype(float))])
    share = langmix.proportions(counts.astype(np.float32), model)
    assert share[0].argmax() == 0 and (share[0] > 0).sum() == 1
    assert share[1, 0] == 0 and abs(share[1, 1] - 0.5) < 0.1


def test_language_of_nothing(spark):
    model = langmix.learn(cases.empty(spark))
    assert model[0] == []
    assert langmix.predict(cases.empty(spark), model).count() == 0
    assert _predicted(spark, [(1, "some text", "x", "s")], model) == {1: ("und", 0.0)}


def test_scores_match_brute_force(spark):
    rows = [r for r in cases.odd_rows()]
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    found = lm.score(cases.table(spark, rows), ~held).select("id", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()
    count, ends = Counter(), 0
    for i, text, *_ in rows:
        if i is not None and zlib.crc32(str(i).encode()) % 7 != 2:
            count.update(cases.words((text or "").translate(cases.LOWER)))
            ends += 1
    n, v = sum(count.values()) + ends, len(count) + 1
    want = []
    for i, text, *_ in rows:
        w = cases.words((text or "").translate(cases.LOWER))
        base = sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w) + math.log10((ends + 1) / (n + v + 1))
        want.append((i, len(w) + 1, sum(count[x] > 0 for x in w) + 1, n, base))
    got = sorted((tuple(r) for r in found), key=lambda r: (r[0] is None, r[0], r[1]))
    want.sort(key=lambda r: (r[0] is None, r[0], r[1]))
    for g, x in zip(got, want, strict=True):
        assert g[:4] == x[:4] and math.isclose(g[4], x[4], rel_tol=1e-9, abs_tol=1e-9) and g[5] < 0


def _plain_score(model, counts, text):
    """The model's log10 probability of a text, token by token, from its weights and the words' counts."""
    from tierbook.llm import textkit as tk

    def hashed(w):
        return tk.word_hashes(np.frombuffer(w.encode() + b"\n", dtype=np.uint8), np.array([0]), np.array([len(w.encode())]))[0]

    words = cases.words((text or "").translate(cases.LOWER))
    known = [counts[w] for w in words] + [model.end]
    tokens = [hashed(w) for w in words] + [lm.END]
    total = 0.0
    for i, (token, c) in enumerate(zip(tokens, known)):
        one = np.array([tokens[i - 1] if i else lm.START], dtype=np.uint64)
        two = np.array([tokens[i - 2] if i > 1 else lm.START], dtype=np.uint64)
        (major,), (minor,) = lm.digits(np.array([token], dtype=np.uint64))
        for digit, within in ((major, None), (minor, np.array([major]))):
            logits = model.weights[lm.slots_of(one, two, within, len(model.weights))[0]].astype(float).sum(axis=0)
            total += (logits[digit] - np.log(np.exp(logits - logits.max()).sum()) - logits.max()) / math.log(10)
        total += math.log10((c + 1) / model.leaf[major, minor])
    return total


def test_model_scores_match_a_plain_version(spark, labelled):
    rows = cases.odd_rows() + [(100 + i, t, lang, s) for i, t, lang, s in labelled[:120]]
    docs = cases.table(spark, rows)
    found = lm.score(docs, F.lit(True)).collect()
    model, *_ = lm.learn(docs.select(F.xxhash64("doc_id").alias("key"), "text"))
    count = Counter()
    for _, text, *_ in rows:
        count.update(cases.words((text or "").translate(cases.LOWER)))
    want = sorted((r[0] is None, r[0] or 0, len(cases.words(r[1])), _plain_score(model, count, r[1])) for r in rows if len(r[1] or "") < 5000)
    got = sorted((r["id"] is None, r["id"] or 0, r["n_tokens"] - 1, r["score"]) for r in found if r["n_tokens"] < 2000)
    for g, w in zip(got, [w for w in want if w[2] < 1999], strict=True):
        assert g[:3] == w[:3] and math.isclose(g[3], w[3], rel_tol=1e-4)


def test_order_of_rare_words_counts(spark):
    """A phrase of words outside the commonest: shuffled, it is less likely."""
    rng = random.Random(6)
    phrase = [f"rare{i}" for i in range(12)]
    rows = []
    for i in range(800):
        w = [f"common{int(rng.paretovariate(0.7)) % 60}" for _ in range(30)]
        if i % 2:
            w[10:10] = phrase
        rows.append((i, " ".join(w), "x", "s"))
    tests = []
    for k in range(20):
        shuffled = phrase[:]
        while shuffled == phrase:
            rng.shuffle(shuffled)
        tests.append((1000 + k, " ".join(shuffled), "x", "s"))
    found = {r["id"]: r["score"] for r in lm.score(cases.table(spark, rows + [(999, " ".join(phrase), "x", "s")] + tests), F.col("doc_id") < 900).collect()}
    assert all(found[1000 + k] < found[999] - 3 for k in range(20))


def test_model_is_a_distribution_and_beats_unigrams(spark, labelled):
    rng = random.Random(9)
    rows = [(i, text if lang != "aa" else " ".join(sorted(text.split())), lang, "s") for i, text, lang, _ in labelled * 3]
    rows = [(k, r[1], r[2], r[3]) for k, r in enumerate(rows)]
    rng.shuffle(rows)
    found = lm.score(cases.table(spark, rows), F.col("doc_id") % 4 != 0).where("id % 4 = 0").agg(F.sum("base_score"), F.sum("score")).first()
    assert found[1] > found[0]
    weights = np.random.default_rng(0).normal(size=(lm.MIN_SLOTS, lm.CLASSES)).astype(np.float32)
    one, two = (np.random.default_rng(k).integers(0, 2**63, 50).astype(np.uint64) for k in (1, 2))
    for within in (None, np.arange(50)):
        at = lm.slots_of(one, two, within, lm.MIN_SLOTS)
        assert at.min() >= 0 and at.max() < lm.MIN_SLOTS
        assert np.allclose(lm.shares(weights, at).sum(axis=1), 1, atol=1e-5)


def test_gradient_steps_bring_expected_to_observed(spark, labelled):
    docs = cases.table(spark, labelled).select(F.xxhash64("doc_id").alias("key"), "text")
    tokens = sum(len(r[1].split()) + 1 for r in labelled)
    losses = []
    for steps in (0, 3, 12):
        weights = lm.train(docs, tokens, steps)
        total = 0.0
        for _, text, *_ in labelled[:60]:
            hashes, first = lm._words([text.encode()])
            token, one, two, _ = lm.sequences(hashes, first)
            for at, digit in lm.levels(token, one, two, len(weights)):
                total += lm.log_share(weights, at, digit).sum()
        losses.append(total)
    assert losses[0] < losses[1] < losses[2]


def test_scores_of_nothing(spark):
    assert lm.score(cases.empty(spark), F.lit(True)).count() == 0
    row = lm.score(cases.table(spark, [(1, None, None, None)]), F.lit(False)).first()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"], row["base_score"]) == (1, 0, 0, 0.0)


def test_gradient_steps_cover_every_training_document(spark, monkeypatch):
    """Tokens in the expected counts of all steps together are those of the observed counts."""
    docs = spark.createDataFrame([(k, f"w{k} common w{k % 7} end{k % 3}") for k in range(200)], "key long, text string")
    docs = docs.select(F.xxhash64("key").alias("key"), "text")
    tokens, summed = [], lm._summed

    def spy(tables, slots):
        found = summed(tables, slots)
        tokens.append(found[0].sum())
        return found

    monkeypatch.setattr(lm, "_summed", spy)
    lm.train(docs, 1000)
    assert tokens[0] == 1000 and len(tokens) == lm.STEPS + 1
    assert abs(sum(tokens[1:]) - tokens[0]) < 1e-2
