import random

import numpy as np
from pyspark.sql import functions as F

import cases
from tierbook.llm import decontaminate, licenses, permutation, scratch


def _vectors(spark, rows):
    wide = [(i, v, 1, "x", None) for i, v in rows]
    return spark.createDataFrame(wide, "vec_id long, embedding array<float>, label int, id string, vector string").repartition(3)


def _nearest(rows, query, k=20):
    usable = [(i, v) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v) and len(v) == 8]
    out = {}
    for i, v in usable:
        if i % query == 0:
            best = {}
            for j, u in usable:
                if j != i:
                    s = float((np.array(u, np.float32).astype(float) * np.array(v, np.float32).astype(float)).sum())
                    best[j] = max(best.get(j, -np.inf), s)
            out[i] = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
    return out


def _odd_vectors(n=400):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(n)]
    same = rng.normal(size=8).astype(np.float32).tolist()
    rows += [(n + i, same) for i in range(120)]  # many copies: ties go to the smaller id
    rows += [(900, None), (920, []), (940, [0.0] * 8), (960, [1.0] * 7 + [None]), (980, [float("nan")] * 8), (1000, [float("inf")] * 8),
             (1020, [1.0, 2.0]), (None, same), (1040, [x * 50 for x in same]), (40, same)]
    return rows


def test_recall_and_exact_scores(spark):
    rows = _odd_vectors()
    found = permutation.nearest(_vectors(spark, rows), lambda i: i % 20 == 0, probes=200, share=0.6).collect()
    want = _nearest(rows, 20)
    got = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert set(got) == set(want)
    hits = 0
    for q, neighbours in got.items():
        assert [n for n, _ in neighbours] == [n for n, _ in sorted(neighbours, key=lambda x: (-x[1], x[0]))]
        assert len(neighbours) == 20 and q not in dict(neighbours)
        hits += len(set(dict(neighbours)) & set(dict(want[q])))
        exact = dict(want[q])
        assert all(np.isclose(s, exact[n], rtol=1e-12) for n, s in neighbours if n in exact)
    assert hits / (20 * len(want)) >= 0.9


def test_few_vectors_find_all(spark):
    rows = _odd_vectors(30)[:30]
    found = permutation.nearest(_vectors(spark, rows), lambda i: i % 10 == 0, k=40, probes=1).groupBy("query_id").count().collect()
    assert {r["query_id"]: r["count"] for r in found} == {0: 29, 10: 29, 20: 29}


def test_no_vectors(spark):
    assert permutation.nearest(_vectors(spark, []), lambda i: i % 2 == 0).count() == 0
    assert permutation.nearest(_vectors(spark, [(2, [0.0] * 8)]), lambda i: i % 2 == 0).count() == 0
    assert permutation.nearest(_vectors(spark, [(2, [1.0] * 8)]), lambda i: i % 2 == 0).count() == 0


def _items(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], "item_id long, text string, key string")


def test_items_inside_documents(spark):
    rng = random.Random(1)
    items = [(i, cases.prose(rng, n, 3000, "b")) for i, n in enumerate([6, 9, 15, 30, 57, 200])]
    items += [(10, None), (11, " "), (12, "one two"), (13, items[2][1]), (None, items[3][1])]
    rows = cases.odd_rows()
    for i, (_, t) in enumerate(items[:6]):
        w = t.split(" ")
        rows.append((100 + i, cases.prose(rng, 800, 3000) + " " + t.upper() + "\n" + cases.prose(rng, 300, 3000), "x", "s"))
        rows.append((200 + i, cases.prose(rng, 50, 3000) + " " + " ".join(w[: int(len(w) * 0.9)]) + " tail", "x", "s"))
        rows.append((300 + i, cases.prose(rng, 50, 3000) + " " + " ".join(w[: len(w) // 2]), "x", "s"))
    items += [(14, "Capital of france"), (15, "w1 w2 w1 w3"), (16, "unseen")]
    rows.append((400, cases.prose(rng, 90, 3000) + " The capital of France\nis " + cases.prose(rng, 90, 3000), "x", "s"))
    want = []
    for i, text, *_ in rows:
        for j, t in items:
            n = min(5, len(cases.words(t)))
            q, s = cases.shingles(t), cases.shingles(text, max(n, 1))
            if q and 100 * len(q & s) >= 75 * len(q):
                want.append((i, j, len(q), len(q & s)))
    docs = cases.table(spark, rows)
    found = decontaminate.contaminated(docs, _items(spark, items)).select("id", "item_id", "n_item", "n_common").collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, want)) and len(want) > 8
    bad = {w[0] for w in want}
    kept = decontaminate.clean(docs, _items(spark, items))
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r[0]) for r in rows if r[0] not in bad)


def test_shuffled_joins_give_the_same(spark, monkeypatch):
    rng = random.Random(2)
    items = [(i, cases.prose(rng, 20, 3000, "b")) for i in range(5)]
    rows = [(i, cases.prose(rng, 60, 3000) + " " + items[i % 5][1], "x", "s") for i in range(20)] + cases.odd_rows()
    docs = cases.table(spark, rows)
    before = sorted(map(str, decontaminate.contaminated(docs, _items(spark, items)).drop("key").collect()))
    monkeypatch.setattr(scratch.small, "__defaults__", (0,))
    assert sorted(map(str, decontaminate.contaminated(docs, _items(spark, items)).drop("key").collect())) == before


def test_nothing_to_search(spark):
    assert decontaminate.contaminated(cases.empty(spark), _items(spark, [(1, "a b c d e f")])).count() == 0
    assert decontaminate.contaminated(cases.table(spark, cases.odd_rows()), _items(spark, [])).count() == 0
    assert decontaminate.clean(cases.table(spark, cases.odd_rows()), _items(spark, [])).count() == len(cases.odd_rows())


def _plain_words(text):
    import re

    return [w for w in re.split(r"[\x00-/:-`{-\x7f]+", (text or "").lower()) if w]


def _grams(text, n=5):
    w = _plain_words(text)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def test_customary_notices_are_covered(spark):
    texts = {
        "MIT": "Licensed under the MIT License.", "Apache-2.0": "// SPDX-License-Identifier: Apache-2.0", "LGPL-3.0": "released under the GNU Lesser General Public License, version 3",
        "CC-BY-SA-4.0": "This work is licensed under CC BY-SA 4.0", "Unlicense": "released under the Unlicense", "ISC": "Licensed under the ISC license",
        "GPL-2.0": "distributed under the GNU General Public License, version 2", "BSD-3-Clause": "Licensed under the BSD 3-Clause License",
    }
    rows = [(i, f"some text before\n{t}\nand some after it", "x", k) for i, (k, t) in enumerate(texts.items())]
    found = licenses.scan(cases.table(spark, rows), licenses.notice_table(spark)).select("id", "license").distinct().collect()
    assert {(r["id"], r["license"]) for r in found} >= set(enumerate(texts))
    assert len({n for _, n, _ in licenses.NOTICES}) == len(licenses.NOTICES)


def test_notices_are_found(spark):
    rng = random.Random(8)
    rows = cases.odd_rows()
    for i, (_, _, text) in enumerate(licenses.NOTICES):
        rows.append((400 + i, cases.prose(rng, rng.randrange(100), 3000) + "\n" + text.upper() + "\n" + cases.prose(rng, 90, 3000), "x", "s"))
        rows.append((500 + i, cases.prose(rng, 40, 3000) + "\n# " + text.replace(" ", "\n# "), "x", "s"))
        rows.append((600 + i, " ".join(text.split(" ")[: len(text.split(" ")) // 2]), "x", "s"))
    want = []
    for i, text, *_ in rows:
        for lic, name, notice in licenses.NOTICES:
            n = min(5, len(_plain_words(notice)))
            q, s = _grams(notice, n), _grams(text, n)
            if 100 * len(q & s) >= 75 * len(q):
                want.append((i, lic, name, len(q), len(q & s)))
    found = licenses.scan(cases.table(spark, rows), licenses.notice_table(spark))
    got = [tuple(r) for r in found.select("id", "license", "template", "n_template", "n_common").collect()]
    assert sorted(got) == sorted(want) and {w[0] for w in want} >= set(range(400, 400 + len(licenses.NOTICES)))
    assert found.where("n_windows < 1").count() == 0
    assert licenses.scan(cases.empty(spark), licenses.notice_table(spark)).count() == 0
    assert licenses.scan(cases.table(spark, rows), licenses.notice_table(spark).where(F.lit(False))).count() == 0
