import random
import re
from collections import Counter, defaultdict

import pytest

import cases
from tierbook.llm import collocations as co


def brute(rows, min_count=10, top=2000):
    """rows: (text, lang). The contract, counted phrase by phrase."""
    count, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(cases.LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for n in (1, 2, 3):
                count[lang].update(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    out = []
    for lang, f in count.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        found = []
        for p, a in candidates.items():
            longer = [b for q, b in candidates.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if any(100 * b >= 50 * a for b in longer):
                continue
            score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, total[lang], -s))
    return sorted(out)


def _found(spark, rows, **kw):
    docs = cases.table(spark, [(i, t, lang, "s") for i, (t, lang) in enumerate(rows)])
    return sorted(tuple(r) for r in co.collocations(docs, **kw).collect())


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    rows = []
    for i in range(150):
        lang = rng.choice(["aa", "aa", "bb", None])
        pieces = []
        for _ in range(rng.randint(0, 25)):
            words = cases.prose(rng, rng.randint(1, 14), 40).split(" ")
            if rng.random() < 0.3:
                words[0:0] = ["Firm", "phrase", "é%d" % rng.randint(0, 2)]
            pieces.append(rng.choice([" ", "  ", "\t"]).join(words))
        rows.append((rng.choice([". ", ",", "\n", "!\r\n"]).join(pieces), lang))
    rows += [rows[5]] * 30 + [(None, "aa"), ("", "bb"), (" .,;\n", None), ("same " * 3000, "bb"), ("x" * 5000, "bb")]
    return rows


def test_matches_brute_force(spark, corpus):
    want = brute(corpus)
    assert len(want) > 100 and {r[0] for r in want} == {"aa", "bb", "und"}
    assert _found(spark, corpus) == want


def test_limits_and_ties(spark, corpus):
    assert _found(spark, corpus, min_count=3, top=7) == brute(corpus, 3, 7)


@pytest.mark.parametrize("trigger", [1, 2, 50, 10**9])
def test_parse_counts_every_phrase_once(spark, corpus, trigger):
    """Whatever the triggers: chunks of three words up to whole texts."""
    assert _found(spark, corpus[:60], min_count=2, trigger=trigger) == brute(corpus[:60], 2)


def test_equal_passages_share_chunks(spark):
    rng = random.Random(1)
    passage = cases.prose(rng, 600, 3000)
    rows = [(f"{cases.prose(rng, 9, 3000, 'a')} {passage} {cases.prose(rng, 5, 3000, 'b')}", "xx") for _ in range(20)]
    chunks = co.parse(cases.table(spark, [(i, t, lang, "s") for i, (t, lang) in enumerate(rows)])).collect()
    assert sum(r["n"] for r in chunks) > 4 * len(chunks)


def test_large_counts_stay_exact(spark):
    big = 3 * 10**12  # the square passes 64 bits
    rows = [("", 9 * 10**12), ("a", big + 1), ("b", big + 7), ("a b", big)]
    counts = spark.createDataFrame([("xx", p, n) for p, n in rows], "lang string, phrase string, n long")
    row = co._scored(counts).first()
    assert (row["score"], row["l"], row["r"]) == (10**6 * big * big // ((big + 1) * (big + 7)), big + 1, big + 7)


def test_filter_keeps_every_phrase(spark):
    phrases = [("l%d" % (i % 3), f"w{i} é{i}") for i in range(5000)]
    known = co.frequent(spark.createDataFrame(phrases, "lang string, phrase string"))
    import numpy as np
    import pyarrow as pa
    from tierbook.llm import textkit as tk

    def keys(pairs):
        buf, starts = tk.joined([p.encode() for _, p in pairs])
        return tk.mix(tk.Poly(buf).ranges(starts[:-1], starts[1:] - 1)) ^ co._lang_hashes(pa.array([x for x, _ in pairs]))

    assert known.holds(keys(phrases)).all()
    assert np.mean(known.holds(keys([("l9", p) for _, p in phrases]))) < 0.1


def test_nothing(spark):
    assert co.collocations(cases.empty(spark)).count() == 0
    assert _found(spark, [(None, None), ("...", "aa")]) == []
