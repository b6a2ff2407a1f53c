"""Small inputs with every odd case, and plain Python versions of the operators."""

import random
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, `row` string, rest string, n string, `class` int"


def words(text):
    return WORD.findall(text or "")


def prose(rng, n, vocabulary=200, tag="w"):
    return " ".join(f"{tag}{int(rng.paretovariate(0.6)) % vocabulary}" for _ in range(n))


def odd_rows():
    """(doc_id, text, lang, source): copies, near copies, shared passages, short, blank, null and very long texts."""
    rng = random.Random(7)
    base = prose(rng, 120, 4000)
    passage = prose(rng, 90, 4000, "p")
    rows = [(0, base, "xx", "a"), (1, base, "xx", "a"), (2, base.upper(), "xx", None)]
    for i in range(3, 12):  # near copies, some of each other only
        w = base.split(" ")
        for _ in range(i - 2):
            w[rng.randrange(len(w))] = f"edit{rng.randrange(10**6)}"
        rows.append((i, " ".join(w), "xx", "b"))
    for i in range(12, 20):  # one passage in different texts, with other separators
        rows.append((i, prose(rng, 40, 4000) + "\n" + passage.replace(" ", "  " if i == 13 else " ") + "\t" + prose(rng, 30, 4000), "yy", "c"))
    rows += [(20, None, "xx", "a"), (21, "", "xx", "a"), (22, " \t\n ", None, "a"), (23, "one two", "yy", "b"), (24, "one two", "yy", "b"),
             (25, "éé ßß  ñ x", "yy", None), (26, "12 34 !!", "yy", "d")]
    rows += [(27, "again " * 60, "yy", "d"), (28, "x" * 3000, "yy", "d"), (29, ("line of words that repeats itself here\n" * 40), "yy", "d")]
    rows += [(30, prose(rng, 30_000, 4000), "xx", "long"), (None, base, "xx", "a"), (None, passage, None, None)]
    rows += [(31, "twice the same row of words and more words than five", "xx", "a")] * 2
    rows += [(32, base, "xx", "a"), (32, passage, "xx", "a")]  # one id, two texts
    return rows


def table(spark, rows, partitions=3):
    """Rows with extra columns whose names the operators use themselves."""
    wide = [(*r, None if r[1] is None else len(r[1]), "i", "r", "s", None, 7) for r in rows]
    return spark.createDataFrame(wide, SCHEMA).repartition(partitions)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text, n=5, lower=True):
    w = words(text.translate(LOWER) if lower else text) if text else []
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)])


def removed_words(rows, window=13):
    """Per row: kept words, when windows that start in a document with a smaller id go."""
    least = {}
    for i, text, *_ in rows:
        w = words(text)
        if i is not None:
            for j in range(len(w) - window + 1):
                k = tuple(w[j : j + window])
                least[k] = min(least.get(k, i), i)
    out = []
    for i, text, *_ in rows:
        w = words(text)
        gone = [False] * len(w)
        if i is not None:
            for j in range(len(w) - window + 1):
                if least[tuple(w[j : j + window])] < i:
                    gone[j : j + window] = [True] * window
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


def removed_bytes(rows, width):
    count = Counter()
    texts = [(r[1] or "").encode() for r in rows]
    for b in texts:
        for j in range(len(b) - width + 1):
            count[b[j : j + width]] += 1
    out = []
    for r, b in zip(rows, texts):
        gone = [False] * len(b)
        for j in range(len(b) - width + 1):
            if count[b[j : j + width]] > 1:
                gone[j : j + width] = [True] * width
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((r[0], len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return out


def components(rows, percent=75):
    """Component id by row (null ids: null)."""
    sets = [shingles(r[1]) if r[0] is not None else frozenset() for r in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                parent[find(a)] = find(b)
    least = defaultdict(lambda: None)
    for k, r in enumerate(rows):
        if r[0] is not None:
            f = find(k)
            least[f] = r[0] if least[f] is None else min(least[f], r[0])
    return [(r[0], len(shingles(r[1])), least[find(k)] if r[0] is not None else None) for k, r in enumerate(rows)]
