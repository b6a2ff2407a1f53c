import hashlib
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import cases
from tierbook.llm import components, minhash, substring, suffix, textkit

ROWS = cases.odd_rows()


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


def test_word_windows_match_brute_force(spark):
    found = substring.remove_repeated_windows(cases.table(spark, ROWS)).select("id", "n_words", "n_removed", "kept_text", "text")
    got = [tuple(r) for r in found.collect()]
    assert _sorted(r[:4] for r in got) == _sorted(cases.removed_words(ROWS))
    assert _sorted((r[0], r[4]) for r in got) == _sorted((r[0], r[1]) for r in ROWS)


@pytest.mark.parametrize("hot", [0, 3, 40])
def test_hot_minimisers_go_by_window(spark, monkeypatch, hot):
    """A passage in a third of all documents: no bucket holds many of its edges, and the result is the same."""
    monkeypatch.setattr(substring, "HOT", hot)
    monkeypatch.setattr(substring, "SAMPLE", 1)
    rng = random.Random(hot)
    passage = cases.prose(rng, 40, 4000, "p")
    rows = cases.odd_rows()
    for i in range(150):
        rows.append((1000 + i, cases.prose(rng, 12, 4000, f"q{i}x") + (" " + passage + " " if i % 3 == 0 else " ") + cases.prose(rng, 12, 4000, f"r{i}x"), "xx", "a"))
    found = substring.remove_repeated_windows(cases.table(spark, rows))
    got = [(r["id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in found.collect()]
    assert _sorted(got) == _sorted(cases.removed_words(rows))
    if hot < 40:
        return
    source = cases.table(spark, rows).select(F.col("doc_id").alias("id"), F.hash("text").bitwiseAND(0x7FFF).cast("short").alias("row"), "text").where("id IS NOT NULL")
    least = substring.hot_minimisers(source, substring.WINDOW, substring.GRAIN)
    assert 0 < len(least) < 20  # those of the passage's edges


@pytest.mark.parametrize("partitions", [1, 5])
def test_word_windows_do_not_depend_on_the_layout(spark, partitions):
    found = substring.remove_repeated_windows(cases.table(spark, ROWS, partitions))
    assert _sorted(map(tuple, found.select("id", "n_words", "n_removed", "kept_text").collect())) == _sorted(cases.removed_words(ROWS))


def test_many_copies_over_chunks(spark, monkeypatch):
    monkeypatch.setattr(textkit, "CHUNK_BYTES", 4000)
    rng = random.Random(3)
    line = cases.prose(rng, 25, 5000)
    rows = [(i, cases.prose(rng, rng.randrange(40), 5000) + " " + line + " " + cases.prose(rng, 5, 5000), "x", "s") for i in range(300)]
    rng.shuffle(rows)
    found = substring.remove_repeated_windows(cases.table(spark, rows, 4)).select("id", "n_words", "n_removed", "kept_text")
    assert _sorted(map(tuple, found.collect())) == _sorted(cases.removed_words(rows))


@pytest.mark.parametrize("width,gram", [(400, 128), (40, 16)])
def test_byte_strings_match_brute_force(spark, width, gram):
    rows = [r for r in ROWS if r[0] != 30 or width == 400]
    found = suffix.remove_repeated_bytes(cases.table(spark, rows), width=width, gram=gram)
    got = [tuple(r) for r in found.select("id", "n_bytes", "n_removed", "n_spans", "text_sha256").collect()]
    want = [(i, n, r, s, hashlib.sha256(kept).hexdigest()) for i, n, r, s, kept in cases.removed_bytes(rows, width)]
    assert _sorted(got) == _sorted(want)


@pytest.mark.parametrize("hot", [1, 6])
def test_byte_strings_of_hot_grams_match_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix, "HOT_ANCHORS", hot)
    rng = random.Random(13)
    passage = cases.prose(rng, 25, 5000, "p")
    rows = [(100 + i, cases.prose(rng, rng.randrange(30), 5000) + passage + cases.prose(rng, 20, 5000), "x", "s") for i in range(40)]
    rows += [r for r in ROWS if r[0] != 30]
    found = suffix.remove_repeated_bytes(cases.table(spark, rows), width=80, gram=24)
    got = [tuple(r) for r in found.select("id", "n_bytes", "n_removed", "n_spans", "text_sha256").collect()]
    want = [(i, n, r, s, hashlib.sha256(kept).hexdigest()) for i, n, r, s, kept in cases.removed_bytes(rows, 80)]
    assert _sorted(got) == _sorted(want)


def test_no_bucket_holds_a_hot_gram(spark, monkeypatch):
    """A short passage in many documents: as many contexts as documents, none of which is dealt to one task."""
    rng = random.Random(17)
    passage = cases.prose(rng, 25, 5000, "p")
    rows = [(i, cases.prose(rng, 30, 5000) + passage + cases.prose(rng, 30, 5000)) for i in range(200)]
    docs = spark.createDataFrame(rows, "key long, text string").repartition(4)
    plain = suffix._bucket

    def dealt(hot):
        total = spark.sparkContext.accumulator(0)

        def bucket(width, gram):
            run = plain(width, gram)

            def counted(batches):
                def seen():
                    for batch in batches:
                        total.add(batch.num_rows)
                        yield batch

                yield from run(seen())

            return counted

        monkeypatch.setattr(suffix, "_bucket", bucket)
        assert suffix.cut_repeats(docs, width=80, gram=24, hot=hot).where("n_removed >= 80").count() == 200
        return total.value

    assert dealt(10**6) >= 200
    assert dealt(20) < 50


def test_batches_close_where_the_gram_changes(monkeypatch):
    """Grams that share their leading bytes."""
    sizes = []
    monkeypatch.setattr(suffix, "BATCH_CONTEXTS", 4)
    monkeypatch.setattr(suffix, "repeated_offsets", lambda contexts, *_: sizes.append(len(contexts)) or np.zeros((len(contexts), 1), dtype=bool))
    n = 20
    columns = {"lead": [b"a" * 32] * n, "gram": sorted(i % 10 for i in range(n)), "h1": range(n), "h2": range(n), "left": [0] * n, "many": [1] * n}
    batch = pa.RecordBatch.from_pydict({k: list(v) for k, v in columns.items()} | {"context": [b"a" * 400] * n})
    assert not list(suffix._bucket(400, 128)([batch])) and sum(sizes) == n and max(sizes) <= 5


def test_multikey_order_sorts_rows():
    rng = np.random.default_rng(1)
    rows = rng.integers(0, 3, (500, 24), dtype=np.uint8)
    order = suffix.multikey_order(rows)
    want = sorted(map(bytes, rows))
    assert [bytes(rows[i]) for i in order] == want
    lcp = suffix.common_prefixes(rows, order)
    for k in range(1, len(want)):
        assert lcp[k] == next((j for j in range(24) if want[k][j] != want[k - 1][j]), 24)


@given(st.lists(st.integers(0, 50), min_size=1, max_size=60), st.integers(1, 20))
@settings(max_examples=50, deadline=None)
def test_sliding_min(values, width):
    x = np.array(values, dtype=np.uint64)
    assert list(textkit.sliding_min(x, width)) == [min(values[i : i + width]) for i in range(len(values) - width + 1)]


def test_near_duplicates_match_brute_force(spark):
    found = minhash.near_duplicates(cases.table(spark, ROWS)).select("id", "n_shingles", "component_id", "kept")
    got = [tuple(r) for r in found.collect()]
    want = [(i, n, c, c is None or c == i) for i, n, c in cases.components(ROWS)]
    assert _sorted(got) == _sorted(want)


def test_chains_and_stars_of_near_copies(spark):
    """Copies of copies: neighbours are near, the ends are not; and many near copies of one text."""
    rng = random.Random(11)
    w, rows = cases.prose(rng, 150, 9000).split(" "), []
    for i in range(40):
        rows.append((100 + i, " ".join(w), "x", "s"))
        w = [f"c{rng.randrange(10**6)}" if rng.random() < 0.02 else x for x in w]
    base = cases.prose(rng, 100, 9000, "q").split(" ")
    for i in range(150):
        t = list(base)
        for _ in range(rng.randrange(8)):
            t[rng.randrange(len(t))] = f"e{rng.randrange(10**6)}"
        rows.append((1000 + i, " ".join(t), "x", "s"))
    found = minhash.near_duplicates(cases.table(spark, rows)).select("id", "n_shingles", "component_id")
    assert _sorted(map(tuple, found.collect())) == _sorted(cases.components(rows))


@pytest.mark.parametrize("members,shingles", [(4, 400), (8, 2000), (2, 1)])
def test_long_lists_and_large_components_go_in_blocks(spark, monkeypatch, members, shingles):
    """A family of near copies of which many pairs lie just below the threshold, cut into many blocks."""
    monkeypatch.setattr(minhash, "LIST_MEMBERS", members)
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", shingles)
    rng = random.Random(members)
    base = cases.prose(rng, 100, 5000).split(" ")
    rows = []
    for i in range(70):
        w = list(base) if i % 10 else list(rows[-1][1].split(" ")) if rows else list(base)
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
        if i % 7 == 0:
            w += [f"more{i}x{k}" for k in range(rng.randint(0, 30))]
        rows.append((i, " ".join(w), "xx", "a"))
    rows += cases.odd_rows()
    found = minhash.near_duplicates(cases.table(spark, rows)).select("id", "n_shingles", "component_id").collect()
    key = lambda r: (r[0] is None, *(x or 0 for x in r))
    assert sorted(map(tuple, found), key=key) == sorted(cases.components(rows), key=key)


def _joined(m, a, b):
    parent = list(range(m))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, y in zip(a, b):
        parent[find(x)] = find(y)
    return [min(k for k in range(m) if find(k) == find(i)) for i in range(m)]


@pytest.mark.parametrize("seed", range(6))
def test_walks_connect_what_all_pairs_connect(seed):
    rng = np.random.default_rng(seed)
    core = rng.integers(0, 60, 40)
    sets = [np.unique(np.where(rng.random(40) < rng.choice([0.02, 0.1, 0.4]), rng.integers(0, 2000, 40), core)).astype(np.uint64) for _ in range(60)]
    sets[7] = sets[7][:0]

    def linked(x, y):
        both = len(np.intersect1d(sets[x], sets[y]))
        return both and 100 * both >= 75 * (len(sets[x]) + len(sets[y]) - both)

    pairs = [(x, y) for x in range(60) for y in range(x) if linked(x, y)]
    a, b = minhash.confirmed(sets, 75)
    assert all(linked(x, y) for x, y in zip(a, b)) and len(a) < 60
    assert _joined(60, a, b) == _joined(60, *zip(*pairs))
    a, b = minhash.confirmed(sets, 75, first=20)
    across = [(x, y) for x, y in pairs if (x < 20) != (y < 20)]
    assert all((x < 20) != (y < 20) and linked(x, y) for x, y in zip(a, b))
    assert _joined(60, a, b) == _joined(60, *zip(*across))
    sketch = rng.integers(0, 3, (50, 64)).astype(np.uint8)
    n = rng.integers(80, 100, 50)
    a, b = minhash.matching(sketch, n, 26, 90)
    near = [(x, y) for x in range(50) for y in range(x) if (sketch[x] == sketch[y]).sum() >= 26 and 100 * min(n[x], n[y]) >= 90 * max(n[x], n[y])]
    assert _joined(50, a, b) == _joined(50, *zip(*near))


def test_components_of_chains(spark):
    rng = random.Random(5)
    names = rng.sample(range(-1000, 1000), 60)
    edges = [(names[i], names[i + 1]) for i in range(39)] + [(names[40], n) for n in names[41:]]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["label"] for r in components.components(df).collect()}
    assert got == {n: min(names[:40]) for n in names[:40]} | {n: min(names[40:]) for n in names[40:]}


@pytest.mark.parametrize("operator", [substring.remove_repeated_windows, suffix.remove_repeated_bytes, minhash.near_duplicates])
def test_empty_tables(spark, operator):
    assert operator(cases.empty(spark)).count() == 0
    nothing = cases.table(spark, [(1, None, None, None), (2, "", "x", "s"), (None, None, None, None)])
    assert operator(nothing).count() == 3


def test_other_columns_are_kept(spark):
    found = substring.remove_repeated_windows(cases.table(spark, ROWS))
    assert found.select("rest.*").columns == ["lang", "source", "n_chars", "id", "row", "rest", "n", "class"]
    assert found.where(F.col("rest.class") != 7).count() == 0
    assert minhash.near_duplicates(cases.table(spark, ROWS)).select("rest.rest").distinct().count() == 1


def test_a_chunk_of_text_takes_little_memory():
    """The peak of a task's arrays while it cuts a chunk into super-k-mers and removes ranges from it, the tables of powers included."""
    rng = random.Random(4)
    text = " ".join("".join(rng.choices("abcdefgh", k=rng.randint(1, 9))) for _ in range(textkit.CHUNK_BYTES // 6))[: textkit.CHUNK_BYTES - 1]
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([0], pa.int16()), pa.array([text])], names=["id", "row", "text"])
    kept, textkit.Poly._powers = textkit.Poly._powers, {}
    tracemalloc.start()
    try:
        assert len(list(substring._super_kmers(13, 4, 8, np.zeros(0, np.uint64))([batch]))) == 1
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
        textkit.Poly._powers = kept
    assert peak < 58 * textkit.CHUNK_BYTES


def _worker_peak(run, batch) -> int:
    """Bytes of Python's and numpy's memory at the peak while a task takes ``batch``, the tables of powers included."""
    kept, textkit.Poly._powers = textkit.Poly._powers, {}
    tracemalloc.start()
    try:
        for _ in run([batch]):
            pass
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
        textkit.Poly._powers = kept


def _long_batch() -> pa.RecordBatch:
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(5000)]
    texts = [" ".join(rng.choices(words, k=300)) for _ in range(1600)]
    n = len(texts)
    columns = {"key": range(n), "id": range(n), "row": pa.array([0] * n, pa.int16()), "anchors": pa.array([[9, 300]] * n, pa.list_(pa.int32())), "text": texts}
    return pa.RecordBatch.from_pydict({k: pa.array(v) if not isinstance(v, pa.Array) else v for k, v in columns.items()})


def test_a_worker_cuts_a_batch_into_suffixes_in_small_chunks():
    batch = _long_batch()
    assert _worker_peak(suffix._anchors(400, 128), batch) < 60 << 20
    assert _worker_peak(suffix._suffixes(400, 128), batch) < 60 << 20


def test_a_worker_cuts_a_batch_into_super_kmers_in_small_chunks():
    batch = _long_batch()
    assert _worker_peak(substring._super_kmers(13, 4, 204, np.zeros(0, np.uint64)), batch) < 55 << 20
    found = pa.Table.from_batches(substring._super_kmers(13, 4, 8, np.zeros(0, np.uint64))([batch]))
    assert sorted(set(found.column("bucket").to_pylist())) == list(range(8))


def test_a_worker_signs_a_batch_in_small_chunks():
    long = _long_batch()
    batch = pa.RecordBatch.from_pydict({"id": long.column("id"), "row": long.column("row"), "rest": long.column("row"), "text": long.column("text")})
    assert _worker_peak(minhash._signatures(5, 64), batch) < 35 << 20
