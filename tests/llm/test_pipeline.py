"""The pipeline against plain Python versions of its stages, each on its own input."""

import random

import pytest
from pyspark.sql import functions as F

import cases
import corpus_pipeline
from tierbook.llm import queries
from tierbook.llm.scratch import materialise


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(12)
    rows = cases.odd_rows() + [(100 + i, cases.prose(rng, rng.randrange(5, 200), 4000), "xx", "abc"[i % 3]) for i in range(60)]
    item = cases.prose(rng, 30, 4000, "b")
    rows.append((200, cases.prose(rng, 60, 4000) + " " + item, "xx", "a"))
    folder = str(tmp_path_factory.mktemp("sf"))
    cases.table(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def _rows(df):
    return [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in df.select("doc_id", "text", "lang", "source").collect()]


def test_each_stage_on_its_input(spark, corpus):
    docs = queries.table(spark, corpus, "documents")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "near_duplicates", "substrings", "decontamination", "mix"]
    before = _rows(docs)

    docs = materialise(stages["language"](spark, docs, corpus), "t1")
    assert docs.columns == columns
    gone = set(map(str, before)) - set(map(str, _rows(docs)))
    assert {g.split(",")[0] for g in gone} >= {"(20", "(21", "(22", "(26"} and len(gone) < 10

    before = _rows(docs)
    docs = materialise(stages["near_duplicates"](spark, docs, corpus), "t2")
    assert docs.columns == columns
    groups = {(r[0], r[1]): c for r, (_, _, c) in zip(before, cases.components(before))}
    want = {k for k, c in groups.items() if k[0] is None or c == k[0]}
    assert sorted(map(str, ((r[0], r[1]) for r in _rows(docs)))) == sorted(map(str, want))

    before = _rows(docs)
    docs = materialise(stages["substrings"](spark, docs, corpus), "t3")
    assert docs.columns == columns
    cut = [(i, kept if n_gone else r[1]) for r, (i, _, n_gone, kept) in zip(before, cases.removed_words(before))]
    assert sorted(map(str, ((r[0], r[1]) for r in _rows(docs)))) == sorted(map(str, cut))
    assert docs.where(F.col("n_chars") != F.length("text")).count() == 0

    before = _rows(docs)
    docs = materialise(stages["decontamination"](spark, docs, corpus), "t4")
    assert docs.columns == columns
    assert {r[0] for r in before} - {r[0] for r in _rows(docs)} == {200}

    mixed = stages["mix"](spark, docs, corpus).collect()
    assert len(mixed) == docs.count()


def test_language_stage_keeps_mixed_texts_and_needs_labels(spark):
    rng = random.Random(3)
    alphabets = {"aa": "abcde", "bb": "fghij", "cc": "klmno", "dd": "pqrst"}

    def prose(lang, n):
        return " ".join("".join(rng.choices(alphabets[lang], k=rng.randint(2, 7))) for _ in range(n))

    rows = [(i, prose(lang, 200), lang, "s") for i, lang in enumerate(sorted(alphabets) * 15)]
    rows.append((500, " ".join(prose(lang, 30) for lang in alphabets), None, "s"))  # a quarter each
    rows.append((501, "\u4e00\u4e8c\u4e09 \u56db\u4e94 " * 20, None, "s"))  # in none of the alphabets
    kept = {r["doc_id"] for r in corpus_pipeline.language(spark, cases.table(spark, rows), "").collect()}
    assert kept == {r[0] for r in rows} - {501}
    with pytest.raises(ValueError, match="no labelled"):
        corpus_pipeline.language(spark, cases.table(spark, [(r[0], r[1], None, r[3]) for r in rows]), "")


def test_stages_leave_no_tables_behind(spark, corpus):
    """What a stage has written for itself goes when the next one starts; columns named like its own keys stay."""
    import glob

    from tierbook.llm import scratch

    docs = queries.table(spark, corpus, "documents").withColumn("k1", F.lit("mine")).withColumn("_k1", F.lit("too"))
    out = materialise(corpus_pipeline.near_duplicates(spark, docs, corpus), "t")
    assert out.columns == docs.columns and {(r["k1"], r["_k1"]) for r in out.select("k1", "_k1").collect()} == {("mine", "too")}
    left = [p.removeprefix("file://").removeprefix("file:") for p in corpus_pipeline._LEFT]
    assert left and any(glob.glob(p) for p in left)
    materialise(corpus_pipeline.substrings(spark, out, corpus), "u")
    assert not any(glob.glob(p) for p in left) and out.count() > 0
    assert scratch.mark() > 0


def test_run_and_empty_run(spark, corpus, tmp_path):
    assert corpus_pipeline.run(spark, corpus).where("taken > 0").count() > 0
    cases.empty(spark).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
