"""The corpus pipeline: documents in, a weighted training mix out.

``STAGES`` in order; each takes (spark, docs, sf_dir), works on all documents
that its predecessor kept, and returns a DataFrame that is written as Parquet
in the shared folder and read again as the next stage's documents. All but the
last return the columns of ``documents``.

1. language: documents whose language can't be told (``und``: no letter), or
   that all learned languages together explain clearly worse than chance, go; a text
   in several languages stays. The model learns from the labelled documents that
   are given; if none is labelled, that is an error.
2. near_duplicates: of each group of near copies the document with the smallest
   id stays (of rows that repeat one id and text, one).
3. substrings: words inside 13-word windows that a document with a smaller id
   holds too are cut; a document that loses words keeps the others joined by
   one space, ``n_chars`` follows, all others stay untouched.
4. decontamination: documents that hold a benchmark item go.
5. mix: ``doc_id, size, source, target, copies, taken`` of every document.

A stage's result has to be written before the next stage starts, which removes
the tables that the stage before has left in the shared folder.

Null, empty and very long texts, ties, repeated rows, empty tables and extra
columns: as each operator's module states; a null ``doc_id`` stays through
stages 2 and 3.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierbook.llm import decontaminate, langmix, minhash, mixing, substring
from tierbook.llm.queries import table
from tierbook.llm.scratch import drop_paths, drop_scratch, mark, materialise, ship_code, small, written_since

MIN_GAIN = -1.0  # nats per trigram; short texts full of numbers and addresses lie around 0

_LEFT: list[str] = []  # tables that the last stage has left


def _unpacked(found: DataFrame, columns: list[str], **own) -> DataFrame:
    """The columns of ``columns``: those in ``own`` from there, the others from the struct ``rest``."""
    return found.select(*[(own[c] if c in own else F.col(f"rest.`{c}`")).alias(c) for c in columns])


def _stage(step: Callable) -> Callable:
    """``step`` with its code shipped and the last stage's tables removed."""

    @wraps(step)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_code(spark)
        drop_paths(spark, _LEFT, keep=docs)
        start = mark()
        try:
            return step(spark, docs, sf_dir)
        finally:
            _LEFT[:] = written_since(start)

    return run_stage


@_stage
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langmix.learn(docs)
    if not model[0] and not docs.isEmpty():
        raise ValueError("no labelled document to learn languages from")
    found = langmix.predict(docs, model).where((F.col("lang_pred") != langmix.UNDETERMINED) & (F.col("gain") > MIN_GAIN))
    return _unpacked(found, docs.columns, doc_id=F.col("id"), text=F.col("text"))


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # 96 bits tell rows apart by id and text; equal rows have equal keys
    def keyed(df: DataFrame, doc_id: str, row: Column, *also: str) -> DataFrame:
        id_ = F.col(doc_id).cast("long")
        return df.select(F.xxhash64(id_, row).alias("k1"), F.hash(id_, row).alias("k2"), *also)

    found = minhash.near_duplicates(docs.select("doc_id", "text"))
    flags = materialise(keyed(found, "id", F.col("row"), "kept"), "kept")
    keys = ["k1", "k2"]
    gone = flags.where("NOT kept").select(keys).distinct()
    repeated = materialise(flags.where("kept").groupBy(keys).count().where("count > 1").select(keys), "repeated")
    # texts move only where a row repeats another
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    whole = keyed(packed, "row.doc_id", F.xxhash64("row.text"), "row")
    once = whole.join(small(gone.union(repeated)), keys, "left_anti")
    one_of_each = whole.join(small(repeated), keys, "left_semi").dropDuplicates(keys)
    return once.unionByName(one_of_each).select("row.*")


@_stage
def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = substring.remove_repeated_windows(docs)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    own = {"doc_id": F.col("id"), "text": text}
    if "n_chars" in docs.columns:
        own["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept_text").cast("long")).otherwise(F.col("rest.n_chars"))
    return _unpacked(found, docs.columns, **own)


@_stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


@_stage
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs).select(F.col("id").alias("doc_id"), "source", "size", "source_size", "target", "copies", "taken")


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("substrings", substrings),
    ("decontamination", decontamination),
    ("mix", mix),
]

# The mixture inference, the choice of copies and the language model are no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, materialise(stage(spark, docs, sf_dir), f"stage-{name}")
        drop_scratch(before)
    return STAGES[-1][1](spark, docs, sf_dir)
