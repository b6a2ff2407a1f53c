"""Benchmark decontamination by size-partitioned MinHash containment search.

An item is found in a document that holds at least ``PERCENT`` percent of its
distinct shingles: runs of ``SHINGLE`` words, of an item with fewer words the run
of all its words, wherever it stands in the document.

Items are partitioned by the number ``q`` of their shingles, in powers of two. An
item is represented by its MinHash bottom sketch, the smallest
``floor(q * (100 - PERCENT) / 100) + t`` of its shingle hashes, where ``t`` is
its partition's: 1 for short items, more for longer ones. A document that holds
enough of the item lacks at most all of these but ``t``, so it shares ``t`` or
more: within its partition an item is searched for by that many collisions,
and the search misses nothing, however long the document. A document posts only
shingle hashes up to the largest of any sketch. Found pairs are confirmed by
containment on the whole shingle sets.

Everything is DataFrame operations. Documents are neither shuffled nor
collected: sketches, the ids of documents with enough collisions and the items'
sets are broadcast as long as a measurement of rows and bytes allows it
(``scratch.small``), and joined by a shuffle beyond it, with the same result. A passage in a third of
all documents gives a row per document and item. Documents are read once per
length of shingles that some item asks for (once if none is shorter than ``SHINGLE`` words).

Edge cases: texts without words hold nothing and are held nowhere; rows with one
id are judged each by its own text, null ids too; repeated items are reported
each; other columns are not looked at, and ``clean`` keeps them whatever their
names; empty tables give an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .native import lower_words, with_shingles
from .scratch import materialise, small

SHINGLE = 5
PERCENT = 75


def sketches(items: DataFrame, percent: int) -> DataFrame:
    """(item, q, partition, needed, hash): the bottom sketch of each item of ``items``
    (item, shingles), and how many of it a document has to share."""
    q = F.size("shingles")
    partition = F.ceil(F.log2(q)).cast("int")
    needed = F.greatest(F.lit(1), F.floor(F.pow(F.lit(2.0), partition - 1) / 8)).cast("int")
    sized = items.select("item", q.alias("q"), partition.alias("partition"), needed.alias("needed"), F.explode("shingles").alias("hash"))
    rank = F.row_number().over(Window.partitionBy("item").orderBy("hash"))
    kept = sized.withColumn("rank", rank).where(F.col("rank") <= F.floor(F.col("q") * (100 - percent) / 100) + F.col("needed"))
    return kept.drop("rank")


def _search(source: DataFrame, items: DataFrame, words, size: int, percent: int) -> DataFrame:
    """(id, key, item, item_id, n_item, n_common) by shingles of ``size`` words; ``items``: item, item_id, all."""
    item_sets = materialise(items.select("item", "item_id", F.array_distinct("all").alias("own")), "items")
    sketch = materialise(sketches(item_sets.select("item", F.col("own").alias("shingles")).dropDuplicates(["item"]), percent), "sketches")
    highest = sketch.agg(F.max("hash")).first()[0]

    def shingled(df: DataFrame) -> DataFrame:
        return with_shingles(df, words(F.col("text")), size, "shingles").drop("text")

    low = F.array_distinct(F.filter("shingles", lambda h: h <= F.lit(highest)))
    posted = shingled(source).select("id", "key", F.explode_outer(low).alias("hash")).drop("id")
    hit = posted.join(small(sketch.select("hash", "item", "partition", "needed")), "hash")
    # rows with one id and text collide alike, so that their number divides out
    counted = hit.groupBy("key", "partition", "item").agg(F.count_distinct("hash").alias("n"), F.first("needed").alias("needed"))
    found = materialise(counted.where("n >= needed").select("key", "item"), "found")
    held = shingled(source.join(small(found.select("key").distinct()), "key"))
    pairs = held.join(small(found), "key").join(small(item_sets), "item")
    common = F.size(F.array_intersect("shingles", "own")).cast("long")
    return pairs.select("id", "key", "item", "item_id", F.size("own").cast("long").alias("n_item"), common.alias("n_common")).where(
        100 * F.col("n_common") >= percent * F.col("n_item")
    )


def search(source: DataFrame, items: DataFrame, words, size: int, percent: int) -> DataFrame:
    """``_search`` for items (item, item_id, text) of every length: those with fewer words than ``size`` by runs of their own."""
    count = F.least(F.size(F.array_remove(words(F.col("text")), "")), F.lit(size)).alias("width")
    sized = materialise(items.select("item", "item_id", "text", count).where("width > 0"), "sized")
    widths = sorted((r["width"] for r in sized.select("width").distinct().collect()), reverse=True)  # ``size`` rows at most
    parts = []
    for width in widths or [size]:
        own = with_shingles(sized.where(F.col("width") == width), words(F.col("text")), width, "all").drop("text")
        parts.append(_search(source, own, words, width, percent))
    return reduce(DataFrame.unionByName, parts)


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    size: int = SHINGLE,
    percent: int = PERCENT,
) -> DataFrame:
    """``id, key, item_id, n_item, n_common, containment`` of every document and
    item it holds; ``key`` is the hash of the document's id and text."""
    numbered = items.select(
        F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text"), F.xxhash64(item_col, item_text_col).alias("item")
    )
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(id_col, text_col).alias("key"))
    found = search(source, numbered, lower_words, size, percent)
    return found.select("id", "key", "item_id", "n_item", "n_common", (F.col("n_common") / F.col("n_item")).alias("containment"))


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that hold an item."""
    found = materialise(contaminated(docs, items, id_col, text_col, **options).select("key").distinct(), "contaminated")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    keyed = docs.select(row, F.xxhash64(id_col, text_col).alias("key"))
    return keyed.join(small(found), "key", "left_anti").select("row.*")
