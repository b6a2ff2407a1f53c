"""Approximate nearest neighbours with a permutation index.

A vector is represented by the order of its nearest pivots (a permutation).
It is posted in the inverted file of its nearest pivot; a query reads the
files of its ``PROBES`` nearest pivots, ranks their vectors by the footrule
distance between permutations (the sum of the differences of each pivot's
rank), keeps the nearer share and reranks it exactly: inner products in
double precision on the original vectors. Inner products become distances by
one added component, the root of the largest squared norm less the own one.

Files are kept in blocks of bounded size: a file, or a part of a long one
(split by a hash of the id), belongs to one block; each part of the queries
meets each block once and returns its ``k`` best, so rows grow with queries
times blocks. The pivots are a bounded sample (the ``PIVOTS`` vectors of
smallest id hash); every vector is posted. Queries whose files hold fewer
than ``k`` vectors read all files in a second pass, so each gets ``k``
neighbours, or all there are.

Edge cases: vectors that are null, empty, zero or hold null or non-finite
components take no part, nor do those whose length isn't the most frequent
one, nor rows with a null id; equal scores are ordered by id; rows with the
query's own id are never its neighbours; of rows with one id the best counts;
an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .scratch import materialise

PIVOTS = 256
PROBES = 176
SHARE = 0.4
NEIGHBOURS = 20
SHELVES = 16
BLOCK_ROWS = 4096
QUERY_ROWS = 8192
_KEEP_AT_LEAST = 3  # times the neighbours


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector as doubles) of the vectors that take part."""
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    found = (
        vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
        .where(F.col("id").isNotNull() & F.col("vector").isNotNull())
        .where(finite & F.exists("vector", lambda x: x != 0))
    )
    usual = found.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return found.where(F.size("vector") == (usual["n"] if usual else 0))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def _orders(x: np.ndarray, lift: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Each vector's pivots from the nearest on."""
    return np.argsort(-(np.column_stack([x, lift]) @ pivots.T), axis=1, kind="stable").astype(np.int16)


def _ranks(orders: np.ndarray) -> np.ndarray:
    ranks = np.empty_like(orders)
    np.put_along_axis(ranks, orders, np.broadcast_to(np.arange(orders.shape[1], dtype=orders.dtype), orders.shape), axis=1)
    return ranks


def _lift(x: np.ndarray, largest: float) -> np.ndarray:
    return np.sqrt(np.maximum(0, largest - (x * x).sum(axis=1)))


def _assign(pivots: np.ndarray, largest: float):
    """Arrow function: each vector with its nearest pivot."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("vector"), pivots.shape[1] - 1)
                nearest = _orders(x, _lift(x, largest), pivots)[:, 0]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("vector"), pa.array(nearest.astype(np.int32))], names=["id", "vector", "pivot"]
                )

    return run


def _search(pivots: np.ndarray, largest: float, probes: int, share: float, k: int):
    """Cogrouped Arrow function: one part of the queries against one block of the inverted files."""

    def run(posts: pa.Table, queries: pa.Table) -> pa.Table:
        found_q, found_v, found_s = [], [], []
        if posts.num_rows and queries.num_rows:
            posts = posts.combine_chunks().sort_by([("pivot", "ascending"), ("id", "ascending")])
            dims = pivots.shape[1] - 1
            x = _matrix(posts.column("vector").combine_chunks(), dims)
            ids, file = posts.column("id").to_numpy(), posts.column("pivot").to_numpy()
            ranks = _ranks(_orders(x, _lift(x, largest), pivots))
            own = queries.column("id").to_numpy()
            q = _matrix(queries.column("vector").combine_chunks(), dims)
            q_orders = _orders(q, np.zeros(len(q)), pivots)
            q_ranks = _ranks(q_orders)
            for i in range(len(q)):
                near = np.zeros(len(pivots), dtype=bool)
                near[q_orders[i, :probes]] = True
                at = np.flatnonzero(near[file] & (ids != own[i]))
                if not len(at):
                    continue
                keep = max(_KEEP_AT_LEAST * k, int(np.ceil(share * len(at))))
                if keep < len(at):
                    footrule = np.abs(ranks[at] - q_ranks[i]).sum(axis=1, dtype=np.int32)
                    # ties by id: a file's rows lie in the order of ids
                    at = at[np.lexsort((ids[at], footrule))[:keep]]
                score = (x[at] * q[i]).sum(axis=1)
                best = np.lexsort((ids[at], -score))[:k]
                found_q.append(np.full(len(best), own[i]))
                found_v.append(ids[at][best])
                found_s.append(score[best])
        columns = [np.concatenate(c) if c else np.zeros(0) for c in (found_q, found_v, found_s)]
        return pa.table({"query_id": columns[0].astype(np.int64), "vec_id": columns[1].astype(np.int64), "score": columns[2].astype(np.float64)})

    return run


def _rounds(posts: DataFrame, queries: DataFrame, search, k: int) -> DataFrame:
    """The ``k`` best of each query over all blocks."""
    shelf = F.pmod(F.col("pivot"), F.lit(SHELVES))
    sizes = {r["shelf"]: r["count"] for r in posts.groupBy(shelf.alias("shelf")).count().collect()}  # SHELVES rows at most
    parts = max(1, -(-queries.count() // QUERY_ROWS))
    salts = F.create_map(*[F.lit(v) for s, n in sizes.items() for v in (s, -(-n // BLOCK_ROWS))])
    blocks = [F.struct(F.lit(s).alias("shelf"), F.lit(i).alias("salt")) for s, n in sizes.items() for i in range(-(-n // BLOCK_ROWS))]
    dealt_posts = posts.select(
        "id", "vector", "pivot", shelf.alias("shelf"), F.pmod(F.xxhash64("id"), salts[shelf]).cast("int").alias("salt"),
        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"),
    )
    dealt_queries = queries.select(
        "id", "vector", F.pmod(F.hash("id"), F.lit(parts)).alias("part"), F.explode(F.array(*blocks)).alias("block")
    ).select("id", "vector", "part", "block.shelf", "block.salt")
    keys = ["shelf", "salt", "part"]
    found = (
        dealt_posts.groupBy(*keys).cogroup(dealt_queries.groupBy(*keys)).applyInArrow(search, "query_id long, vec_id long, score double")
        .groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def nearest(
    vectors: DataFrame,
    is_query,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = NEIGHBOURS,
    pivots: int = PIVOTS,
    probes: int = PROBES,
    share: float = SHARE,
) -> DataFrame:
    """``query_id, rank`` (from 1), ``vec_id, score`` of the ``k`` nearest found for
    each vector that ``is_query`` (a function of the id column) selects."""
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    known = materialise(usable(vectors, id_col, vector_col), "vectors")
    sample = known.orderBy(F.xxhash64("id"), "id").limit(pivots).collect()
    if not sample:
        return spark.createDataFrame([], schema)
    square = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    largest = known.agg(F.max(square)).first()[0]
    x = np.array([r["vector"] for r in sample])
    lifted = np.column_stack([x, _lift(x, largest)])
    posts = materialise(known.mapInArrow(_assign(lifted, largest), "id long, vector array<double>, pivot int"), "posts")
    queries = known.where(is_query(F.col("id"))).dropDuplicates(["id"])
    found = materialise(_rounds(posts, queries, _search(lifted, largest, probes, share, k), k), "found")
    enough = min(k, known.select("id").distinct().count() - 1)
    few = queries.join(found.groupBy("query_id").count().where(F.col("count") >= enough), F.col("id") == F.col("query_id"), "left_anti")
    few = materialise(few, "few")
    if not few.isEmpty():
        again = _rounds(posts, few, _search(lifted, largest, len(lifted), 1.0, k), k)
        found = found.join(few.select(F.col("id").alias("query_id")), "query_id", "left_anti").unionByName(again)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
