"""Toxicity by non-negative positive-unlabelled learning.

Only confirmed toxic documents teach a class; all other text is unlabelled, a
mixture of both classes in which toxic documents have the share ``prior``. A
linear classifier over hashed words is fitted with numpy to the risk estimate
``prior R_p+ + max(0, R_u- - prior R_p-)``: the unlabelled risk as negatives is
corrected by what its hidden positives add, and where the corrected part of a
mini-batch falls below zero its gradient is reversed, which stops the
classifier from fitting single documents. The loss is the sigmoid one: it is
bounded, so that documents which are told apart already don't drive the corrected
risk below zero. The score is the sigmoid of the margin; 0.5 or more is toxic.

Features: the share of documents that hold each of ``SLOTS`` hashed words is
counted over all training documents; the ``FEATURES`` slots whose share among
the positives exceeds that by most standard errors are used, present or absent.

Stems: a word that is no feature, such as a form that no confirmed document
holds, counts by its first bytes (the longest of ``STEMS`` that has a weight). As
confirmed documents are a sample of the toxic ones, the toxic share of the
documents with a stem is estimated by ``(confirmed with it / all with it) /
(confirmed / (all * prior))``; a stem has a weight where that share, less
``STEM_ERRORS`` standard errors, exceeds one half. Alone it gives its document
that share as the score.

Bounds: the classifier is fitted on at most ``POSITIVES`` confirmed documents
and ``UNLABELLED`` others, chosen by the hash of their id; their words are read
from the whole texts and only the chosen features reach the driver. Everything
else (word shares, scoring) covers all documents, in one pass without a
shuffle of texts. The prior is the share of toxic documents among the labelled,
and ``PRIOR_ERRORS`` standard errors: one that is too small makes the estimate
count hidden positives as negatives, so that a whole group of them is given up.

Edge cases: null and empty texts have no features and get the score of the
bias; a document with several labels is toxic if any says so, null labels say
nothing; repeated rows are scored each; without a confirmed document every score
is 0; an empty table gives an empty result; other columns are kept in ``rest``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .scratch import packed_rest

SLOTS = 1 << 18
FEATURES = 2048
POSITIVES = 10_000
UNLABELLED = 20_000
MIN_ERRORS = 3.0
MIN_POSITIVES = 3
PRIOR_ERRORS = 2.0
STEMS = (5, 6)  # bytes
STEM_SLOTS = 1 << 20  # of each length: a clean word that falls into a toxic stem's slot would count
STEM_ERRORS = 2.0
STEM_POSITIVES = 10
STEM_SHARE = 0.95  # at most
STEPS = 400
BATCH = 1000  # positives in a mini-batch: the corrected risk of few documents is mostly noise
RATE = 0.1
DECAY = 2e-5
SEED = 13

_LETTER = np.zeros(256, dtype=bool)
_LETTER[np.r_[48:58, 65:91, 97:123, 128:256]] = True


def _words(docs: list[bytes], slots: int, stems: tuple[int, ...]) -> tuple[np.ndarray, list[np.ndarray]]:
    """The document of each word (letters and digits, lower-cased within ASCII), and the words' slots, then the slots
    of their first bytes of each length in ``stems`` (-1: the word is shorter). Each length has ``STEM_SLOTS`` slots of its own, after the words'."""
    buf, starts = tk.joined(docs)
    buf = tk.LOWER[buf]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], _LETTER[buf]]).astype(np.int8)))
    s, e = edge[0::2], edge[1::2]
    poly, found = tk.Poly(buf), []
    found.append((tk.mix(poly.ranges(s, e)) % np.uint64(slots)).astype(np.int64))
    for kind, length in enumerate(stems):
        slot = (tk.mix(poly.ranges(s, np.minimum(s + length, e))) % np.uint64(STEM_SLOTS)).astype(np.int64)
        found.append(np.where(e - s >= length, slots + kind * STEM_SLOTS + slot, -1))
    return np.searchsorted(starts, s, side="right") - 1, found


def _distinct(doc: np.ndarray, slot: np.ndarray, slots: int) -> tuple[np.ndarray, np.ndarray]:
    pair = np.unique(doc * slots + slot)
    return pair // slots, pair % slots


def word_slots(docs: list[bytes], slots: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, slot) of each distinct word of each document."""
    doc, (slot,) = _words(docs, slots, ())
    return _distinct(doc, slot, slots)


def _shares(slots: int, stems: tuple[int, ...]):
    """Arrow function: texts to (slot, documents that hold it), summed over the task; slot -1 counts documents."""

    def run(batches):
        size = slots + len(stems) * STEM_SLOTS
        total, rows = np.zeros(size, dtype=np.int64), 0
        for batch in batches:
            for part in tk.chunks(batch):
                rows += part.num_rows
                doc, kinds = _words(tk.texts(part.column("text")), slots, stems)
                for slot in kinds:
                    held, n = np.unique(_distinct(doc[slot >= 0], slot[slot >= 0], size)[1], return_counts=True)
                    total[held] += n
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([[-1], at]).astype(np.int32)), pa.array(np.concatenate([[rows], total[at]]))], names=["slot", "n"]
        )

    return run


def _features(index: np.ndarray):
    """Arrow function: (key, positive, text) to (key, positive, features), ``index`` mapping slots to features (-1: none)."""

    def run(batches):
        for batch in batches:
            for part in tk.chunks(batch):
                doc, slot = word_slots(tk.texts(part.column("text")), len(index))
                used = index[slot] >= 0
                found = pa.array(index[slot[used]].astype(np.int32))
                ends = np.concatenate([[0], np.cumsum(np.bincount(doc[used], minlength=part.num_rows))]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), found)
                yield pa.RecordBatch.from_arrays([part.column("positive"), lists], names=["positive", "features"])

    return run


def shares(docs: DataFrame, slots: int = SLOTS, stems: tuple[int, ...] = STEMS) -> tuple[np.ndarray, int]:
    """How many of ``docs`` (text) hold a word of each slot, then a stem of each slot of each length; and their number."""
    rows = docs.select("text").mapInArrow(_shares(slots, stems), "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    slot, n = rows.column("slot").to_numpy(), rows.column("n").to_numpy()
    total = np.zeros(slots + len(stems) * STEM_SLOTS, dtype=np.int64)
    total[slot[slot >= 0]] = n[slot >= 0]
    return total, int(n[slot < 0].sum())


def choose(positive: np.ndarray, n_positive: int, everywhere: np.ndarray, n: int, features: int = FEATURES) -> np.ndarray:
    """Index from slots to features (-1: unused): slots more frequent among positives by the most standard errors."""
    share = np.clip(everywhere / max(n, 1), 0.5 / max(n, 1), 1)
    error = np.sqrt(np.maximum(share * (1 - share), 1e-12) / max(n_positive, 1))
    z = (positive / max(n_positive, 1) - share) / error
    z[(positive < MIN_POSITIVES) | (z < MIN_ERRORS)] = 0
    best = np.argsort(-z, kind="stable")[:features]
    best = best[z[best] > 0]
    index = np.full(len(positive), -1, dtype=np.int64)
    index[best] = np.arange(len(best))
    return index


def stem_weights(positive: np.ndarray, n_positive: int, everywhere: np.ndarray, n: int, prior: float, bias: float) -> np.ndarray:
    """The weight of each stem's slot, 0 where the toxic share of its documents is not surely above one half."""
    labelled = n_positive / (n * prior)  # of the toxic documents, those that are confirmed
    each = 1 / np.maximum(everywhere * labelled, 1e-9)
    low = (positive - STEM_ERRORS * np.sqrt(positive)) * each
    share = np.clip(positive * each, 0.5, STEM_SHARE)
    return np.where((positive >= STEM_POSITIVES) & (low > 0.5), np.log(share / (1 - share)) - bias, 0)


class Sparse:
    """Rows of present features."""

    def __init__(self, lists: list):
        size = np.array([len(x) for x in lists], dtype=np.int64)
        self.ends = np.concatenate([[0], np.cumsum(size)])
        self.flat = np.concatenate([np.asarray(x, dtype=np.int64) for x in lists]) if size.sum() else np.zeros(0, np.int64)

    def rows(self, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row within ``pick``, feature) of the picked rows."""
        size = self.ends[pick + 1] - self.ends[pick]
        return np.repeat(np.arange(len(pick)), size), self.flat[tk.gather_ranges(self.ends[pick], size)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def risk_gradient(weights: np.ndarray, p: tuple, n_p: int, u: tuple, n_u: int, prior: float) -> tuple[float, float, np.ndarray]:
    """(positive part, corrected negative part, gradient) of the non-negative risk on one mini-batch.

    ``weights`` ends in the bias; ``p`` and ``u`` are (row, feature) pairs. Where
    the corrected part is negative only its reversed gradient counts.
    """

    def margins(x, n):
        return weights[-1] + np.bincount(x[0], weights=weights[x[1]], minlength=n)

    def back(x, slope):
        g = np.bincount(x[1], weights=slope[x[0]], minlength=len(weights)).astype(np.float64)
        g[-1] += slope.sum()
        return g

    sp, su = _sigmoid(margins(p, n_p)), _sigmoid(margins(u, n_u))
    plus = prior * (1 - sp).mean()
    minus = su.mean() - prior * sp.mean()
    g_positive = prior * back(p, sp * (1 - sp) / n_p)
    g_minus = back(u, su * (1 - su) / n_u) - g_positive
    if minus < 0:
        return plus, minus, -g_minus
    return plus, minus, g_minus - g_positive


def fit(positive: Sparse, n_p: int, unlabelled: Sparse, n_u: int, features: int, prior: float) -> np.ndarray:
    """Weights (the bias last), by Adam over mini-batches of both sets."""
    rng = np.random.default_rng(SEED)
    weights = np.zeros(features + 1)
    weights[-1] = np.log(prior / (1 - prior))
    first, second, step = np.zeros_like(weights), np.zeros_like(weights), 0
    batches = max(1, min(n_p, n_u) // BATCH)
    for _ in range(-(-STEPS // batches)):
        for p, u in zip(np.array_split(rng.permutation(n_p), batches), np.array_split(rng.permutation(n_u), batches)):
            _, _, g = risk_gradient(weights, positive.rows(p), len(p), unlabelled.rows(u), len(u), prior)
            g[:-1] += DECAY * weights[:-1]
            step += 1
            first += 0.1 * (g - first)
            second += 0.001 * (g * g - second)
            weights -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return weights


def learn(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    positives: int = POSITIVES, unlabelled: int = UNLABELLED, slots: int = SLOTS, features: int = FEATURES,
) -> np.ndarray | None:
    """A weight per slot of words, then of stems, and the bias, learned from ``docs`` and the ``labels`` (id, 1 where toxic) of their ids; None without a toxic one."""
    source = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text"))
    ids = source.select("key").where("key IS NOT NULL").distinct()
    marks = labels.select(F.col(id_col).alias("key"), F.col(label_col).alias("label")).where("key IS NOT NULL AND label IS NOT NULL")
    marks = marks.groupBy("key").agg(F.max("label").alias("label")).join(ids, "key", "left_semi")
    toxic, labelled = marks.agg(F.count_if(F.col("label") == 1), F.count("*")).first()
    if not toxic:
        return None
    share = toxic / labelled
    prior = float(np.clip(share + PRIOR_ERRORS * np.sqrt(share * (1 - share) / labelled), 1e-3, 0.5))
    # both are bounded by their limits, so that they may be broadcast
    some = marks.where("label = 1").orderBy(F.xxhash64("key"), "key").limit(positives)
    mixture = ids.orderBy(F.xxhash64("key", F.lit(1)), "key").limit(unlabelled)
    chosen = some.select("key", F.lit(True).alias("positive")).unionByName(mixture.select("key", F.lit(False).alias("positive")))
    picked = source.join(F.broadcast(chosen), "key").select("positive", "text")
    everywhere, n = shares(source, slots)
    seen, n_seen = shares(picked.where("positive"), slots)
    index = choose(seen[:slots], n_seen, everywhere[:slots], n, features)
    rows = picked.mapInArrow(_features(index), "positive boolean, features array<int>").toArrow()
    flags = rows.column("positive").to_numpy()
    lists = rows.column("features").to_pylist()
    order = sorted(range(len(lists)), key=lambda i: (len(lists[i]), lists[i]))  # whatever order tasks returned them in
    p = [lists[i] for i in order if flags[i]]
    u = [lists[i] for i in order if not flags[i]]
    if not p or not u:
        return None
    count = int(index.max()) + 1
    weights = fit(Sparse(p), len(p), Sparse(u), len(u), count, prior)
    table = np.zeros(len(seen) + 1, dtype=np.float32)
    table[:slots][index >= 0] = weights[index[index >= 0]]
    table[slots:-1] = stem_weights(seen[slots:], n_seen, everywhere[slots:], n, prior, weights[-1])
    table[-1] = weights[-1]
    return table


def counted(docs: list[bytes], table: np.ndarray, stems: tuple[int, ...] = STEMS) -> tuple[np.ndarray, np.ndarray]:
    """(document, slot) of what counts in each document, once: its words that have a weight, for others their longest stem that has."""
    doc, (slot, *shorter) = _words(docs, len(table) - 1 - len(stems) * STEM_SLOTS, stems)
    for other in reversed(shorter):
        slot = np.where((table[slot] == 0) & (other >= 0), other, slot)
    has = table[slot] != 0
    return _distinct(doc[has], slot[has], len(table))


def _score(table: np.ndarray | None):
    def run(batches):
        for batch in batches:
            for part in tk.chunks(batch):
                score = np.zeros(part.num_rows)
                if table is not None:
                    doc, slot = counted(tk.texts(part.column("text")), table)
                    score = _sigmoid(float(table[-1]) + np.bincount(doc, weights=table[slot], minlength=part.num_rows))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(score), part.column("rest")], names=["id", "score", "rest"]
                )

    return run


def score(docs: DataFrame, table: np.ndarray | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id``, ``score`` (0 to 1), ``predicted`` (1 from 0.5 on) and all other columns in the struct ``rest``."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), packed_rest(docs, id_col, text_col).alias("rest"))
    kinds = {f.name: f.dataType.simpleString() for f in source.schema}
    found = source.mapInArrow(_score(table), f"id {kinds['id']}, score double, rest {kinds['rest']}")
    return found.select("id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "rest")
