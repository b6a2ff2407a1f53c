"""Language-model scores: a hashed maximum-entropy model with a class-factored softmax.

Words (A-Z lower-cased) have a class and, within it, a subclass, ``CLASSES`` of
each, by digits of their hash; the end of a text is a word of its own. The
probability of a token factors into that of its class given the words before it,
that of its subclass given its class and the words before it, and that of the
word among those of its subclass. The first two are maximum-entropy models:
softmaxes whose features (a bias; the word before; the word before that, skipping
one; both together; for subclasses each with the class) are hashed into weight
vectors, so every word of every context has features, however rare. The last is
the smoothed share of the word in its subclass; all unseen words of a subclass
share one more count.

The hash space has as many slots as the training corpus has tokens, as a power
of two between ``MIN_SLOTS`` and ``MAX_SLOTS`` (8 MB of weights, which go along
with every task). Training: observed counts of all slots and digits over every
training token give the first weights, smoothed log ratios; then ``STEPS`` gradient
steps, each over another of as many parts of the training documents: together they
cover every one of them. A task sums
what the model expects over its tokens, densely, and sends it by ranges of slots;
Spark tasks add the ranges up, and the driver moves the weights by the difference
of observed and expected counts.

Word counts are one aggregation with partial sums per task. Scoring is one pass
in numpy batches; counts of words with a share of ``HEAD_SHARE`` or more (at most
1 / ``HEAD_SHARE`` words, whatever the corpus) go along with the tasks, all others
are joined by their hash.

Edge cases: null texts count as empty and consist of their end alone; rows
with a null id are never learned from; repeated rows are learned from and
scored each; with nothing to learn from classes are equally likely and
nothing is known; other columns are not looked at; an empty table gives an
empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .scratch import materialise, shuffle_partitions

CLASSES = 32
MIN_SLOTS, MAX_SLOTS = 1 << 12, 1 << 16
STEPS = 3
FEATURES = 4
HEAD_SHARE = 1e-6
PRIOR_COUNT = 8.0  # of the smoothed log ratios
FIRST_SCALE = 0.5  # of a feature's log ratio in the first weights: features overlap
RANGES = 32
TASKS_PER_CORE = 2
BLOCK_TOKENS = 1 << 12
WIDE_BLOCK_TOKENS = 1 << 16  # of the sums by slot: as many as there are slots
START = np.uint64(0x5354415254)  # the word before the first one
END = np.uint64(0x454E44)
_RESERVED = 1 + CLASSES  # slots of the biases


def _words(docs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the lower-cased words, each document's first word)."""
    buf, starts = tk.joined(docs)
    buf = tk.LOWER[buf]
    s, e = tk.word_spans(buf)
    return tk.word_hashes(buf, s, e), np.searchsorted(s, starts)


def sequences(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(token, the one before, the one before that, document) of all tokens, each document's end included."""
    size = np.diff(first)
    ends = np.cumsum(size + 1) - 1
    token = np.full(int(size.sum()) + len(size), END, dtype=np.uint64)
    is_word = np.ones(len(token), dtype=bool)
    is_word[ends] = False
    token[is_word] = hashes
    begin = ends - size
    one = np.concatenate([[START], token[:-1]])[: len(token)]
    one[begin] = START
    two = np.concatenate([[START], one[:-1]])[: len(token)]
    two[begin] = START
    return token, one, two, np.repeat(np.arange(len(size)), size + 1)


def digits(token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(class, subclass) of each token."""
    mixed = tk.mix(token ^ np.uint64(tk.BASE_B))
    bits = np.uint64(CLASSES.bit_length() - 1)
    return (mixed >> (np.uint64(64) - bits)).astype(np.int64), (mixed >> np.uint64(32) & np.uint64(CLASSES - 1)).astype(np.int64)


def slots_of(one: np.ndarray, two: np.ndarray, within: np.ndarray | None, slots: int) -> np.ndarray:
    """[token, feature]: the slots of a token's context (``within``: of the subclass, given the class)."""
    keys = [one + np.uint64(1), two * np.uint64(3) + np.uint64(2), tk.mix(one) * np.uint64(5) + two]
    given = np.zeros(len(one), dtype=np.uint64) if within is None else (within + 1).astype(np.uint64) * np.uint64(tk.BASE_A)
    hashed = [tk.mix(k ^ given) % np.uint64(slots - _RESERVED) + np.uint64(_RESERVED) for k in keys]
    bias = np.zeros(len(one), dtype=np.int64) if within is None else within + 1
    return np.stack([bias, *[h.astype(np.int64) for h in hashed]], axis=1)


def levels(token, one, two, slots: int):
    """Per level the slots and the digit of every token."""
    first, second = digits(token)
    yield slots_of(one, two, None, slots), first
    yield slots_of(one, two, first, slots), second


def _logits(weights: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Logits of every digit, less the largest."""
    columns = np.ascontiguousarray(at.T)
    logits = weights.take(columns[0], axis=0)
    for slot in columns[1:]:
        logits += weights.take(slot, axis=0)
    most = logits
    while most.shape[1] > 1:  # by halves: whole columns at a time
        half = most.shape[1] // 2
        most = np.maximum(most[:, :half], most[:, half:])
    logits -= most
    return logits


_ONES = np.ones((CLASSES, 1), dtype=np.float32)


def shares(weights: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The softmax over digits."""
    share = _logits(weights, at)
    np.exp(share, out=share)
    share /= share @ _ONES
    return share


def log_share(weights: np.ndarray, at: np.ndarray, digit: np.ndarray) -> np.ndarray:
    """The logarithm of one digit's share in it."""
    logits = _logits(weights, at)
    own = logits[np.arange(len(digit)), digit].astype(np.float64)
    return own - np.log((np.exp(logits, out=logits) @ _ONES)[:, 0])


def _word_counts(batches):
    for batch in batches:
        for part in tk.chunks(batch):
            word, n = np.unique(_words(tk.texts(part.column("text")))[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n.astype(np.int64))], names=["word", "n"])


def _ranges(table: np.ndarray) -> pa.RecordBatch:
    """A table of slots by ranges, compressed."""
    squeeze = zstandard.ZstdCompressor(level=1)
    parts = np.array_split(table, RANGES)
    blobs = [squeeze.compress(np.ascontiguousarray(p, dtype=np.float32).tobytes()) for p in parts]
    return pa.RecordBatch.from_arrays([pa.array(np.arange(RANGES, dtype=np.int32)), pa.array(blobs, pa.binary())], names=["range", "sums"])


def _blocks(batches, size: int = BLOCK_TOKENS):
    """The tokens of the documents, in blocks of bounded size."""
    for batch in batches:
        for part in tk.chunks(batch):
            token, one, two, _ = sequences(*_words(tk.texts(part.column("text"))))
            for at in range(0, len(token), size):
                cut = slice(at, at + size)
                yield token[cut], one[cut], two[cut]


def _observed(slots: int):
    """Arrow function: how often each slot meets each digit."""

    def run(batches):
        total = np.zeros(slots * CLASSES, dtype=np.int64)
        for block in _blocks(batches):
            for at, digit in levels(*block, slots):
                cell, n = np.unique((at * CLASSES + digit[:, None]).ravel(), return_counts=True)
                total[cell] += n
        yield _ranges(total.reshape(slots, CLASSES))

    return run


def _expected(weights: np.ndarray):
    """Arrow function: how often the model expects each slot to meet each digit."""

    def run(batches):
        total = np.zeros(weights.T.shape)  # by digit: a row of slots stays in the processor's cache
        for block in _blocks(batches, WIDE_BLOCK_TOKENS):
            for at, _ in levels(*block, len(weights)):
                share = np.empty((CLASSES, len(at)))
                for first in range(0, len(at), BLOCK_TOKENS):
                    cut = slice(first, first + BLOCK_TOKENS)
                    share[:, cut] = shares(weights, at[cut]).T
                for slot in np.ascontiguousarray(at.T):
                    if (slot == slot[0]).all():  # the bias of the class
                        total[:, slot[0]] += share.sum(axis=1)
                        continue
                    for digit in range(CLASSES):
                        total[digit] += np.bincount(slot, share[digit], minlength=len(weights))
        yield _ranges(total.T)

    return run


def _added(batches):
    """Arrow function over rows sorted by range: the sum of each range's tables."""
    spread, current, total = zstandard.ZstdDecompressor(), None, None

    def out():
        return pa.RecordBatch.from_arrays([pa.array([current], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["range", "sums"])

    for batch in batches:
        for key, blob in zip(batch.column("range").to_pylist(), batch.column("sums")):
            table = np.frombuffer(spread.decompress(blob.as_py()), dtype=np.float32).astype(np.float64)
            if key != current:
                if total is not None:
                    yield out()
                current, total = key, table
            else:
                total += table
    if total is not None:
        yield out()


def _summed(tables: DataFrame, slots: int) -> np.ndarray:
    """The sum over all tasks: added up range by range in Spark, at most ``MAX_SLOTS`` rows of ``CLASSES`` numbers here."""
    n = min(RANGES, shuffle_partitions(tables.sparkSession))
    dealt = tables.repartition(n, "range").sortWithinPartitions("range")
    rows = dealt.mapInArrow(_added, "`range` int, sums binary").collect()
    total = np.zeros((slots, CLASSES))
    parts = np.array_split(np.arange(slots), RANGES)
    for r in rows:
        total[parts[r["range"]]] = np.frombuffer(r["sums"]).reshape(-1, CLASSES)
    return total


def first_weights(observed: np.ndarray) -> np.ndarray:
    """Smoothed log ratios of what each slot has seen to what its level's digits are in all."""
    weights = np.zeros(observed.shape)
    whole = observed[:_RESERVED]
    share = (whole + 1) / (whole.sum(axis=1, keepdims=True) + CLASSES)
    weights[:_RESERVED] = np.log(share)
    n = observed.sum(axis=1, keepdims=True)
    usual = (observed[_RESERVED:].sum(axis=0) + 1) / (observed[_RESERVED:].sum() + CLASSES)
    ratio = (observed + PRIOR_COUNT * usual) / (n + PRIOR_COUNT) / usual
    weights[_RESERVED:] = FIRST_SCALE * np.log(ratio[_RESERVED:])
    return weights.astype(np.float32)


def train(texts: DataFrame, tokens: int, steps: int = STEPS) -> np.ndarray:
    """The weights [slot, digit], learned from ``texts`` (key, text)."""
    slots = min(MAX_SLOTS, max(MIN_SLOTS, 1 << max(tokens - 1, 1).bit_length()))
    # a task ends in a table of all slots: a few tasks a core, not one for each small file
    texts = texts.coalesce(TASKS_PER_CORE * texts.sparkSession.sparkContext.defaultParallelism)
    observed = _summed(texts.select("text").mapInArrow(_observed(slots), "`range` int, sums binary"), slots)
    weights = first_weights(observed)
    if not observed.any():
        return weights
    for step in range(steps):
        some = texts.where(F.pmod("key", F.lit(steps)) == step).select("text")
        expected = _summed(some.mapInArrow(_expected(weights), "`range` int, sums binary"), slots)
        seen = expected[0].sum()  # its tokens: the bias of the class meets each once
        if seen:
            expected *= observed[0].sum() / seen
            weights = (weights + (observed - expected) / (np.maximum(observed, expected) + PRIOR_COUNT) / FEATURES).astype(np.float32)
    return weights


@dataclass
class Model:
    weights: np.ndarray
    words: np.ndarray  # hashes of the frequent words, sorted
    counts: np.ndarray  # and their counts
    leaf: np.ndarray  # by class and subclass: tokens, words and one
    end: float  # texts learned from


def _scores(model: Model):
    log_leaf = np.log10(model.leaf)

    def run(batches):
        for batch in batches:
            for part in tk.chunks(batch):
                hashes, first = _words(tk.texts(part.column("text")))
                n_docs = part.num_rows
                token, one, two, doc = sequences(hashes, first)
                score = np.zeros(n_docs)
                for at in range(0, len(token), BLOCK_TOKENS):
                    cut = slice(at, at + BLOCK_TOKENS)
                    for slot, digit in levels(token[cut], one[cut], two[cut], len(model.weights)):
                        own = log_share(model.weights, slot, digit)
                        score += np.bincount(doc[cut], own / np.log(10), minlength=n_docs)
                major, minor = digits(token)
                score -= np.bincount(doc, log_leaf[major, minor], minlength=n_docs)
                word_doc = np.repeat(np.arange(n_docs), np.diff(first))
                place = np.minimum(np.searchsorted(model.words, hashes), max(len(model.words) - 1, 0))
                head = (model.words[place] == hashes) if len(model.words) else np.zeros(len(hashes), dtype=bool)
                more = np.bincount(word_doc[head], np.log10(model.counts[place[head]] + 1) if head.any() else None, minlength=n_docs) + np.log10(model.end + 1)
                known = np.bincount(word_doc[head], minlength=n_docs) + int(model.end > 0)
                # the tail: each document's distinct words with their numbers
                tail = np.flatnonzero(~head)
                order = tail[np.lexsort((hashes[tail], word_doc[tail]))]
                h, d = hashes[order], word_doc[order]
                new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (d[1:] != d[:-1])])) if len(order) else order
                times = np.diff(np.append(new, len(order)))
                offsets = np.searchsorted(d[new], np.arange(n_docs + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        pa.array(np.diff(first).astype(np.int64) + 1),
                        pa.array(known.astype(np.int64)),
                        pa.array(more.astype(np.float64)),
                        pa.array(score),
                        pa.ListArray.from_arrays(offsets, pa.array(h[new].view(np.int64))),
                        pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32))),
                    ],
                    names=["id", "n_tokens", "known", "base", "model", "words", "times"],
                )

    return run


def learn(texts: DataFrame) -> tuple[Model, DataFrame, int, int]:
    """(model, all words' counts, tokens, distinct tokens) of ``texts`` (key, text)."""
    counts = texts.select("text").mapInArrow(_word_counts, "word long, n long").groupBy("word").agg(F.sum("n").alias("c"))
    vocabulary = materialise(counts, "vocabulary")
    ends = texts.count()
    words, tokens = vocabulary.agg(F.count("*"), F.coalesce(F.sum("c"), F.lit(0))).first()
    total = tokens + ends
    head = vocabulary.where(F.col("c") >= HEAD_SHARE * total).toArrow()
    order = np.argsort(head.column("word").to_numpy().view(np.uint64))
    leaf = np.ones((CLASSES, CLASSES))
    per_leaf = vocabulary.mapInArrow(_leaves, "leaf int, n long").groupBy("leaf").agg(F.sum("n").alias("n")).collect()  # a row per subclass
    for r in per_leaf:
        leaf[divmod(r["leaf"], CLASSES)] += r["n"]
    if ends:
        major, minor = digits(np.array([END]))
        leaf[major[0], minor[0]] += ends + 1
    frequent = head.column("word").to_numpy().view(np.uint64)[order], head.column("c").to_numpy()[order].astype(np.float64)
    return Model(train(texts, total), *frequent, leaf, float(ends)), vocabulary, total, words + (ends > 0)


def _leaves(batches):
    """Arrow function: (word, c) to each subclass's tokens and words, added."""
    total = np.zeros(CLASSES * CLASSES, dtype=np.int64)
    for batch in batches:
        major, minor = digits(batch.column("word").to_numpy().view(np.uint64))
        at = major * CLASSES + minor
        total += np.bincount(at, batch.column("c").to_numpy() + 1, minlength=len(total)).astype(np.int64)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["leaf", "n"])


def score(docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id, n_tokens, n_known, train_tokens, base_score``
    (smoothed unigrams) and ``score`` (the model), both log10 of the whole text.

    ``training``: a boolean column of ``docs``, the rows to learn from.
    """
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.coalesce(training, F.lit(False)).alias("train"))
    learned = source.where("train").select(F.xxhash64("id").alias("key"), "text")
    model, vocabulary, total, distinct = learn(learned)
    schema = "id long, n_tokens long, known long, base double, model double, words array<long>, times array<int>"
    scored = source.select("id", "text").mapInArrow(_scores(model), schema).withColumn("row", F.monotonically_increasing_id())
    scored = materialise(scored, "scored")
    tail = scored.select("row", F.explode(F.arrays_zip("words", "times")).alias("w")).select("row", F.col("w.words").alias("word"), F.col("w.times").alias("times"))
    rare = vocabulary.where(F.col("c") < HEAD_SHARE * total).select("word", "c")
    found = tail.join(rare, "word").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("more"), F.sum("times").alias("more_known")
    )
    more = F.col("base") + F.coalesce("more", F.lit(0.0))
    return scored.join(found, "row", "left").select(
        "id",
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (more - F.col("n_tokens") * float(np.log10(total + distinct + 1))).alias("base_score"),
        (F.col("model") + more).alias("score"),
    )
