"""Phrase collocation mining over a prefix-free parse.

Texts are lower-cased within ASCII; punctuation and line ends part them into
pieces, pieces into words. A pair of neighbouring words of a piece whose hash is
divisible by ``TRIGGER`` is a *trigger*. A text is parsed into chunks that reach
from its start or a trigger to the end of the next trigger or of the text, so
that neighbouring chunks overlap by the two words of the trigger, and equal
passages parse into equal chunks wherever they lie. The parse is kept as a
dictionary: each distinct chunk with its number of occurrences. N-grams of up
to three words are counted inside distinct chunks only, weighted by the
chunk's frequency; one that starts inside the overlap belongs to the next
chunk, so each is counted once. Only a chunk that ends its text (``closed``)
counts the n-grams that start in its last two words.

Words are counted first, then the pairs of frequent words, then the triples of
frequent pairs: a phrase with a count of ``MIN_COUNT`` holds no rarer part. The
frequent ones reach the tasks as a Bloom filter of at most ``FILTER_BITS``
bits; what it lets through by mistake costs a row and no more.

Phrases of two or three words with a count of ``MIN_COUNT`` or more are
scored by their weakest cut, ``1000000 a^2 / (l r)`` in exact decimals (38
digits: counts up to 10^16). A phrase that a longer candidate holds with at
least half of its count is dropped. ``top`` best phrases per language remain.

Scale: the dictionary is one aggregation of chunk strings, the counts one of
n-grams per length, all combined before the shuffle, so that a very frequent
phrase is a few rows per task. Counts of the parts are joined by broadcast up to a checked
size, beyond it by a salted join. The best of a language are chosen in
``SALTS`` parts first, as one language may hold nearly all phrases.

Edge cases: null texts count as empty, null languages as ``und``; repeated
rows count each; a text without words gives nothing; of equal scores the
larger count, then the smaller phrase (UTF-8 bytes) comes first; an empty
table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import left_join_dimension
from . import textkit as tk
from .scratch import materialise

TRIGGER = 16
OVERLAP = 2
LONGEST = 3
MIN_COUNT = 10
SWALLOWED_PERCENT = 50
TOP = 2000
FILTER_BITS = 1 << 28
BITS_PER_KEY = 16
SALTS = 32
BROADCAST_ROWS = 200_000
UNDETERMINED = "und"
ALL_WORDS = ""  # no word: its count is the number of all words

_BREAK = np.zeros(256, dtype=bool)
_BREAK[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_GAP = _BREAK.copy()
_GAP[[0x20, 0x09]] = True


def _spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a buffer that ends in a break."""
    edge = np.flatnonzero(np.diff(np.concatenate([[True], _GAP[buf]]).astype(np.int8)))
    return edge[0::2], edge[1::2]


def _strings(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> pa.Array:
    """The byte ranges of ``data`` as an array of strings."""
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    body = np.ascontiguousarray(data[tk.gather_ranges(start, size)])
    return pa.Array.from_buffers(pa.large_string(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(body)]).cast(pa.string())


def _parse(trigger: int):
    """Arrow function: (lang, text) to the chunks of the parse (lang, closed, chunk)."""

    def run(batches):
        for batch in batches:
            for part in tk.chunks(batch):
                buf, starts = tk.joined(tk.texts(part.column("text")))
                buf = tk.LOWER[buf]
                s, e = _spans(buf)
                if not len(s):
                    continue
                piece = np.cumsum(_BREAK[buf])[s]
                doc = np.searchsorted(starts, s, side="right") - 1
                opens = np.concatenate([[True], doc[1:] != doc[:-1]])
                pair = tk.shingle_hashes(tk.word_hashes(buf, s, e), OVERLAP)
                fires = np.zeros(len(s), dtype=bool)
                fires[: len(pair)] = (pair % np.uint64(trigger) == 0) & (piece[: len(pair)] == piece[OVERLAP - 1 :])
                first = np.flatnonzero(opens | fires)
                after = np.append(first[1:], len(s))  # the next chunk's first word
                closed = np.append(opens[first[1:]], True)
                last = np.where(closed, after, after + OVERLAP)
                # words joined by one space, or by one line feed where a piece ends
                flat = np.where(_GAP[buf], np.uint8(32), buf)
                size = e - s + 1
                place = np.concatenate([[0], np.cumsum(size)])
                text = flat[tk.gather_ranges(s, size)]
                text[place[1:-1][piece[1:] != piece[:-1]] - 1] = 10
                begin = place[first]
                yield pa.RecordBatch.from_arrays(
                    [part.column("lang").take(pa.array(doc[first])), pa.array(closed), _strings(text, begin, place[last] - 1 - begin)],
                    names=["lang", "closed", "chunk"],
                )

    return run


class Filter:
    """A Bloom filter: two positions per key."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @staticmethod
    def positions(keys: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        return keys % np.uint64(size), tk.mix(keys + np.uint64(1)) % np.uint64(size)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        found = np.ones(len(keys), dtype=bool)
        for at in self.positions(keys, 8 * len(self.bits)):
            found &= (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return found


def _lang_hashes(langs: pa.Array) -> np.ndarray:
    buf, starts = tk.joined(tk.texts(langs))
    return tk.mix(tk.Poly(buf).ranges(starts[:-1], starts[1:] - 1) + np.uint64(0x51))


def _count(n: int, known: Filter | None):
    """Arrow function: distinct chunks (lang, closed, chunk, n) to counts (lang, phrase, n) of n-grams whose
    parts (of n - 1 words) are ``known``, summed within bounded pieces. With single words comes their number."""

    def counted(rows: pa.Table):
        buf, starts = tk.joined(tk.texts(rows.column("chunk").combine_chunks()))
        weight = rows.column("n").to_numpy().astype(np.int64)
        coded = rows.column("lang").combine_chunks().dictionary_encode()
        lang = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        salt = _lang_hashes(coded.dictionary)
        s, e = _spans(buf)
        chunk = np.searchsorted(starts, s, side="right") - 1
        piece = np.cumsum(buf == 10)[s]  # a chunk ends in a line feed too
        ends = np.searchsorted(s, starts)[1:]  # each chunk's end in words
        closed = rows.column("closed").to_numpy(zero_copy_only=False).astype(bool)
        here = np.arange(len(s)) < (ends - np.where(closed, 0, OVERLAP))[chunk]
        one = tk.Poly(buf, tk.BASE_A)
        code = lang[chunk]
        if n == 1:
            names, size = coded.dictionary, len(coded.dictionary)
            total = np.bincount(code[here], weights=weight[chunk[here]], minlength=size).astype(np.int64)
            yield pa.RecordBatch.from_arrays([names, pa.array([ALL_WORDS] * size, pa.string()), pa.array(total)], names=["lang", "phrase", "n"])
        m = len(s) - n + 1
        if m <= 0:
            return
        good = here[:m] & (piece[:m] == piece[n - 1 :])
        if known is not None:
            part = known.holds(tk.mix(one.ranges(s[: m + 1], e[n - 2 :])) ^ salt[code[: m + 1]])
            good &= part[:-1] & part[1:]
        at = np.flatnonzero(good)
        if not len(at):
            return
        begin, end = s[at], e[at + n - 1]
        h1 = tk.mix(one.ranges(begin, end)) ^ salt[code[at]]
        h2 = tk.mix(tk.Poly(buf, tk.BASE_B).ranges(begin, end)) ^ salt[code[at]]
        order = np.lexsort((h2, h1))
        a, b = h1[order], h2[order]
        head = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
        total = np.add.reduceat(weight[chunk[at]][order], head)
        pick = order[head]
        yield pa.RecordBatch.from_arrays(
            [coded.dictionary.take(pa.array(code[at[pick]])), _strings(buf, begin[pick], end[pick] - begin[pick]), pa.array(total)], names=["lang", "phrase", "n"]
        )

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for part in tk.chunks(batch, "chunk"):
                held.append(part)
                size += part.column("chunk").nbytes
                if size >= tk.CHUNK_BYTES:
                    yield from counted(pa.Table.from_batches(held))
                    held, size = [], 0
        if held:
            yield from counted(pa.Table.from_batches(held))

    return run


def _places(size: int):
    """Arrow function: (lang, phrase) to the positions of its key in a filter of ``size`` bits."""

    def run(batches):
        for batch in batches:
            coded = batch.column("lang").dictionary_encode()
            salt = _lang_hashes(coded.dictionary)[coded.indices.to_numpy(zero_copy_only=False)]
            buf, starts = tk.joined(tk.texts(batch.column("phrase")))
            keys = tk.mix(tk.Poly(buf, tk.BASE_A).ranges(starts[:-1], starts[1:] - 1)) ^ salt
            at = np.concatenate(Filter.positions(keys, size)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at)], names=["at"])

    return run


def frequent(counts: DataFrame) -> Filter:
    """A filter that holds every phrase of ``counts``; ``FILTER_BITS`` / 8 bytes at most, whatever their number."""
    n = counts.count()
    size = 1 << max(15, min(FILTER_BITS.bit_length() - 1, (BITS_PER_KEY * n).bit_length()))
    places = counts.select("lang", "phrase").mapInArrow(_places(size), "at long").select((F.col("at") + 1).alias("at"))
    pages = places.groupBy(F.expr("bitmap_bucket_number(at)").alias("page")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(at))").alias("bits")).toArrow()
    bits = np.zeros(size // 8, dtype=np.uint8)
    for page, body in zip(pages.column("page").to_pylist(), pages.column("bits").to_pylist()):
        bits[(page - 1) * 4096 : page * 4096] = np.frombuffer(body, dtype=np.uint8)
    return Filter(bits)


def parse(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", trigger: int = TRIGGER) -> DataFrame:
    """The parse's dictionary: (lang, closed, chunk, n), ``n`` the chunk's occurrences."""
    source = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNDETERMINED)).alias("lang"), F.col(text_col).alias("text"))
    chunks = source.where("text IS NOT NULL").mapInArrow(_parse(trigger), "lang string, closed boolean, chunk string")
    return chunks.groupBy("lang", "closed", "chunk").agg(F.count("*").alias("n"))


def ngram_counts(dictionary: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """(lang, phrase, n) of all phrases of one to three words that occur ``min_count`` times; each
    language's number of words under the empty phrase. ``dictionary`` is read once per length."""
    levels, known = [], None
    for n in range(1, LONGEST + 1):
        found = dictionary.mapInArrow(_count(n, known), "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
        levels.append(materialise(found.where((F.col("n") >= min_count) | (F.col("phrase") == ALL_WORDS)), f"ngrams-{n}"))
        known = frequent(levels[-1].where(F.col("phrase") != ALL_WORDS)) if n < LONGEST else None
    return reduce(DataFrame.unionByName, levels)


def _key(phrase: Column) -> Column:
    """One string for phrase and language: phrases hold no line feed."""
    return F.concat(phrase, F.lit("\n"), F.col("lang"))


def _scored(counts: DataFrame) -> DataFrame:
    """Candidates with their lowest-scoring cut: (lang, phrase, a, k, l, r, score)."""
    w = F.split("phrase", " ")
    cuts = F.transform(
        F.sequence(F.lit(1), F.size(w) - 1),
        lambda k: F.struct(
            k.alias("k"),
            _key(F.array_join(F.slice(w, F.lit(1), k), " ")).alias("left"),
            _key(F.array_join(F.slice(w, k + 1, F.size(w) - k), " ")).alias("right"),
        ),
    )
    known = counts.where(F.col("phrase") != ALL_WORDS).select(_key(F.col("phrase")).alias("key"), "n")
    cut = counts.where(F.instr("phrase", " ") > 0).select("lang", "phrase", F.col("n").alias("a"), F.explode(cuts).alias("cut"))
    cut = cut.select("lang", "phrase", "a", "cut.*")
    for side, name in (("left", "l"), ("right", "r")):
        cut = left_join_dimension(cut, known.select(F.col("key").alias(side), F.col("n").alias(name)), side, BROADCAST_ROWS)
    exact = "CAST((CAST(1000000 AS DECIMAL(38,0)) * a * a) div (CAST(l AS DECIMAL(38,0)) * r) AS BIGINT)"
    least = F.min(F.struct(F.expr(exact).alias("score"), "k", "l", "r")).alias("least")
    return cut.groupBy("lang", "phrase", "a").agg(least).select("lang", "phrase", "a", "least.*")


def _swallowed(counts: DataFrame) -> DataFrame:
    """(lang, phrase, longer): the largest count of a longer candidate that holds the phrase."""
    w = F.split("phrase", " ")
    inner = F.transform(F.sequence(F.lit(0), F.size(w) - 2), lambda i: F.array_join(F.slice(w, i + 1, F.lit(2)), " "))
    longer = counts.where(F.size(w) == LONGEST)
    return longer.select("lang", F.explode(inner).alias("phrase"), "n").groupBy("lang", "phrase").agg(F.max("n").alias("longer"))


def collocations(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text", min_count: int = MIN_COUNT, top: int = TOP, trigger: int = TRIGGER
) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    counts = ngram_counts(materialise(parse(docs, lang_col, text_col, trigger), "parse", "zstd"), min_count)
    left = _scored(counts).join(_swallowed(counts), ["lang", "phrase"], "left")
    left = left.where(f"longer IS NULL OR 100 * longer < {SWALLOWED_PERCENT} * a")
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salted = left.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    for keys in (["lang", "salt"], ["lang"]):
        salted = salted.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*best))).where(F.col("rank") <= top)
    totals = counts.where(F.col("phrase") == ALL_WORDS).select("lang", F.col("n").alias("total"))
    found = left_join_dimension(salted, totals, "lang", BROADCAST_ROWS)
    return found.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
