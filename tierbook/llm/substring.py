"""Substring dedup over windows of words, by super-k-mer partitioning.

A window is ``window`` consecutive words of one document. Its minimiser is the
smallest hash among its runs of ``grain`` words; consecutive windows with one
minimiser share a *super-k-mer*, which travels once, as a packed string, to
the bucket of the minimiser. Equal windows have equal minimisers, so each
bucket finds every occurrence of its windows: it sorts them and takes the
smallest document id of each.

Skew: a super-k-mer that a task has seen before in a smaller document is
settled where it is read (all its windows are repeats), so the inside of a passage
in a third of all documents reaches its bucket about once per task. At its edges a
super-k-mer holds words of the document's own, so that each document posts
another one under the same minimiser. Minimisers that would gather more than
``HOT`` super-k-mers are therefore found beforehand, in every ``SAMPLE``th
document (which decides where work goes, not what is found): their super-k-mers
don't travel; each window of them goes by its own 128-bit hash, unless the task
has seen it in a smaller document. So no bucket grows with the number of
documents that share a passage. Buckets are processed one at a time from a sorted
partition; there are several per shuffle partition, whose number the session sets.

Edge cases: null and blank texts have no words and stay as they are; texts
with fewer words than a window lose nothing; rows with a null id neither lose
words nor make others lose any; of rows with one id neither is smaller, so
none loses words to another; an empty table gives an empty result.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .scratch import packed_rest, shuffle_partitions

WINDOW = 13
GRAIN = 4
SUB_BUCKETS = 4
LEVEL = 6
SAMPLE = 32
HOT = 20_000
CHUNK_BYTES = 3 << 18  # of a chunk's text: an executor has several workers, and each keeps what it once took
MAX_HOT = 100_000  # minimisers dealt by window: the hottest
_MARK = pa.schema([("id", pa.int64()), ("row", pa.int16()), ("from", pa.int32()), ("to", pa.int32())])
_COLUMNS = (np.int64, np.int16, np.int32, np.int32)  # id (as differences), row, first word, number of words


def _pack(kind: int, columns: list[np.ndarray], body: bytes, squeeze) -> bytes:
    """One compressed blob; columns are stored by byte plane, which compresses better."""
    columns = [np.diff(columns[0], prepend=0), *columns[1:]]
    planes = [np.ascontiguousarray(c, dtype).view(np.uint8).reshape(len(c), -1).T.tobytes() for c, dtype in zip(columns, _COLUMNS)]
    return squeeze.compress(struct.pack("<BI", kind, len(columns[0])) + b"".join(planes) + body)


def _unpack(blob: bytes, spread) -> tuple[int, list[np.ndarray], bytes]:
    raw = spread.decompress(blob)
    kind, n = struct.unpack_from("<BI", raw)
    at, columns = 5, []
    for dtype in _COLUMNS:
        size = np.dtype(dtype).itemsize
        planes = np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n)
        columns.append(np.ascontiguousarray(planes.T).view(dtype).ravel())
        at += n * size
    columns[0] = np.cumsum(columns[0])
    return kind, columns, raw[at:]


def _places(keep: np.ndarray) -> np.ndarray:
    """How many bytes before each one are kept (one more than bytes); four bytes each where they do."""
    place = np.zeros(len(keep) + 1, dtype=np.int32 if len(keep) < 1 << 31 else np.int64)
    np.cumsum(keep, dtype=place.dtype, out=place[1:])
    return place


def _minimisers(buf, starts, window: int, grain: int):
    """(word starts, ends, document of each word, word hashes, minimiser of each window, first window of each super-k-mer, whole windows)."""
    s, e = tk.word_spans(buf)
    doc = np.searchsorted(starts, s, side="right") - 1
    words = tk.word_hashes(buf, s, e)
    if len(s) < window:
        none = np.zeros(0, dtype=bool)
        return s, e, doc, words, words[:0], none, none
    least = tk.sliding_min(tk.shingle_hashes(words, grain), window - grain + 1)
    n = len(least)
    whole = doc[:n] == doc[window - 1 : window - 1 + n]
    fresh = np.ones(n, dtype=bool)
    fresh[1:] = (least[1:] != least[:-1]) | (doc[1:n] != doc[: n - 1]) | ~whole[:-1]
    return s, e, doc, words, least, fresh, whole


def _sampled(window: int, grain: int):
    """Arrow function: documents to the minimisers of their super-k-mers and their numbers."""

    def run(batches):
        for batch in batches:
            for part in tk.chunks(batch, limit=CHUNK_BYTES):
                buf, starts = tk.joined(tk.texts(part.column("text")))
                *_, least, fresh, whole = _minimisers(buf, starts, window, grain)
                value, n = np.unique(least[whole & fresh], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(n.astype(np.int64))], names=["least", "n"])

    return run


def hot_minimisers(docs: DataFrame, window: int, grain: int) -> np.ndarray:
    """The minimisers of about ``HOT`` super-k-mers or more in ``docs`` (id, row, text), sorted."""
    some = docs.where(F.pmod(F.xxhash64("id", "row"), F.lit(SAMPLE)) == 0).select("text")
    counts = some.mapInArrow(_sampled(window, grain), "least long, n long").groupBy("least").agg(F.sum("n").alias("n"))
    hot = counts.where(F.col("n") * SAMPLE > HOT).orderBy(F.col("n").desc(), "least").limit(MAX_HOT).select("least").toArrow()
    return np.sort(hot.column("least").to_numpy().view(np.uint64))


def _super_kmers(window: int, grain: int, buckets: int, hot: np.ndarray):
    """Arrow function: documents to (bucket, blob of super-k-mers, or of windows of hot minimisers)."""

    def settle(seen, h, doc):
        """True where a smaller document with this super-k-mer was met in this task; and the new table."""
        order = np.lexsort((doc, h))
        hs, ds = h[order], doc[order]
        first = np.concatenate([[True], hs[1:] != hs[:-1]])
        least = np.repeat(ds[first], np.diff(np.append(np.flatnonzero(first), len(hs))))
        known_h, known_d = seen
        if len(known_h):
            at = np.minimum(np.searchsorted(known_h, hs), len(known_h) - 1)
            least = np.where(known_h[at] == hs, np.minimum(least, known_d[at]), least)
        repeat = np.empty(len(h), dtype=bool)
        repeat[order] = ds > least
        many = first & np.concatenate([hs[1:] == hs[:-1], [False]])
        new_h, new_d = np.concatenate([known_h, hs[many]]), np.concatenate([known_d, least[many]])
        o = np.lexsort((new_d, new_h))
        new_h, new_d = new_h[o], new_d[o]
        one = np.concatenate([[True], new_h[1:] != new_h[:-1]]) if len(new_h) else np.zeros(0, bool)
        return repeat, (new_h[one], new_d[one])

    def dealt(kind, key, cols, squeeze, body):
        """A blob per bucket; ``body`` gives the bytes of some of the rows."""
        order = np.argsort(key, kind="stable")
        for group in np.split(order, np.flatnonzero(np.diff(key[order])) + 1) if len(order) else []:
            yield int(key[group[0]]), _pack(kind, [c[group] for c in cols], body(group), squeeze)

    def run(batches):
        squeeze = zstandard.ZstdCompressor(level=LEVEL)
        seen = seen_windows = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        for batch in batches:
            for part in tk.chunks(batch, limit=CHUNK_BYTES):
                buf, starts = tk.joined(tk.texts(part.column("text")))
                ids = part.column("id").to_numpy(zero_copy_only=False).astype(np.int64)
                rows = part.column("row").to_numpy(zero_copy_only=False)
                s, e, doc, words, least, fresh, whole = _minimisers(buf, starts, window, grain)
                first = np.flatnonzero(whole & fresh)
                if not len(first):
                    continue
                # a run of windows ends where the next one starts or where windows stop being whole
                stop = np.flatnonzero(whole & np.concatenate([fresh[1:] | ~whole[1:], [True]])) + 1
                last_word = stop + window - 1  # exclusive
                # packed text: words joined by one space, a line feed after each super-k-mer
                space = tk._IS_SPACE[buf]
                keep = ~space
                keep[e] = True  # the one separator after each word
                place = _places(keep)
                flat = np.where(space, np.uint8(32), buf)
                text = flat[keep]
                ws, we = place[s], place[e]
                b, f = ws[first], we[last_word - 1]
                repeat, seen = settle(seen, tk.mix(tk.Poly(words).ranges(first, last_word)), ids[doc[first]])
                d = doc[first]
                cols = [ids[d], rows[d], first.astype(np.int32), (last_word - first).astype(np.int32)]
                cols[2] = cols[2] - np.searchsorted(s, starts[d]).astype(np.int32)  # word position in its document
                key = (least[first] % np.uint64(buckets)).astype(np.int32)
                out_key, out_blob = [], []
                if repeat.any():
                    out_key.append(int(key[repeat][0]))
                    out_blob.append(_pack(1, [c[repeat] for c in cols], b"", squeeze))
                at = np.minimum(np.searchsorted(hot, least[first]), max(len(hot) - 1, 0))
                is_hot = (hot[at] == least[first]) if len(hot) else np.zeros(len(first), dtype=bool)
                go = np.flatnonzero(~repeat & ~is_hot)

                def texts_of(group, go=go, b=b, f=f, text=text):
                    size = f[go[group]] - b[go[group]] + 1
                    body = text[np.minimum(tk.gather_ranges(b[go[group]], size), len(text) - 1)]
                    body[np.cumsum(size) - 1] = 10
                    return body.tobytes()

                blobs = list(dealt(0, key[go], [c[go] for c in cols], squeeze, texts_of))
                own = np.flatnonzero(~repeat & is_hot)
                if len(own):
                    w = tk.gather_ranges(first[own], last_word[own] - window + 1 - first[own])
                    h1 = tk.shingle_hashes(words, window)[w]
                    h2 = tk.shingle_hashes(tk.mix(tk.Poly(buf, tk.BASE_B).ranges(s, e)), window)[w]
                    place_in = (w - np.searchsorted(s, starts[doc[w]])).astype(np.int32)
                    wide = [ids[doc[w]], rows[doc[w]], place_in, np.full(len(w), window, np.int32)]
                    known, seen_windows = settle(seen_windows, h1 ^ tk.mix(h2), ids[doc[w]])
                    if known.any():
                        blobs.append((int(h1[known][0] % np.uint64(buckets)), _pack(1, [c[known] for c in wide], b"", squeeze)))
                    new = np.flatnonzero(~known)
                    pair = np.stack([h1[new], h2[new]], axis=1)
                    to = (h1[new] % np.uint64(buckets)).astype(np.int32)
                    blobs += dealt(2, to, [c[new] for c in wide], squeeze, lambda group, pair=pair: pair[group].tobytes())
                out_key += [k for k, _ in blobs]
                out_blob += [x for _, x in blobs]
                yield pa.RecordBatch.from_arrays([pa.array(out_key, pa.int32()), pa.array(out_blob, pa.binary())], names=["bucket", "blob"])

    return run


def _repeats(window: int):
    """Arrow function over rows sorted by bucket: word ranges that repeat a window of a smaller document."""

    def single(c, h):
        """Windows that came each by its own hash."""
        order = np.lexsort((h[:, 1], h[:, 0]))
        hs = h[order]
        first = np.flatnonzero(np.concatenate([[True], (hs[1:] != hs[:-1]).any(axis=1)]))
        least = np.repeat(np.minimum.reduceat(c[0][order], first), np.diff(np.append(first, len(order))))
        gone = order[c[0][order] > least]
        yield pa.RecordBatch.from_arrays([pa.array(c[0][gone]), pa.array(c[1][gone]), pa.array(c[2][gone]), pa.array(c[2][gone] + c[3][gone])], schema=_MARK)

    def count(blobs, spread):
        cols, one, two, texts, held, wide = [], [], [], [], 0, []

        def hashed():
            # both hashes of each word, over a bounded piece of the bucket's text
            text = np.frombuffer(b"".join(texts), dtype=np.uint8)
            s, e = tk.word_spans(text)
            one.append(tk.mix(tk.Poly(text, tk.BASE_A).ranges(s, e)))
            two.append(tk.mix(tk.Poly(text, tk.BASE_B).ranges(s, e)))

        for blob in blobs:
            kind, c, body = _unpack(blob, spread)
            if kind == 1:
                yield pa.RecordBatch.from_arrays([pa.array(c[0]), pa.array(c[1]), pa.array(c[2]), pa.array(c[2] + c[3])], schema=_MARK)
                continue
            if kind == 2:
                wide.append((c, np.frombuffer(body, dtype=np.uint64).reshape(-1, 2)))
                continue
            cols.append(c)
            texts.append(body)
            held += len(body)
            if held >= tk.CHUNK_BYTES // 2:
                hashed()
                texts, held = [], 0
        if wide:
            yield from single([np.concatenate(x) for x in zip(*[c for c, _ in wide])], np.concatenate([h for _, h in wide]))
        if not cols:
            return
        if texts:
            hashed()
        ids, rows, pos, size = (np.concatenate(x) for x in zip(*cols))
        one, two = np.concatenate(one), np.concatenate(two)
        kmer = np.repeat(np.arange(len(ids)), size)
        inside = np.arange(len(one)) - np.repeat(np.cumsum(size) - size, size)
        at = np.flatnonzero(inside + window <= size[kmer])
        h1, h2 = tk.shingle_hashes(one, window)[at], tk.shingle_hashes(two, window)[at]
        order = np.lexsort((h2, h1))
        a, b = h1[order], h2[order]
        first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
        doc = ids[kmer[at]]
        least = np.minimum.reduceat(doc[order], first)
        repeat = np.empty(len(at), dtype=bool)
        repeat[order] = doc[order] > np.repeat(least, np.diff(np.append(first, len(at))))
        # consecutive repeated windows of one super-k-mer become one range
        flag = np.zeros(len(one) + 1, dtype=bool)
        flag[at] = repeat
        start, stop = tk.runs(flag)
        k = kmer[start]
        begin = pos[k] + inside[start].astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[k]), pa.array(rows[k]), pa.array(begin), pa.array((begin + (stop - start) + window - 1).astype(np.int32))], schema=_MARK
        )

    def run(batches):
        spread, current, held = zstandard.ZstdDecompressor(), None, []
        for batch in batches:
            for bucket, blob in zip(batch.column("bucket").to_pylist(), batch.column("blob").to_pylist()):
                if bucket != current and held:
                    yield from count(held, spread)
                    held = []
                current = bucket
                held.append(blob)
        if held:
            yield from count(held, spread)

    return run


def _squeezed(batches):
    """Arrow function: the column text compressed, for the shuffle of the join with the ranges."""
    squeeze = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        for part in tk.chunks(batch):
            packed = [None if t is None else squeeze.compress(t) for t in part.column("text").cast(pa.binary()).to_pylist()]
            at = part.schema.get_field_index("text")
            yield part.set_column(at, "text", pa.array(packed, pa.binary()))


def _apply(batches):
    """Arrow function: documents with their ranges to kept texts."""
    spread = zstandard.ZstdDecompressor()
    for batch in batches:
        for part in tk.chunks(batch, limit=tk.CHUNK_BYTES // 3):
            whole = [None if t is None else spread.decompress(t) for t in part.column("text").to_pylist()]
            docs = [t or b"" for t in whole]
            buf, starts = tk.joined(docs)
            s, e = tk.word_spans(buf)
            first = np.searchsorted(s, starts)  # each document's first word
            ranges = part.column("ranges")
            owner = np.repeat(np.arange(len(docs)), pa.compute.fill_null(pa.compute.list_value_length(ranges), 0).to_numpy(zero_copy_only=False))
            flat = ranges.flatten()
            begin = flat.field("from").to_numpy(zero_copy_only=False).astype(np.int64) + first[owner]
            end = flat.field("to").to_numpy(zero_copy_only=False).astype(np.int64) + first[owner]
            gone = tk.covered(len(s), begin, end)
            space = tk._IS_SPACE[buf]
            keep = ~space
            keep[tk.gather_ranges(s[gone], (e - s)[gone])] = False
            keep[e[~gone]] = True
            place = _places(keep)[starts]
            out = np.where(space, np.uint8(32), buf)[keep].tobytes()
            kept = [out[a : b - 1] if b > a else b"" for a, b in zip(place, place[1:])]
            lost = np.concatenate([[0], np.cumsum(gone)])[first]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id"),
                    pa.array(np.diff(first), pa.int64()),
                    pa.array(np.diff(lost), pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                    pa.array(whole, pa.binary()).cast(pa.string()),
                    part.column("rest"),
                ],
                names=["id", "n_words", "n_removed", "kept_text", "text", "rest"],
            )


def repeated_ranges(docs: DataFrame, window: int = WINDOW, grain: int = GRAIN) -> DataFrame:
    """(id, row, from, to): word ranges of ``docs`` (id, row, text) whose windows start in a smaller document too."""
    spark = docs.sparkSession
    partitions = shuffle_partitions(spark)
    buckets = partitions * SUB_BUCKETS
    known = docs.where("id IS NOT NULL AND text IS NOT NULL")
    kmers = known.mapInArrow(_super_kmers(window, grain, buckets, hot_minimisers(known, window, grain)), "bucket int, blob binary")
    dealt = kmers.repartition(partitions, "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(_repeats(window), "id long, row short, `from` int, `to` int")


def remove_repeated_windows(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, grain: int = GRAIN
) -> DataFrame:
    """Remove every word inside a window that a document with a smaller id holds too.

    Returns one row per input row: ``id, n_words, n_removed, kept_text`` (kept
    words joined by one space), the untouched ``text`` and all other columns in
    the struct ``rest``.
    """
    source = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(text_col).alias("text"),
        packed_rest(docs, id_col, text_col).alias("rest"),
        # tells rows of one id with different texts apart
        F.hash(text_col).bitwiseAND(0x7FFF).cast("short").alias("row"),
    )
    marks = (
        repeated_ranges(source.select("id", "row", "text"), window, grain)
        .groupBy("id", "row")
        .agg(F.collect_list(F.struct("from", "to")).alias("ranges"))
    )
    kind = source.schema["rest"].dataType.simpleString()
    packed = source.select("id", "row", "text", "rest").mapInArrow(_squeezed, f"id long, row short, text binary, rest {kind}")
    found = packed.join(marks, ["id", "row"], "left").select("id", "text", "rest", "ranges")
    schema = f"id long, n_words long, n_removed long, kept_text string, text string, rest {kind}"
    return found.mapInArrow(_apply, schema)
