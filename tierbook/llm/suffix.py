"""Substring dedup over bytes, by a sparse, range-partitioned suffix array.

A string of ``width`` bytes that starts at two places is found through an
*anchor*: the smallest ``gram``-byte hash inside it (the leftmost on ties).
The choice depends on the string's own bytes alone, so both places select the
same anchor at the same offset. Only anchors whose gram occurs more than once
go on; each is a suffix (the bytes from the anchor on) with the bytes before
it as context.

Suffixes are range-partitioned by their leading bytes, then by the hash of
their gram; Spark samples the splitters. A bucket sorts its suffixes, and the reversed left contexts, by
multikey quicksort, eight bytes a level. From the sorted orders and their
common-prefix lengths it numbers the classes of equal prefixes at each depth:
the window ``offset`` bytes before an anchor repeats exactly where the class
of its left ``offset`` bytes and the class of its right ``width - offset``
bytes recur together. Suffixes that share their gram never lie on two sides of
a splitter, so no match crosses the boundary of two buckets; a long bucket is
sorted in batches, which close where the gram changes.

Skew: equal contexts travel once per chunk of input, with their number, so
copies and passages inside them collapse before the shuffle; the places of a
context are joined back by its 128-bit hash, where Spark splits hot keys.
A gram with more than ``HOT_ANCHORS`` anchors goes to no bucket: documents that
share a passage shorter than a context have different contexts, which no task
could hold. Of each string that selects such an anchor the 128-bit hash is
counted by Spark instead, with partial sums in each chunk and task; the strings
that recur are joined back to their places.
Constant or periodic texts have many anchors but few distinct contexts.

Edge cases: null texts count as empty; texts shorter than ``width`` lose
nothing; rows with one id are separate documents when their texts differ and
repeat each other when they don't; rows with a null id are treated alike; an
empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .scratch import materialise, packed_rest, shuffle_partitions, small

WIDTH = 400
GRAM = 128
LEAD = 32
BATCH_CONTEXTS = 8192
HOT_ANCHORS = 8192
PIECE_PLACES = 1 << 16
ROW_PLACES = 128
# of a chunk's text: the anchors of a byte take some 70 bytes of arrays, and a worker keeps what it once took
CHUNK_BYTES = 1 << 19


def _selected(buf: np.ndarray, starts: np.ndarray, width: int, gram: int):
    """(gram hash of every place, the anchor of the string that starts at each place, that place's
    document, whether the string lies inside it); the buffer is longer than ``width``."""
    n = len(buf) - width
    at = np.arange(len(buf) - gram + 1)
    grams = tk.mix(tk.Poly(buf).ranges(at, at + gram))
    packed = (grams & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    anchor = (tk.sliding_min(packed, width - gram + 1)[:n] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    doc = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    return grams, anchor, doc, at[:n] + width <= starts[doc[:n] + 1] - 1


def _anchors(width: int, gram: int):
    """Arrow function: documents to their anchors (gram hash, document, byte position)."""

    def run(batches):
        for batch in batches:
            for part in tk.chunks(batch, limit=CHUNK_BYTES):
                buf, starts = tk.joined(tk.texts(part.column("text")))
                if len(buf) <= width:
                    continue
                grams, anchor, doc, inside = _selected(buf, starts, width, gram)
                pos = np.unique(anchor[inside])
                d = doc[pos]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grams[pos].view(np.int64)), part.column("key").take(pa.array(d)), pa.array((pos - starts[d]).astype(np.int32))],
                    names=["gram", "key", "pos"],
                )

    return run


def _windows(width: int, gram: int, placed: bool):
    """Arrow function: hashes of the distinct strings of each chunk that select a hot anchor, with their number or,
    if ``placed``, their places (key, its hash, position; ``ROW_PLACES`` a row at most) in the order of the first one."""

    def rows(part):
        buf, starts = tk.joined(tk.texts(part.column("text")))
        _, anchor, doc, inside = _selected(buf, starts, width, gram)
        hot = part.column("hot")
        owner = np.repeat(np.arange(part.num_rows), pa.compute.list_value_length(hot).to_numpy(zero_copy_only=False))
        is_hot = np.zeros(len(buf), dtype=bool)
        is_hot[hot.flatten().to_numpy(zero_copy_only=False) + starts[owner]] = True
        at = np.flatnonzero(inside & is_hot[anchor])
        h1 = tk.mix(tk.Poly(buf, tk.BASE_A).ranges(at, at + width))
        h2 = tk.mix(tk.Poly(buf, tk.BASE_B).ranges(at, at + width))
        order = np.lexsort((h2, h1))
        a, b = h1[order], h2[order]
        first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])) if len(at) else at
        size = np.diff(np.append(first, len(at)))
        if not placed:
            yield a[first], b[first], pa.array(size.astype(np.int64))
            return
        first = np.flatnonzero((np.arange(len(at)) - np.repeat(first, size)) % ROW_PLACES == 0)
        size = np.diff(np.append(first, len(at)))
        by = np.argsort(order[first])
        first, size = first[by], size[by]
        piece = np.cumsum(size) // PIECE_PLACES
        for k in np.split(np.arange(len(first)), np.flatnonzero(np.diff(piece)) + 1):
            flat = at[order[tk.gather_ranges(first[k], size[k])]]
            offsets = pa.array(np.concatenate([[0], np.cumsum(size[k])]).astype(np.int32))
            d = doc[flat]
            places = (part.column("key").take(pa.array(d)), part.column("doc").take(pa.array(d)), pa.array((flat - starts[d]).astype(np.int32)))
            yield a[first[k]], b[first[k]], *(pa.ListArray.from_arrays(offsets, x) for x in places)

    def run(batches):
        names = ["h1", "h2", "key", "doc", "pos"] if placed else ["h1", "h2", "many"]
        for batch in batches:
            for part in tk.chunks(batch, limit=CHUNK_BYTES):
                for h1, h2, *more in rows(part):
                    yield pa.RecordBatch.from_arrays([pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), *more], names=names)

    return run


def _merged(width: int):
    """Arrow function: ``_windows``' places to byte ranges of documents, neighbours of one batch in one."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            key, doc, pos = (batch.column(c).flatten() for c in ("key", "doc", "pos"))
            doc, pos = doc.to_numpy(), pos.to_numpy()
            order = np.lexsort((pos, doc))
            doc, pos = doc[order], pos[order]
            first = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (pos[1:] > pos[:-1] + 1)]))
            last = np.append(first[1:], len(order)) - 1
            yield pa.RecordBatch.from_arrays(
                [key.take(pa.array(order[first])), pa.array(pos[first]), pa.array((pos[last] + width).astype(np.int32))], names=["key", "from", "to"]
            )

    return run


def _contexts(part, width: int, gram: int):
    """Of a chunk of documents with anchors: the buffer and each anchor's place, context range, hashes, document, gram hash."""
    buf, starts = tk.joined(tk.texts(part.column("text")))
    anchors = part.column("anchors")
    doc = np.repeat(np.arange(part.num_rows), pa.compute.list_value_length(anchors).to_numpy(zero_copy_only=False))
    pos = anchors.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    at = pos + starts[doc]
    begin = np.maximum(starts[doc], at - (width - gram))
    end = np.minimum(starts[doc + 1] - 1, at + width)
    left = (at - begin).astype(np.uint64)
    poly = tk.Poly(buf, tk.BASE_A)
    h1 = tk.mix(poly.ranges(begin, end) ^ left)
    h2 = tk.mix(tk.Poly(buf, tk.BASE_B).ranges(begin, end) + left)
    return buf, doc, pos, at, begin, end, h1, h2, tk.mix(poly.ranges(at, at + gram))


def _suffixes(width: int, gram: int):
    """Arrow function: the distinct contexts of each chunk, with their number."""

    def run(batches):
        for batch in batches:
            for part in tk.chunks(batch, limit=CHUNK_BYTES):
                buf, doc, pos, at, begin, end, h1, h2, grams = _contexts(part, width, gram)
                order = np.lexsort((h2, h1))
                first = np.flatnonzero(np.concatenate([[True], (np.diff(h1[order]) != 0) | (np.diff(h2[order]) != 0)]))
                one, many = order[first], np.diff(np.append(first, len(order)))
                raw = buf.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([raw[a : a + LEAD] for a in at[one]], pa.binary()),
                        pa.array(grams[one].view(np.int64)),
                        pa.array(h1[one].view(np.int64)),
                        pa.array(h2[one].view(np.int64)),
                        pa.array((at - begin)[one].astype(np.int32)),
                        pa.array(many.astype(np.int64)),
                        pa.array([raw[a:b] for a, b in zip(begin[one], end[one])], pa.binary()),
                    ],
                    names=["lead", "gram", "h1", "h2", "left", "many", "context"],
                )

    return run


def _places(width: int, gram: int):
    """Arrow function: every anchor's context hash and place."""

    def run(batches):
        for batch in batches:
            for part in tk.chunks(batch, limit=CHUNK_BYTES):
                _, doc, pos, _, _, _, h1, h2, _ = _contexts(part, width, gram)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), part.column("key").take(pa.array(doc)), pa.array(pos.astype(np.int32))],
                    names=["h1", "h2", "key", "pos"],
                )

    return run


def multikey_order(rows: np.ndarray) -> np.ndarray:
    """Order of equally long byte rows (a multiple of eight bytes), by multikey quicksort: one level
    partitions every group of still equal rows by its next eight bytes; groups of one are done."""
    words = np.ascontiguousarray(rows).view(">u8").astype(np.uint64)
    order = np.arange(len(words))
    group = np.zeros(len(words), dtype=np.int64)  # by place in order
    for level in range(words.shape[1]):
        size = np.bincount(group, minlength=1)
        open_ = np.flatnonzero(size[group] > 1)
        if not len(open_):
            break
        w = words[order[open_], level]
        by = np.lexsort((w, group[open_]))
        order[open_] = order[open_][by]
        w, g = w[by], group[open_]
        split = np.zeros(len(order), dtype=np.int64)
        split[open_[1:]] = (g[1:] == g[:-1]) & (w[1:] != w[:-1])
        step = np.concatenate([[0], (group[1:] != group[:-1])]) + split
        group = np.cumsum(step)
    return order


def common_prefixes(rows: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Equal leading bytes of each row and its predecessor in ``order`` (0 for the first)."""
    differ = rows[order[1:]] != rows[order[:-1]]
    return np.concatenate([[0], np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])]) if len(order) else np.zeros(0, int)


def _filled(parts: list[bytes], width: int) -> np.ndarray:
    width = -(-width // 8) * 8
    return np.frombuffer(b"".join(p.ljust(width, b"\0") for p in parts), dtype=np.uint8).reshape(len(parts), width)


def repeated_offsets(contexts: list[bytes], left: np.ndarray, many: np.ndarray, width: int, gram: int) -> np.ndarray:
    """[context, offset]: whether the ``width`` bytes from ``offset`` before the anchor on occur twice."""
    n, offsets = len(contexts), width - gram + 1
    right = np.array([len(c) for c in contexts]) - left
    rows_r = _filled([c[k:] for c, k in zip(contexts, left)], width)
    rows_l = _filled([c[:k][::-1] for c, k in zip(contexts, left)], width - gram)
    order_r, order_l = multikey_order(rows_r), multikey_order(rows_l)
    lcp_r, lcp_l = common_prefixes(rows_r, order_r), common_prefixes(rows_l, order_l)
    class_r, class_l = np.empty(n, np.int64), np.empty(n, np.int64)
    found = np.zeros((n, offsets), dtype=bool)
    for offset in range(offsets):
        valid = np.flatnonzero((left >= offset) & (right >= width - offset))
        if not len(valid):
            continue
        class_r[order_r] = np.cumsum(lcp_r < width - offset)
        class_l[order_l] = np.cumsum(lcp_l < offset) if offset else 0
        pair = class_l[valid] * (n + 1) + class_r[valid]
        by = np.argsort(pair, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], np.diff(pair[by]) != 0]))
        total = np.add.reduceat(many[valid][by], first)
        found[valid[by], offset] = np.repeat(total > 1, np.diff(np.append(first, len(by))))
    return found


def _bucket(width: int, gram: int):
    """Arrow function over a range sorted by leading bytes and gram: repeated byte ranges relative to the anchor."""

    def solve(rows):
        h1, h2, left, many, contexts = (list(x) for x in zip(*rows))
        left, many = np.array(left, dtype=np.int64), np.array(many, dtype=np.int64)
        found = repeated_offsets(contexts, left, many, width, gram)
        at = np.flatnonzero(found.any(axis=1))
        who, start, stop = [], [], []
        for i in at:
            a, b = tk.runs(found[i])
            who.append(np.full(len(a), i))
            start.append(a)
            stop.append(b)
        if who:
            who, start, stop = map(np.concatenate, (who, start, stop))
            # offsets start..stop-1: windows from -(stop-1) to -start
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.array(h1, dtype=np.int64)[who]),
                    pa.array(np.array(h2, dtype=np.int64)[who]),
                    pa.array((1 - stop).astype(np.int32)),
                    pa.array((width - start).astype(np.int32)),
                ],
                names=["h1", "h2", "from", "to"],
            )

    def run(batches):
        held, last = [], None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("gram", "h1", "h2", "left", "many", "context")]
            for row in zip(*columns):
                if len(held) >= BATCH_CONTEXTS and row[0] != last:
                    yield from solve(held)
                    held = []
                last = row[0]
                held.append(row[1:])
        if held:
            yield from solve(held)

    return run


def _apply(batches):
    """Arrow function: documents with their ranges to kept bytes."""
    for batch in batches:
        for part in tk.chunks(batch, limit=CHUNK_BYTES):
            out = {"n_removed": [], "n_spans": [], "kept": []}
            for text, ranges in zip(tk.texts(part.column("text")), part.column("ranges").to_pylist()):
                begin = np.array([r["from"] for r in ranges], dtype=np.int64)
                end = np.array([r["to"] for r in ranges], dtype=np.int64)
                gone = tk.covered(len(text), begin, end)
                out["n_removed"].append(int(gone.sum()))
                out["n_spans"].append(len(tk.runs(gone)[0]))
                out["kept"].append(np.frombuffer(text, dtype=np.uint8)[~gone].tobytes())
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), pa.array(out["n_removed"], pa.int64()), pa.array(out["n_spans"], pa.int64()), pa.array(out["kept"], pa.binary())],
                names=["key", "n_removed", "n_spans", "kept"],
            )


def cut_repeats(
    docs: DataFrame, key_col: str = "key", text_col: str = "text", width: int = WIDTH, gram: int = GRAM, hot: int | None = None
) -> DataFrame:
    """Cut every byte covered by a ``width``-byte string that starts anywhere else too.

    ``key_col`` tells documents apart (any type). Returns ``key, n_removed,
    n_spans, kept`` (the remaining bytes) of the documents that lose bytes;
    all others stay as they are. ``hot``: anchors of one gram that a bucket
    takes at most (``HOT_ANCHORS``); no result depends on it.
    """
    hot = HOT_ANCHORS if hot is None else hot
    partitions = shuffle_partitions(docs.sparkSession)
    long_enough = docs.where(F.octet_length(text_col) >= width).select(F.col(key_col).alias("key"), F.col(text_col).alias("text"))
    kind = long_enough.schema["key"].dataType.simpleString()
    anchors = materialise(long_enough.mapInArrow(_anchors(width, gram), f"gram long, key {kind}, pos int"), "anchors")
    # written first: the join then deals both sides itself, and Spark can split a hot gram
    count = F.col("count")
    repeated = materialise(anchors.groupBy("gram").count().where(count > 1).select("gram", (count > hot).alias("is_hot")), "repeated")
    per_doc = anchors.join(repeated, "gram").groupBy("key").agg(
        F.collect_list(F.when(~F.col("is_hot"), F.col("pos"))).alias("anchors"), F.collect_list(F.when(F.col("is_hot"), F.col("pos"))).alias("hot")
    )
    held = materialise(long_enough.join(per_doc, "key"), "anchored")
    cold = held.where(F.size("anchors") > 0).select("key", "text", "anchors")
    suffixes = cold.mapInArrow(
        _suffixes(width, gram), "lead binary, gram long, h1 long, h2 long, `left` int, many long, context binary"
    )
    dealt = suffixes.repartitionByRange(partitions, "lead", "gram").sortWithinPartitions("lead", "gram")
    ranges = dealt.mapInArrow(_bucket(width, gram), "h1 long, h2 long, `from` int, `to` int").distinct()
    places = cold.mapInArrow(_places(width, gram), f"h1 long, h2 long, key {kind}, pos int")
    found = places.join(ranges, ["h1", "h2"]).select("key", (F.col("pos") + F.col("from")).alias("from"), (F.col("pos") + F.col("to")).alias("to"))
    if repeated.where("is_hot").limit(1).count():
        shared = held.where(F.size("hot") > 0).select("key", F.xxhash64("key").alias("doc"), "text", "hot")
        counts = shared.mapInArrow(_windows(width, gram, False), "h1 long, h2 long, many long").groupBy("h1", "h2").agg(F.sum("many").alias("many"))
        recurring = materialise(counts.where("many > 1").select("h1", "h2"), "recurring")
        held_places = f"h1 long, h2 long, key array<{kind}>, doc array<long>, pos array<int>"
        hits = shared.mapInArrow(_windows(width, gram, True), held_places).join(small(recurring), ["h1", "h2"])
        merged = hits.select("key", "doc", "pos").mapInArrow(_merged(width), f"key {kind}, `from` int, `to` int")
        found = found.unionByName(merged)
    per_key = found.groupBy("key").agg(F.collect_list(F.struct("from", "to")).alias("ranges"))
    return held.select("key", "text").join(per_key, "key").mapInArrow(
        _apply, f"key {kind}, n_removed long, n_spans long, kept binary"
    )


def remove_repeated_bytes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, gram: int = GRAM
) -> DataFrame:
    """One row per input row: ``id, n_bytes, n_removed, n_spans, kept`` (null
    where nothing was cut: the text itself), ``text_sha256`` of what remains,
    and all other columns in the struct ``rest``."""
    counted = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), packed_rest(docs, id_col, text_col).alias("rest")
    )
    # rows of one id and text are one key, but count as separate places
    order = F.struct("id", F.xxhash64("text").alias("h"), F.hash("text").alias("g"))
    keyed = counted.withColumn("key", order)
    cut = cut_repeats(keyed.select("key", "text"), "key", "text", width, gram).dropDuplicates(["key"])
    plain = keyed.select("key", "id", "rest", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("whole"))
    return plain.join(cut, "key", "left").select(
        "id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        "kept",
        F.when(F.col("kept").isNull(), F.col("whole")).otherwise(F.sha2("kept", 256)).alias("text_sha256"),
        "rest",
    )
