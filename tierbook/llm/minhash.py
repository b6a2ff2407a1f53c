"""Near-duplicate groups by a signature-coordinate inverted join.

A document's set holds its distinct ``SHINGLE``-word shingles; its signature
the minimum of each of ``COORDINATES`` hash functions over the set. Documents
with equal sets form one class; classes are posted under their
(coordinate, value) pairs.

Prefix merging: a pair of classes with ``MATCHES`` or more equal coordinates
shares one of the ``COORDINATES - MATCHES + 1`` rarest of each, so only these
are posted; values that occur once are never posted. Each list goes to a task
with its members' signatures (a byte per coordinate: equal coordinates have
equal bytes), where collisions are counted. Skip merging: a list is walked
breadth first; a member that has been reached is compared with those that have
not, and a pair at or above the threshold is kept only if it reaches one, so
that a list of m members gives fewer than m pairs.

The pairs' components hold every link that the signatures let through. Their
classes meet with their full sets, in blocks of bounded size, and are walked in
the same way, now by exact similarity; a class of whose shingles too few occur
in any other can't be linked and is left out. A component that is larger than a
block has its best connected class in all of its blocks; what that has not been
linked to is then compared with all other blocks, block against block. Only
confirmed links that reach a class make rows, whatever the size of a family.

At a similarity of exactly 0.75 a pair fails the threshold of 32 equal
coordinates of 64 with a probability of 4.6e-6 (binomial tail), at 0.8 of
1.9e-8; nothing else is lost.

Edge cases: texts without words have an empty set and link with nothing; a
text with fewer words than a shingle has its whole sequence as its one
shingle; rows with one id and different texts are separate documents; rows
with a null id link with nothing (``component_id`` null, kept); an empty table
gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import textkit as tk
from .components import components
from .scratch import drop_scratch, materialise, packed_rest, shuffle_partitions, small

SHINGLE = 5
COORDINATES = 64
MATCHES = 32
PERCENT = 75
LIST_MEMBERS = 4096  # of a list that is walked at once; longer ones go in pairs of blocks
BLOCK_MEMBERS = 4096  # of a block that is walked on full sets,
BLOCK_SHINGLES = 1_000_000  # and its shingles (one longer document makes a block of its own)
_BLOCK = 4096
CHUNK_BYTES = 3 << 18  # of a chunk's text: an executor has several workers, and each keeps what it once took


def shingle_sets(docs: list[bytes], size: int):
    """The sorted distinct shingle hashes of each text (A-Z lower-cased)."""
    buf, starts = tk.joined(docs)
    buf = tk.LOWER[buf]
    s, e = tk.word_spans(buf)
    words = tk.word_hashes(buf, s, e)
    first = np.searchsorted(s, starts)
    all_ = tk.shingle_hashes(words, size)
    for a, b in zip(first, first[1:]):
        if b - a >= size:
            yield np.unique(all_[a : b - size + 1])
        else:
            yield tk.shingle_hashes(words[a:b], b - a) if b > a else words[:0]


def _signatures(size: int, coordinates: int):
    rng = np.random.default_rng(20240607)
    factor = rng.integers(1, 1 << 63, coordinates, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shift = rng.integers(0, 1 << 63, coordinates, dtype=np.uint64)

    def run(batches):
        for batch in batches:
            for part in tk.chunks(batch, limit=CHUNK_BYTES):
                n, one, two, signature = [], [], [], []
                for own in shingle_sets(tk.texts(part.column("text")), size):
                    n.append(len(own))
                    one.append(np.add.reduce(tk.mix(own)))
                    two.append(np.bitwise_xor.reduce(tk.mix(own ^ np.uint64(tk.BASE_B))))
                    least = np.full(coordinates, np.iinfo(np.uint64).max, dtype=np.uint64)
                    for at in range(0, len(own), _BLOCK):
                        least = np.minimum(least, (own[at : at + _BLOCK, None] * factor + shift).min(axis=0))
                    signature.append((least >> np.uint64(32)).astype(np.uint32).view(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        part.column("row"),
                        part.column("rest"),
                        pa.array(n, pa.int64()),
                        pa.array(np.array(one, dtype=np.uint64).view(np.int64)),
                        pa.array(np.array(two, dtype=np.uint64).view(np.int64)),
                        pa.ListArray.from_arrays(np.arange(len(n) + 1, dtype=np.int32) * coordinates, np.concatenate(signature)),
                    ],
                    names=["id", "row", "rest", "n", "one", "two", "signature"],
                )

    return run


def _sets(size: int):
    def run(batches):
        for batch in batches:
            for part in tk.chunks(batch, limit=CHUNK_BYTES):
                sets = list(shingle_sets(tk.texts(part.column("text")), size))
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.ListArray.from_arrays(offsets, np.concatenate(sets).view(np.int64))],
                    names=[*part.schema.names[:-1], "shingles"],
                )

    return run


class _Walk:
    """Breadth-first over rows 0 to m - 1; ``reach(x, left)`` tells which of the rows ``left`` row x is linked to."""

    def __init__(self, reach):
        self.reach = reach

    def edges(self, m: int) -> tuple[list[int], list[int]]:
        """The links by which rows are reached."""
        left, a, b = np.arange(m), [], []
        while len(left):
            queue, left = [int(left[0])], left[1:]
            while queue and len(left):
                x = queue.pop()
                hit = self.reach(x, left)
                if hit.any():
                    found = left[hit].tolist()
                    a += [x] * len(found)
                    b += found
                    queue += found
                    left = left[~hit]
        return a, b


def _sizes_allow(n: np.ndarray, x: int, left: np.ndarray, percent: int) -> np.ndarray:
    return 100 * np.minimum(n[x], n[left]) >= percent * np.maximum(n[x], n[left])


def matching(sketch: np.ndarray, n: np.ndarray, matches: int, percent: int) -> tuple[list[int], list[int]]:
    """Pairs with ``matches`` equal bytes, enough to connect all rows that such pairs connect."""

    def reach(x: int, left: np.ndarray) -> np.ndarray:
        hit = _sizes_allow(n, x, left, percent)
        some = left[hit]
        hit[hit] = (sketch[some] == sketch[x]).sum(axis=1) >= matches
        return hit

    return _Walk(reach).edges(len(sketch))


def confirmed(sets: list[np.ndarray], percent: int, first: int | None = None) -> tuple[list[int], list[int]]:
    """Links (exact similarity ``percent`` or more) that connect all rows that links connect.

    With ``first`` only links between the rows before it and the others count.
    """
    m = len(sets)
    size = np.array([len(x) for x in sets], dtype=np.int64)
    if m < 2 or not size.sum():
        return [], []
    _, ids, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(m), size)
    shared = count[ids] > 1
    if first is not None:
        side = np.zeros((2, len(count)), dtype=bool)
        side[0, ids[owner < first]] = True
        side[1, ids[owner >= first]] = True
        shared = (side[0] & side[1])[ids]
    ids, owner = ids[shared], owner[shared]
    known = np.bincount(owner, minlength=m)
    able = (100 * known >= percent * size) & (known > 0)  # a link needs that many shingles in common
    keep = able[owner]
    ids, owner = ids[keep], owner[keep]
    starts = np.searchsorted(owner, np.arange(m + 1))
    rows = np.flatnonzero(able)
    mark = np.zeros(len(count), dtype=bool)
    # what has not been reached yet, packed: rows, their ids one after the other, where each starts
    pack: dict = {"rows": rows, "ids": ids, "at": starts[rows]}

    def reach(k: int, left: np.ndarray) -> np.ndarray:
        if len(left) < len(pack["rows"]):
            pack["rows"] = rows[left]
            pack["ids"] = ids[tk.gather_ranges(starts[pack["rows"]], known[pack["rows"]])]
            pack["at"] = np.cumsum(known[pack["rows"]]) - known[pack["rows"]]
        x = rows[k]
        own = ids[starts[x] : starts[x + 1]]
        mark[own] = True
        common = np.add.reduceat(mark[pack["ids"]], pack["at"], dtype=np.int64)
        mark[own] = False
        hit = 100 * common >= percent * (size[x] + size[pack["rows"]] - common)
        if first is not None:
            hit &= (x < first) != (pack["rows"] < first)
        return hit

    a, b = _Walk(reach).edges(len(rows))
    return rows[a].tolist() if a else [], rows[b].tolist() if b else []


def _grouped(batches, keys: list[str]):
    """Rows of each group of a sorted partition, as tables."""
    held, current = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        parts = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, dtype=bool)
        for p in parts:
            change[1:] |= p[1:] != p[:-1]
        edges = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            key = tuple(p[a] for p in parts)
            if key != current and held:
                yield current, pa.Table.from_batches(held).combine_chunks()
                held = []
            current = key
            held.append(batch.slice(a, b - a))
    if held:
        yield current, pa.Table.from_batches(held).combine_chunks()


_PAIRS = "a long, b long"


def _pairs(a: list, b: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _collisions(matches: int, percent: int):
    """Arrow function over lists (token, part), sorted: class pairs of enough equal coordinates."""

    def walked(classes, n, sketch, starts):
        """The pairs of the lists that begin at ``starts``."""
        size = np.diff(np.append(starts, len(classes)))
        two = starts[size == 2]
        equal = (sketch[two] == sketch[two + 1]).sum(axis=1) >= matches
        near = equal & (100 * np.minimum(n[two], n[two + 1]) >= percent * np.maximum(n[two], n[two + 1]))
        a, b = [classes[two[near]]], [classes[two[near] + 1]]
        for start, m in zip(starts[size > 2].tolist(), size[size > 2].tolist()):
            own = slice(start, start + m)
            x, y = matching(sketch[own], n[own], matches, percent)
            a.append(classes[own][x])
            b.append(classes[own][y])
        return _pairs(np.concatenate(a), np.concatenate(b))

    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            new = [batch.column(k).to_numpy(zero_copy_only=False) for k in ("token", "part", "class", "n")]
            new.append(np.frombuffer(b"".join(batch.column("sketch").to_pylist()), dtype=np.uint8).reshape(batch.num_rows, -1))
            held = new if held is None else [np.concatenate(x) for x in zip(held, new)]
            token, part = held[:2]
            starts = np.flatnonzero(np.concatenate([[True], (token[1:] != token[:-1]) | (part[1:] != part[:-1])]))
            cut = starts[-1]  # the last list may go on in the next batch
            if cut:
                yield walked(*[x[:cut] for x in held[2:]], starts[:-1])
                held = [x[cut:] for x in held]
        if held is not None:
            yield walked(*held[2:], np.zeros(1, dtype=np.int64))

    return run


def _links(percent: int, between: bool):
    """Arrow function over blocks (label, block): confirmed links. ``between``: only those across the two sides."""

    def run(batches):
        a, b = [], []
        for _, rows in _grouped(batches, ["label", "block"]):
            classes, seen = rows.column("class").to_numpy(), set()
            side = rows.column("side").to_numpy() if between else np.zeros(len(classes), dtype=np.int32)
            flat = rows.column("shingles").chunk(0) if rows.num_rows else None
            ends = flat.offsets.to_numpy()
            values = flat.values.to_numpy().view(np.uint64)
            # rows that repeat one id and text are one class, kept once
            order = [i for i in np.argsort(side, kind="stable").tolist() if not ((c := (int(classes[i]), int(side[i]))) in seen or seen.add(c))]
            sets = [values[ends[i] : ends[i + 1]] for i in order]
            x, y = confirmed(sets, percent, int((side[order] == 0).sum()) if between else None)
            kept = classes[order]
            a += kept[x].tolist()
            b += kept[y].tolist()
            if len(a) > 50_000:
                yield _pairs(a, b)
                a, b = [], []
        yield _pairs(a, b)

    return run


def _postings(classes: DataFrame, coordinates: int, matches: int) -> DataFrame:
    """(token, class, n, sketch): each class under its rarest tokens, those that occur once left out."""
    token = F.col("at").cast("long") * F.lit(1 << 32) + F.col("value").cast("long")
    tokens = classes.select("class", F.posexplode("signature").alias("at", "value")).select("class", token.alias("token"))
    shared = tokens.groupBy("token").agg(F.count("*").alias("f")).where("f > 1")
    own = Window.partitionBy("class")
    ranked = tokens.join(shared, "token").select(
        "class", "token", F.row_number().over(own.orderBy("f", "token")).alias("rank"), F.count("*").over(own).alias("known")
    )
    # the tokens that occur once come first in the order of rarity
    kept = ranked.where(F.col("rank") + (coordinates - F.col("known")) <= coordinates - matches + 1).select("token", "class")
    return kept.join(classes.select("class", "n", "sketch"), "class")


def _dealt(postings: DataFrame) -> DataFrame:
    """Lists in parts that are walked at once: a long list is cut into blocks, and each pair of them is a part."""
    blocks = F.ceil(F.col("size") / (LIST_MEMBERS // 2)).cast("int")
    long_ = postings.groupBy("token").agg(F.count("*").alias("size")).where(F.col("size") > LIST_MEMBERS).select("token", blocks.alias("blocks"))
    own = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
    others = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda i: i != own)
    parts = F.transform(others, lambda i: F.least(i, own).cast("long") * F.col("blocks") + F.greatest(i, own))
    dealt = postings.join(small(long_), "token", "left")
    return dealt.select("token", F.explode(F.when(F.col("blocks").isNotNull(), parts).otherwise(F.array(F.lit(0).cast("long")))).alias("part"), "class", "n", "sketch")


def _in_groups(df: DataFrame, *keys: str) -> DataFrame:
    return df.repartition(shuffle_partitions(df.sparkSession), *keys).sortWithinPartitions(*keys)


def _blocked(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(``members`` with the column ``block``, the labels of more than one block).

    A component of at most ``BLOCK_SHINGLES`` (each member counts for some) is block 0.
    Larger ones are cut by size, in steps of which only neighbours can hold links,
    and each step by hash. Their number is that of all shingles over those of a block.
    """
    cost = F.sum(F.col("n") + BLOCK_SHINGLES // BLOCK_MEMBERS)
    large = members.groupBy("label").agg(cost.alias("cost")).where(F.col("cost") > BLOCK_SHINGLES).select("label")
    large = materialise(large, "large")
    step = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(4 / 3))).cast("int")
    stepped = members.withColumn("step", step)
    parts = stepped.join(F.broadcast(large), "label").groupBy("label", "step").agg(F.ceil(cost / BLOCK_SHINGLES).cast("int").alias("parts"))
    found = stepped.join(F.broadcast(parts), ["label", "step"], "left")
    block = F.col("step") * (1 << 20) + F.pmod(F.xxhash64("class"), F.col("parts")).cast("int")
    return found.withColumn("block", F.when(F.col("parts").isNotNull(), block).otherwise(0)).drop("step", "parts"), large


def near_links(classes: DataFrame, texts: DataFrame, size: int, coordinates: int, matches: int, percent: int) -> DataFrame:
    """(node, label) of every class that some link reaches. ``classes``: class, n,
    signature and the id and row of one member; ``texts``: id, row, text."""
    # a byte of each coordinate: equal coordinates have equal bytes
    byte = F.transform("signature", lambda v: F.lpad(F.hex(v.bitwiseAND(255)), 2, "0"))
    posted = _postings(classes.withColumn("sketch", F.unhex(F.array_join(byte, ""))), coordinates, matches)
    posted = materialise(posted, "postings")
    alike = materialise(_in_groups(_dealt(posted), "token", "part").mapInArrow(_collisions(matches, percent), _PAIRS).distinct(), "alike")
    drop_scratch(posted)
    labels = components(alike)

    # all classes of a component, in blocks; the one with most pairs is in each block of a large one
    degree = alike.select(F.explode(F.array("a", "b")).alias("class")).groupBy("class").agg(F.count("*").alias("degree"))
    labels = labels.withColumnRenamed("node", "class")
    members = classes.select("class", "n", "id", "row").join(labels, "class").join(degree, "class")
    members, large = _blocked(members)
    members = materialise(members, "members")
    wanted = texts.join(small(members.select("class", "id", "row", "label", "block")), ["id", "row"]).select("class", "label", "block", "text")
    sets = materialise(wanted.mapInArrow(_sets(size), "class long, label long, block int, shingles array<long>"), "sets")
    some_large = not large.isEmpty()
    met = sets
    if some_large:
        big = members.join(F.broadcast(large), "label")
        hubs = big.groupBy("label").agg(F.max_by("class", F.struct("degree", "class")).alias("class"))
        blocks = big.groupBy("label", "block").agg(F.min("n").alias("low"), F.max("n").alias("high"))
        blocks = materialise(blocks.join(hubs.withColumnRenamed("class", "hub"), "label"), "blocks")
        hub_sets = sets.join(F.broadcast(blocks.select("label", F.col("hub").alias("class"), F.col("block").alias("other"))), ["label", "class"])
        met = sets.unionByName(hub_sets.where("block != other").select("class", "label", F.col("other").alias("block"), "shingles"))
    links = materialise(_in_groups(met, "label", "block").mapInArrow(_links(percent, False), _PAIRS), "links")
    if some_large:
        links = links.unionByName(_between_blocks(big, blocks, sets, links, percent))
    found = components(links)
    drop_scratch(sets)
    return found


def _between_blocks(big: DataFrame, blocks: DataFrame, sets: DataFrame, links: DataFrame, percent: int) -> DataFrame:
    """Links across the blocks of large components: what its block has not linked to
    the hub meets all blocks of fitting sizes."""
    reached = components(links).withColumnsRenamed({"label": "found", "node": "class"})
    hubs = blocks.select("label", F.col("hub").alias("class")).distinct()
    main = hubs.join(reached, "class", "left").select("label", F.coalesce("found", "class").alias("main"))
    state = big.select("label", "class", "n").join(reached, "class", "left").join(F.broadcast(main), "label")
    apart, _ = _blocked(state.where(F.coalesce("found", "class") != F.col("main")).select("label", "class", "n"))
    apart = materialise(apart.withColumnRenamed("block", "own"), "apart")
    ours = apart.groupBy("label", "own").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    meet = ours.join(F.broadcast(blocks), "label").where((100 * F.col("high") >= percent * F.col("least")) & (100 * F.col("most") >= percent * F.col("low")))
    meet = materialise(meet.select("label", "own", "block", F.xxhash64("own", "block").alias("pair")), "meet")
    whole = sets.join(F.broadcast(blocks.select("label").distinct()), "label", "left_semi")
    one = whole.drop("block").join(apart.select("class", "own"), "class").join(small(meet.select("label", "own", "pair")), ["label", "own"])
    two = whole.join(small(meet.select("label", "block", "pair")), ["label", "block"])
    both = [x.select("class", "label", F.col("pair").alias("block"), F.lit(n).alias("side"), "shingles") for n, x in enumerate((one, two))]
    more = _in_groups(both[0].unionByName(both[1]), "label", "block").mapInArrow(_links(percent, True), _PAIRS)
    return materialise(more, "links")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SHINGLE,
    percent: int = PERCENT,
    coordinates: int = COORDINATES,
    matches: int = MATCHES,
) -> DataFrame:
    """One row per input row: ``id, n_shingles, component_id`` (the smallest id
    its links reach, itself included), ``kept`` (whether that is its own id),
    and all other columns in the struct ``rest``."""
    source = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.xxhash64(text_col).alias("row"),  # tells rows of one id with different texts apart
        F.col(text_col).alias("text"),
        packed_rest(docs, id_col, text_col).alias("rest"),
    )
    kind = source.schema["rest"].dataType.simpleString()
    signed = materialise(
        source.mapInArrow(
            _signatures(size, coordinates), f"id long, row long, rest {kind}, n long, one long, two long, signature array<int>"
        ).withColumn("class", F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.xxhash64("n", "one", "two"))),
        "signatures",
    )
    classes = materialise(
        signed.where("class IS NOT NULL")
        .groupBy("class")
        .agg(F.min(F.struct("id", "row")).alias("one"), F.first("n").alias("n"), F.first("signature").alias("signature"))
        .select("class", "one.id", "one.row", "n", "signature"),
        "signed",
    )
    labels = near_links(classes, source.select("id", "row", "text"), size, coordinates, matches, percent)
    labelled = classes.select("class", "id").join(labels, F.col("class") == F.col("node"), "left").select(
        "class", "id", F.coalesce("label", "class").alias("label")
    )
    least = labelled.groupBy("label").agg(F.min("id").alias("least_id"))
    per_class = labelled.join(least, "label").select("class", "least_id")
    component = F.coalesce("least_id", "id")
    return signed.join(per_class, "class", "left").select(
        "id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
        "row",
        "rest",
    )
