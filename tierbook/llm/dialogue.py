"""Conversation structure repair by Four-Russians block tables.

A conversation is right if its roles read ``(s?(ua)+)?``: an optional system
turn, then user and assistant in turns, or nothing at all. The cheapest edits
are found by dynamic programming over the four states of that pattern: keep a
row (0), give it the role user or assistant (3), delete it (4; a must for blank
and repeated rows), insert an empty user or assistant turn (3); a truncated row
that stays costs 3 more. Of equally cheap edits the one whose initials come
first as ASCII text is taken.

Each row is one of nine symbols. The vector of costs to the end, one per state,
takes few values once its minimum is taken off, so the tables hold for every
such vector and every block of ``BLOCK`` symbols the vector before the block
and the cost that was taken off. Conversations are processed from their end, a
block per lookup; then each block is expanded backward row by row, and the
edits are read off forward, the smallest initial that keeps the cost first.

Scale: equal rows are one row with a count, first occurrences come from an
aggregation, and rows are put in order by a range partitioning on
conversation, turn, role and text, so that one conversation may span many
tasks. Symbols travel as segments of at most ``SEGMENT`` rows, a byte a row.
The two passes that need a conversation in order stream its segments (from the
end) and its rows (from the start) through a task that holds one segment.

Edge cases: nulls in any column read as one space (a null conversation is one
of its own, a null turn comes before all others); rows of one turn are ordered
by role, then text; roles with other initials can't be kept; conversations
without rows give nothing here and zeros in ``digests``; an empty table gives
an empty result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import left_join_dimension
from .scratch import materialise, shuffle_partitions

BLOCK = 4
SEGMENT_BITS = 12
SEGMENT = 1 << SEGMENT_BITS
COPIES = 64
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
SPACE = " \t\n\x0b\x0c\r"
FAULTS = (None, "blank", "duplicate", "truncated")
BATCH_BYTES = 1 << 20

# states: nothing yet, after the system turn, after a user turn, after an assistant turn
START, SYSTEM, USER, ASSISTANT = range(4)
TURN = (USER, USER, ASSISTANT, USER)  # the state after the turn that may follow
NAME = {USER: "user", ASSISTANT: "assistant"}
KEEP = {0: {START: SYSTEM}, 1: {START: USER, SYSTEM: USER, ASSISTANT: USER}, 2: {USER: ASSISTANT}, 3: {}}
# symbols: a row that must go, then initial (s, u, a, other) + 1, and 4 more where it is truncated
SYMBOLS = 9
CODE_LETTER = 65  # codes (initial + 4 * fault) travel as letters
_SYMBOL = np.array([1 + c % 4 + 4 * (c // 4 == 3) if c // 4 in (0, 3) else 0 for c in range(16)])
END = (0, 6, 3, 0)  # costs to complete the pattern by insertions


def _options(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """(initial, cost, next state) of the edits that use up a row."""
    found = [("D", DELETE, state)]
    if symbol:
        initial, late = (symbol - 1) % 4, TRUNCATED * (symbol > 4)
        if state in KEEP[initial]:
            found.append(("K", late, KEEP[initial][state]))
        found.append(("R", REROLE + late, TURN[state]))
    return found


def _before(symbol: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """Costs to the end before a row, insertions in front of it included."""
    cost = [min(c + after[t] for _, c, t in _options(symbol, s)) for s in range(4)]
    cost[USER] = min(cost[USER], INSERT + cost[ASSISTANT])
    return tuple(min(c, INSERT + cost[USER]) if s != USER else c for s, c in enumerate(cost))


class Tables:
    """The lookup tables: single steps, blocks, and the edits read off at a row."""

    def __init__(self, block: int = BLOCK):
        self.block = block
        ids, todo, steps = {END: 0}, [END], []
        for vector in todo:  # grows while it is read
            row = []
            for symbol in range(SYMBOLS):
                found = _before(symbol, vector)
                least = min(found)
                found = tuple(c - least for c in found)
                if found not in ids:
                    ids[found] = len(todo)
                    todo.append(found)
                row.append((ids[found], least))
            steps.append(row)
        self.vectors = todo
        self.step = np.array([[v for v, _ in row] for row in steps])
        self.taken = np.array([[c for _, c in row] for row in steps])
        # block table: symbols of a block as one number, the first symbol highest; built from the last symbol on
        self.place = SYMBOLS ** np.arange(block - 1, -1, -1)
        blocks = np.arange(SYMBOLS**block)
        v = np.repeat(np.arange(len(todo))[:, None], len(blocks), axis=1)
        cost = np.zeros_like(v)
        for k in range(block - 1, -1, -1):
            x = blocks // self.place[k] % SYMBOLS
            cost += self.taken[v, x]
            v = self.step[v, x]
        self.block_step, self.block_taken = v, cost
        # edits of a row by (vector after it, symbol, state before it)
        self.edits = {
            (a, x, s): self._edits(a, x, s) for a, x, s in itertools.product(range(len(todo)), range(SYMBOLS), range(4))
        }

    def _edits(self, after: int, symbol: int, state: int) -> tuple[str, int]:
        """(initials, next state): insertions before the row, then the edit that uses it up."""
        vector, now, out = self.vectors[after], _before(symbol, self.vectors[after]), ""
        while True:
            moves = [(i, c + vector[t], t) for i, c, t in _options(symbol, state)]
            moves.append(("I", INSERT + now[TURN[state]], TURN[state]))
            initial, _, state = min(m for m in moves if m[1] == now[state])
            out += initial
            if initial != "I":
                return out, state

    def pass_back(self, symbols: np.ndarray, after: int) -> tuple[np.ndarray, int, int]:
        """Vectors after each block of a segment, given the one at its end; the vector before it and the cost taken off."""
        lead = len(symbols) % self.block
        numbers = symbols[lead:].reshape(-1, self.block) @ self.place
        bounds = np.empty(len(numbers), dtype=np.int64)
        v, cost = after, 0
        for k in range(len(numbers) - 1, -1, -1):
            bounds[k] = v
            cost += int(self.block_taken[v, numbers[k]])
            v = int(self.block_step[v, numbers[k]])
        for x in symbols[:lead][::-1]:
            cost += int(self.taken[v, x])
            v = int(self.step[v, x])
        return bounds, v, cost

    def expand(self, symbols: np.ndarray, after: int) -> np.ndarray:
        """The vector after each row: all blocks are expanded backward at once."""
        bounds, _, _ = self.pass_back(symbols, after)
        lead = len(symbols) % self.block
        rows = np.empty(len(symbols), dtype=np.int64)
        body, inside = symbols[lead:].reshape(-1, self.block), rows[lead:].reshape(-1, self.block)
        v = bounds
        for k in range(self.block - 1, -1, -1):
            inside[:, k] = v
            v = self.step[v, body[:, k]]
        v = int(v[0]) if len(v) else after
        for i in range(lead - 1, -1, -1):
            rows[i] = v
            v = int(self.step[v, symbols[i]])
        return rows

    def trace(self, symbols: np.ndarray, after: int, state: int) -> tuple[list[tuple[str, int]], int]:
        """Per row its edits' initials and the state before it; and the state at the end."""
        out = []
        for v, x in zip(self.expand(symbols, after).tolist(), symbols.tolist()):
            letters, new = self.edits[v, x, state]
            out.append((letters, state))
            state = new
        return out, state


_TABLES: list[Tables] = []


def tables() -> Tables:
    """The tables, built once per process (some ten thousand entries)."""
    if not _TABLES:
        _TABLES.append(Tables())
    return _TABLES[0]


def symbols_of(codes: bytes) -> np.ndarray:
    return _SYMBOL[np.frombuffer(codes, dtype=np.uint8) - CODE_LETTER]


def _backward(batches):
    """Arrow function over segments, each conversation's last first: adds the vectors on both sides and the cost taken off."""
    t, current, v = tables(), object(), 0
    for batch in batches:
        right, left, taken = [], [], []
        for conv, codes in zip(batch.column("conv_id").to_pylist(), batch.column("codes").to_pylist()):
            if conv != current:
                current, v = conv, 0
            right.append(v)
            _, v, cost = t.pass_back(symbols_of(codes.encode()), v)
            left.append(v)
            taken.append(cost)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(right, pa.int32())], names=[*batch.schema.names, "after"]
        )


_OUT = ("pos", "op", "cost", "role", "text", "fault", "was")


def _repaired(id_type: str):
    """Arrow function over segment heads and rows in order: one row per edit."""

    def run(batches):
        t = tables()
        out, held = [], 0
        state = dict(conv=object(), at=START, pos=0, codes=b"", edits=[], next=0)

        def emit(op, cost, role=None, text=None, code=None):
            nonlocal held
            fault, was = (None, None) if code is None else (FAULTS[code // 4], "sua?"[code % 4])
            out.append((state["conv"], state["pos"], op, cost, role, text, fault, was))
            state["pos"] += 1
            held += 100 + len(text or "")

        def turns(letters, at, code, role, text):
            """The edits of one row."""
            for op in letters:
                new = TURN[at]
                if op == "I":
                    emit("I", INSERT, NAME[new], "")
                    at = new
                elif op == "D":
                    emit("D", DELETE, None, text, code)
                else:
                    late = TRUNCATED * (code // 4 == 3)
                    emit(op, late + REROLE * (op == "R"), role if op == "K" else NAME[new], text, code)

        def forced():
            """Rows that must go and carry no text, up to the next row that does."""
            while state["next"] < len(state["codes"]):
                code = state["codes"][state["next"]] - CODE_LETTER
                if _SYMBOL[code]:
                    return
                turns(*state["edits"][state["next"]], code, None, None)
                state["next"] += 1

        def finish():
            """Complete the pattern after the last row."""
            forced()
            at = state["at"]
            while at in (SYSTEM, USER):
                at = TURN[at]
                emit("I", INSERT, NAME[at], "")

        def flush():
            nonlocal out, held
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string()]
            columns = list(zip(*out)) if out else [[]] * 8
            arrays = [pa.array(columns[0], id_type)] + [pa.array(c, k) for c, k in zip(columns[1:], kinds)]
            out, held = [], 0
            return pa.RecordBatch.from_arrays(arrays, names=["conv_id", *_OUT])

        started = False
        for batch in batches:
            col = {n: batch.column(n).to_pylist() for n in ("conv_id", "codes", "after", "role")}
            text = batch.column("text")
            for i, conv in enumerate(col["conv_id"]):
                if not started or conv != state["conv"]:
                    if started:
                        finish()
                    started = True
                    state.update(conv=conv, at=START, pos=0, codes=b"", edits=[], next=0)
                if col["codes"][i] is not None:  # a segment's head
                    forced()
                    codes = col["codes"][i].encode()
                    edits, at = t.trace(symbols_of(codes), col["after"][i], state["at"])
                    state.update(at=at, codes=codes, edits=edits, next=0)
                else:
                    forced()
                    k = state["next"]
                    state["next"] += 1
                    turns(*state["edits"][k], state["codes"][k] - CODE_LETTER, col["role"][i], text[i].as_py())
                if held >= BATCH_BYTES:
                    yield flush()
        if started:
            finish()
        yield flush()

    return run


def _code(initial: Column, fault: Column) -> Column:
    return F.char(F.lit(CODE_LETTER) + initial + 4 * fault)


def marked(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, copies) in order: (at, conv_id, role, text, codes).

    Equal rows are one row with a code per copy; ``text`` is null where every
    copy must go.
    """
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    once = F.concat(F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("-")), F.lit("\n"), F.col("role"), F.lit("\n"), F.col("text"))
    rows = materialise(rows.withColumn("same", F.sha2(once, 256)), "turns")
    order = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = rows.groupBy("same").agg(F.min(order).alias("first"), F.count("*").alias("turns")).where("turns > 1")
    first = first.select("same", F.col("first.known").alias("known"), F.col("first.turn").alias("first"))
    found = left_join_dimension(rows, first, "same")
    again = F.col("known").isNotNull() & ~((F.col("turn").isNotNull() == F.col("known")) & F.col("turn").eqNullSafe(F.col("first")))
    bare = F.rtrim(F.col("text"), F.lit(SPACE))
    initial = F.coalesce(F.nullif(F.instr(F.lit("sua"), F.left("role", F.lit(1))), F.lit(0)), F.lit(4)) - 1
    initial = F.when(F.col("role") == "", F.lit(3)).otherwise(initial)
    fault = F.when(bare == "", 1).when(again, 2).when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), 3).otherwise(0)
    blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) div {COPIES}")))
    found = found.select("conv_id", "turn", "role", "text", "copies", initial.alias("initial"), fault.alias("fault"), blocks.alias("block"))
    keys = ["conv_id", "turn", "role", "text", "block"]
    found = found.repartitionByRange(shuffle_partitions(rows.sparkSession), *keys).sortWithinPartitions(*keys)
    later = F.when(F.col("fault") == 1, 1).otherwise(2)
    head = F.when(F.col("block") == 0, F.col("fault")).otherwise(later)
    here = F.least(F.lit(COPIES), F.col("copies") - F.col("block") * COPIES).cast("int")
    codes = F.concat(_code(F.col("initial"), head), F.repeat(_code(F.col("initial"), later), here - 1))
    stays = head.isin(0, 3)
    found = found.select(
        F.monotonically_increasing_id().alias("at"), "conv_id", F.when(stays, F.col("role")).alias("role"), F.when(stays, F.col("text")).alias("text"), codes.alias("codes")
    )
    return materialise(found, "ordered")


def repair(rows: DataFrame) -> DataFrame:
    """The cheapest edits of every conversation of ``rows`` (conv_id, turn, role, text, copies).

    One row per edit, in order of ``pos``: ``op`` (K, R, D, I), its ``cost``,
    ``role`` and ``text`` after it (a deleted row has no role), and of the row it
    edits the ``fault`` and role's initial ``was`` (``?``: another one). The rows of
    a conversation lie in one partition, in order.
    """
    spark = rows.sparkSession
    ordered = marked(rows)
    seg = F.shiftright("at", SEGMENT_BITS).alias("seg")
    parts = F.sort_array(F.collect_list(F.struct("at", "codes")))
    segments = ordered.groupBy("conv_id", seg).agg(F.array_join(F.transform(parts, lambda p: p["codes"]), "").alias("codes"))
    n, kind = shuffle_partitions(spark), rows.schema["conv_id"].dataType.simpleString()
    segments = segments.repartition(n, "conv_id").sortWithinPartitions("conv_id", F.col("seg").desc())
    heads = segments.mapInArrow(_backward, f"conv_id {kind}, seg long, codes string, after int")
    heads = heads.select("conv_id", "seg", F.lit(-1).cast("long").alias("at"), "codes", "after", F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
    empty = F.lit(None)
    texts = ordered.where("text IS NOT NULL").select("conv_id", seg, "at", empty.cast("string").alias("codes"), empty.cast("int").alias("after"), "role", "text")
    stream = heads.unionByName(texts).repartition(n, "conv_id").sortWithinPartitions("conv_id", "seg", "at")
    id_type = pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()
    schema = f"conv_id {kind}, pos long, op string, cost long, role string, text string, fault string, was string"
    return stream.mapInArrow(_repaired(id_type), schema)


def _digest(id_type: pa.DataType):
    """Arrow function over the edits in order: one row per conversation."""

    def run(batches):
        current, started, out = None, False, []
        count, cost, audit, sha, first, last = {}, 0, [], None, True, None

        def row():
            return (current, count["blank"], count["duplicate"], count["truncated"], count["illegal"], cost, "".join(audit), sha.hexdigest())

        def flush():
            columns = list(zip(*out)) if out else [[]] * 8
            kinds = [id_type, *[pa.int64()] * 5, pa.string(), pa.string()]
            names = ["conv_id", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        for batch in batches:
            for r in batch.to_pylist():
                if not started or r["conv_id"] != current:
                    if started:
                        out.append(row())
                    started, current = True, r["conv_id"]
                    count = dict(blank=0, duplicate=0, truncated=0, illegal=0)
                    cost, audit, sha, first, last = 0, [], hashlib.sha256(), True, None
                cost += r["cost"]
                audit.append(r["op"])
                if r["op"] != "D":
                    sha.update((b"" if first else b"\n") + f"{r['role']}:{r['text']}".encode())
                    first = False
                if r["was"] is not None:
                    if r["fault"]:
                        count[r["fault"]] += 1
                    count["illegal"] += last is not None and last + r["was"] not in ("su", "ua", "au")
                    last = r["was"]
            if len(out) >= 1000:
                yield flush()
                out = []
        if started:
            out.append(row())
        yield flush()

    return run


def digests(repaired: DataFrame) -> DataFrame:
    """Per conversation its faults, cost, audit (the edits' initials) and the hash of the repaired ``role:text`` lines."""
    kind = repaired.schema["conv_id"].dataType.simpleString()
    id_type = pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()
    return repaired.mapInArrow(
        _digest(id_type), f"conv_id {kind}, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    )


def damage(rows: DataFrame) -> DataFrame:
    """Faults planted by the row's key: (conv_id, turn, role, text, copies)."""
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = rows.select("conv_id", "turn", *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")], (F.crc32(key.cast("binary")) % 20).alias("fate"))
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fate") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("fate") == 3, 2).otherwise(1).cast("long")
    return rows.where("fate != 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copies"))


def report(rows: DataFrame, damaged: DataFrame) -> DataFrame:
    """One row per conversation of ``rows``: the gaps in the turns of ``damaged`` and ``digests`` of its repair."""
    turns = damaged.groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn")).cast("long").alias("gaps"))
    found = digests(repair(damaged))
    all_ids = rows.select("conv_id").distinct()
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")

    def joined(a: DataFrame, b: DataFrame) -> DataFrame:
        b = b.withColumnRenamed("conv_id", "other")
        return a.join(b, a["conv_id"].eqNullSafe(b["other"]), "left").drop("other")

    return joined(joined(all_ids, turns), found).select(
        "conv_id",
        *[F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
