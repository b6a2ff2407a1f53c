import functools
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierbook.llm import dialogue as di

SCHEMA = "conv_id long, turn long, role string, text string, id string, at string, codes int, `other` string"
AFTER = {"": "u", "s": "u", "u": "a", "a": "u"}


def cheapest(rows):
    """rows: (initial, fault). (cost, audit) by trying every edit, insertions two in a row."""

    @functools.cache
    def best(i, state, inserted):
        found = []
        if i == len(rows) and state in ("", "a"):
            found.append((0, ""))
        moves = []
        if inserted < 2:
            moves.append((3, "I", i, AFTER[state], inserted + 1))
        if i < len(rows):
            initial, fault = rows[i]
            moves.append((4, "D", i + 1, state, 0))
            if fault not in ("blank", "duplicate"):
                late = 3 if fault == "truncated" else 0
                moves.append((3 + late, "R", i + 1, AFTER[state], 0))
                if (initial == AFTER[state]) or (initial == "s" and state == ""):
                    moves.append((late, "K", i + 1, initial, 0))
        for cost, letter, j, new, n in moves:
            c, audit = best(j, new, n)
            found.append((cost + c, letter + audit))
        return min(found, default=(10**9, "~"))

    return best(0, "", 0)


def brute(rows):
    """One row per conversation of (conv_id, turn, role, text), as the contract says."""
    out = {}
    for conv in {r[0] for r in rows}:
        after = []
        for c, turn, role, text in rows:
            if c != conv:
                continue
            fate = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            role, text = " " if role is None else role, " " if text is None else text
            if fate == 0:
                continue
            text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
            after += [(turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
        after.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, marked = set(), []
        for _, role, text in after:
            bare = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            marked.append((role[:1], fault))
        cost, audit = cheapest(tuple(marked))
        lines, state, i = [], "", 0
        for op in audit:
            if op != "D":
                new = marked[i][0] if op == "K" else AFTER[state]
                role = after[i][1] if op == "K" else {"u": "user", "a": "assistant"}[new]
                lines.append(f"{role}:{'' if op == 'I' else after[i][2]}")
                state = new
            i += op != "I"
        turns = [r[0] for r in after if r[0] is not None]
        pairs = [a[0] + b[0] for a, b in zip(marked, marked[1:])]
        faults = [m[1] for m in marked]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def _rows(seed, conversations=60, longest=30):
    rng = random.Random(seed)
    rows = []
    for conv in range(conversations):
        turn = 0
        for k in range(rng.choice([1, 2, 4, longest])):
            turn += rng.choice([0, 1, 1, 1, 1, 2])
            role = rng.choice(["user", "assistant"] * 6 + ["system", "tool", "", None, "Assistant"]) if rng.random() < 0.4 else ("user", "assistant")[k % 2]
            text = rng.choice(["Fine.", "ok", "again!", None, " \n", "é ü?  \t", f"text {rng.randint(0, 99)}.", "x.\x0b", "end. "])
            rows.append((conv, rng.choice([turn] * 12 + [None]), role, text))
    rows += [(None, 1, "user", "of no conversation."), (None, None, "assistant", "of no turn.")]
    rows += [(900, 1, "user", "the same row.")] * 40 + [(901, t, "user", "the same text.") for t in range(300)]
    rows += [(902, 5, "user", "long " * 30_000 + "."), (902, 6, "assistant", "yes.")]
    rows += [(c, t, "user", "gone.") for c in range(1000, 1400) for t in (1,) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    return rows


def _table(spark, rows):
    return spark.createDataFrame([(*r, "i", "a", 3, None) for r in rows], SCHEMA).repartition(3)


def _found(spark, rows):
    docs = _table(spark, rows)
    return {r["conv_id"]: tuple(r)[1:] for r in di.report(docs, di.damage(docs)).collect()}


def test_matches_brute_force(spark):
    rows = _rows(5)
    got, want = _found(spark, rows), brute(rows)
    assert got.keys() == want.keys()
    for conv in want:
        assert got[conv] == want[conv], conv


def test_segments_and_copies_make_no_difference(spark, monkeypatch):
    """A conversation over many segments, equal rows over many blocks."""
    monkeypatch.setattr(di, "SEGMENT_BITS", 2)
    monkeypatch.setattr(di, "COPIES", 3)
    rows = _rows(6, 25, 45)
    assert _found(spark, rows) == brute(rows)


@pytest.mark.parametrize("block", [1, 2, 3, 5])
def test_block_tables(block):
    t, one = di.Tables(block), di.Tables(1)
    assert t.vectors == one.vectors
    rng = np.random.default_rng(block)
    for n in (0, 1, 2, 7, 60):
        symbols = rng.integers(0, di.SYMBOLS, n)
        v, cost = 0, 0
        after = np.empty(n, dtype=np.int64)
        for i in range(n - 1, -1, -1):
            after[i] = v
            cost += int(one.taken[v, symbols[i]])
            v = int(one.step[v, symbols[i]])
        _, left, taken = t.pass_back(symbols, 0)
        assert (left, taken) == (v, cost)
        assert (t.expand(symbols, 0) == after).all()
        faults = {0: "blank"}
        rows = tuple(("sua?"[(x - 1) % 4] if x else "u", "truncated" if x > 4 else faults.get(x)) for x in symbols.tolist())
        want_cost, audit = cheapest(rows)
        assert taken + t.vectors[left][0] == want_cost
        edits, state = t.trace(symbols, 0, di.START)
        tail = {di.START: "", di.SYSTEM: "II", di.USER: "I", di.ASSISTANT: ""}[state]
        assert "".join(e for e, _ in edits) + tail == audit


def test_repaired_rows(spark):
    rows = [(1, 1, "assistant", "Hello there."), (1, 2, "user", "cut off"), (1, 2, "user", ""), (1, 3, "system", "Late.")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, copies long")
    found = [(r["op"], r["role"], r["text"], r["fault"], r["cost"]) for r in di.repair(docs).orderBy("pos").collect()]
    assert "".join(f[0] for f in found) == cheapest((("a", None), ("u", "blank"), ("u", "truncated"), ("s", None)))[1]
    kept = [f[1] for f in found if f[0] != "D"]
    assert kept == ["user", "assistant"] * (len(kept) // 2)
    assert {f[3] for f in found} >= {"blank"} and all(f[1] is None for f in found if f[0] == "D")


def test_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert di.report(empty, di.damage(empty)).count() == 0
    assert di.repair(di.damage(empty)).count() == 0


def test_long_conversation_is_spread(spark):
    rows = spark.range(20_000).select(
        F.lit(7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("turn "), F.col("id"), F.lit(".")).alias("text"), F.lit(1).cast("long").alias("copies"),
    )
    ordered = di.marked(rows)
    assert ordered.select(F.expr("at >> 33").alias("part")).distinct().count() == 4
    row = di.digests(di.repair(rows)).first()
    assert (row["cost"], row["audit"]) == (0, "K" * 20_000)
