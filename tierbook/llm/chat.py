"""Chat formatting by incremental black-box rendering.

A template is any function from a list of turns (role, text) to a string; it
is never looked into. Each conversation is rendered turn by turn: the output
for the turns up to one is compared with the output for the turns before it.
What was added is the turn's span; inside it the text's own span is found by
rendering the turn with an empty text and with a probe character that the
output lacks: texts begin where these two outputs part. A template whose longer output does not
begin with the shorter one *rewrites history*; the conversation is flagged,
and the whole span from the first changed character on counts as the turn's.

Conversations are streamed: rows are dealt by conversation and sorted by turn,
and one turn is read at a time. Every turn is rendered after all turns before
it, so a task holds the turns and the last output of one conversation, and the
work grows with the square of its length: a black box has to be given the whole
prefix. A caller who knows that a template writes each turn alone, whatever
stands before it, declares it ``turn_local``; then rendering uses the first
turn and the last ``CONTEXT`` turns before the present one, and the work per
turn is bounded however long a conversation grows. The output is one row per
turn; digests over a conversation are running hashes of one pass.

Edge cases: null roles and texts count as empty; turns that tie are ordered by
role, then text; null turns come first; rows with a null conversation id form
one conversation; repeated rows are turns of their own; an empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import shuffle_partitions

CONTEXT = 15
BATCH_ROWS = 2000

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

# The control strings of the default template. Any of them inside a role or
# text is written with a mark after its first character, and the mark itself
# is doubled, so that reading back is exact.
BEGIN, END, HEAD_OPEN, HEAD_CLOSE = "<s>", "</s>", "[INST]", "[/INST]"
_MARK = "\u0001"
_CONTROL = re.compile(r"<s>|</s>|\[INST\]|\[/INST\]|\u0001")
_ESCAPED = re.compile(r"\u0001\u0001|([<\[])\u0001")


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: _MARK * 2 if m[0] == _MARK else m[0][0] + _MARK + m[0][1:], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1] or _MARK, text)


def inst_template(turns: list[Turn]) -> str:
    """``<s>role[INST] text [/INST]</s>`` for each turn, control strings escaped."""
    return "".join(f"{BEGIN}{escape(role)}{HEAD_OPEN} {escape(text)} {HEAD_CLOSE}{END}" for role, text in turns)


_TURN = re.compile(r"<s>(.*?)\[INST\] (.*?) \[/INST\]</s>", re.DOTALL)


def read_inst(formatted: str) -> list[Turn]:
    """The turns of ``inst_template``'s output."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def common_prefix(a: str, b: str) -> int:
    """Number of leading characters that both share (halving; whole-string comparisons only)."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if a[low:middle] == b[low:middle] else (low, middle)
    return low


def render_turn(template: Template, before: list[Turn], turn: Turn) -> tuple[str, int, int, bool]:
    """(added output, start and end of the text inside it, whether history was rewritten)."""
    return _rendered(template, before, turn, template(before))[0]


def _rendered(template: Template, before: list[Turn], turn: Turn, shorter: str) -> tuple[tuple[str, int, int, bool], str]:
    """``render_turn``'s result, given the output for the turns before; and the output with the turn."""
    longer = template([*before, turn])
    empty = template([*before, (turn[0], "")])
    probe = next(c for c in map(chr, range(0xE000, 0xF8FF)) if c not in empty)
    marked = template([*before, (turn[0], probe)])
    start = common_prefix(shorter, longer)
    # a text that stands in no rendered frame parts from the empty one exactly where texts begin
    front = max(0, common_prefix(marked, empty) - start)
    return (longer[start:], front, front + len(longer) - len(empty), start < len(shorter)), longer


def _streamed(rows: Iterable[tuple], turn_local: bool) -> Iterator[tuple]:
    """(conversation, index, turn, turns before) of rows in order; of a turn-local template's the first turn and the last ones are held."""
    current, index, first, recent = object(), 0, None, []
    for conv, role, text in rows:
        if conv != current:
            current, index, first, recent = conv, 0, None, []
        turn = (role or "", text or "")
        cut = turn_local and index > CONTEXT
        yield conv, index, turn, [first, *recent[-CONTEXT:]] if cut else recent
        first = first or turn
        recent.append(turn)
        if turn_local and index >= CONTEXT:
            del recent[:-CONTEXT]
        index += 1


def _format(template: Template, loss_roles: frozenset[str], turn_local: bool):
    names = ["conv_id", "index", "role", "formatted", "text_from", "text_to", "in_loss", "rewrites"]

    def rows(batches):
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")))

    def run(batches):
        held, output = [], ""
        for conv, index, turn, before in _streamed(rows(batches), turn_local):
            shorter = output if 0 < index <= len(before) else template(before)
            (added, start, end, rewrites), output = _rendered(template, before, turn, shorter)
            held.append((conv, index, turn[0], added, start, end, turn[0] in loss_roles, rewrites))
            if len(held) >= BATCH_ROWS:
                yield _batch(held, names, FORMATTED)
                held = []
        if held:
            yield _batch(held, names, FORMATTED)

    return run


FORMATTED = pa.schema(
    [("conv_id", pa.int64()), ("index", pa.int64()), ("role", pa.string()), ("formatted", pa.string()), ("text_from", pa.int64()),
     ("text_to", pa.int64()), ("in_loss", pa.bool_()), ("rewrites", pa.bool_())]
)
DIGESTS = pa.schema(
    [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()),
     ("formatted_chars", pa.int64()), ("rewrites", pa.bool_())]
)


def _batch(rows: list[tuple], names: list[str], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, schema.field(n).type) for c, n in zip(zip(*rows), names)], schema=schema)


def format_conversations(
    conversations: DataFrame,
    template: Template = inst_template,
    loss_roles: frozenset[str] = frozenset({"assistant"}),
    turn_local: bool | None = None,
) -> DataFrame:
    """One row per turn, in order inside each task's rows: ``conv_id, index`` (from 0), ``role, formatted``
    (what the turn adds to the conversation's output), ``text_from, text_to`` (its text inside that),
    ``in_loss`` (whether the text is under the loss mask), ``rewrites`` (whether the template changed earlier output).

    ``turn_local``: the caller's word that the template's output is that of each turn alone, joined; only
    ``inst_template``, which is known to be so, counts as such by default."""
    turn_local = template is inst_template if turn_local is None else turn_local
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    dealt = rows.repartition(shuffle_partitions(rows.sparkSession), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    kinds = "conv_id long, index long, role string, formatted string, text_from long, text_to long, in_loss boolean, rewrites boolean"
    return dealt.select("conv_id", "role", "text").mapInArrow(_format(template, loss_roles, turn_local), kinds)


def _digest(read: Callable[[str], list[Turn]]):
    """Arrow function over ``format_conversations``' rows in order: what can be read back of each conversation."""

    def run(batches):
        out, current, state = [], object(), None

        def closed():
            return (current, state["n"], state["turns"].hexdigest(), state["chars"], state["loss"].hexdigest(), state["size"], state["rewrites"])

        for batch in batches:
            for row in batch.to_pylist():
                if row["conv_id"] != current:
                    if state:
                        out.append(closed())
                    current = row["conv_id"]
                    state = {"n": 0, "turns": hashlib.sha256(), "loss": hashlib.sha256(), "chars": 0, "size": 0, "rewrites": False}
                for role, text in read(row["formatted"]):
                    state["n"] += 1
                    state["turns"].update(f"{role}\n{text}\n".encode())
                if row["in_loss"]:
                    text = unescape(row["formatted"][row["text_from"] : row["text_to"]])
                    state["loss"].update(text.encode())
                    state["chars"] += len(text)
                state["size"] += len(row["formatted"])
                state["rewrites"] |= row["rewrites"]
            if len(out) >= BATCH_ROWS:
                yield _batch(out, DIGESTS.names, DIGESTS)
                out = []
        if state:
            out.append(closed())
        if out:
            yield _batch(out, DIGESTS.names, DIGESTS)

    return run


def digests(formatted: DataFrame, read: Callable[[str], list[Turn]] = read_inst) -> DataFrame:
    """One row per conversation, read back from ``format_conversations``' output (in its own order and partitions)."""
    return formatted.mapInArrow(
        _digest(read),
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, rewrites boolean",
    )
