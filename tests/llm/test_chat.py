import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from tierbook.llm import chat

PIECES = [*"ab <>/[]s\n\u0001é", "<s>", "</s>", "[INST]", "[/INST]", " [/INST]</s>"]
TEXT = st.lists(st.sampled_from(PIECES), max_size=8).map("".join)


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "<s>"]), TEXT), max_size=6))
@settings(max_examples=200, deadline=None)
def test_round_trip(turns):
    assert chat.read_inst(chat.inst_template(turns)) == turns


@given(TEXT, st.lists(st.tuples(st.sampled_from(["user", "assistant"]), TEXT), max_size=3))
@settings(max_examples=200, deadline=None)
def test_spans_of_texts(text, before):
    added, start, end, rewrites = chat.render_turn(chat.inst_template, before, ("assistant", text))
    assert chat.unescape(added[start:end]) == text and not rewrites
    assert chat.inst_template(before) + added == chat.inst_template([*before, ("assistant", text)])


def _last_only():
    """A template (made here, so that tasks get it by value) that keeps the thoughts of the last turn only."""

    def template(turns):
        return "".join(f"<{r}>{t if i == len(turns) - 1 else t.split('|')[-1]}" for i, (r, t) in enumerate(turns))

    return template


def test_rewritten_history_is_seen():
    before = [("user", "q"), ("assistant", "thought|answer")]
    assert not chat.render_turn(_last_only(), before[:1], before[1])[3]
    assert chat.render_turn(_last_only(), before, ("user", "more"))[3]
    assert chat.common_prefix("abcd", "abxd") == 2 and chat.common_prefix("", "a") == 0 and chat.common_prefix("ab", "abc") == 2


def _rows():
    rows = [(1, t, "assistant" if t % 2 else "user", f"turn {t} </s>") for t in range(60)]
    rows += [(2, 0, "user", None), (2, 1, None, "no role"), (2, 1, "assistant", ""), (3, None, "assistant", " x "), (3, 0, "assistant", " x ")]
    rows += [(3, 0, "assistant", " x "), (None, 1, "user", "nobody"), (4, 0, "assistant", "long " * 20_000)]
    rows += [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    return rows


def _want(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        turns = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        out[conv] = (len(own), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def _table(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, `index` string").repartition(4)


def test_digests_match_brute_force(spark):
    formatted = chat.format_conversations(_table(spark, _rows()))
    found = chat.digests(formatted).collect()
    assert {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in found} == _want(_rows())
    assert not any(r["rewrites"] for r in found)
    sizes = {r["conv_id"]: r["formatted_chars"] for r in found}
    assert sizes[-7] == len(chat.inst_template([("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]))


def test_rewriting_template_is_flagged(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "thought|answer"), (1, 2, "user", "more"), (2, 0, "user", "q"), (2, 1, "assistant", "plain")]
    found = chat.format_conversations(_table(spark, rows), _last_only()).where("rewrites").collect()
    assert [(r["conv_id"], r["index"]) for r in found] == [(1, 2)]


def _strict():
    """A template that wants user and assistant in turn and numbers the turns."""

    def template(turns):
        for i, (role, _) in enumerate(turns):
            if role != ("assistant" if i % 2 else "user"):
                raise ValueError("roles must alternate")
        return "".join(f"{i} {role}: {text}\n" for i, (role, text) in enumerate(turns))

    return template


def test_long_conversations_are_rendered_after_all_their_turns(spark):
    turns = [("assistant" if t % 2 else "user", f"t|{t}") for t in range(40)]
    rows = [(c, t, *turn) for c in (1, 2) for t, turn in enumerate(turns)]
    found = sorted(map(tuple, chat.format_conversations(_table(spark, rows), _strict()).select("conv_id", "index", "formatted", "rewrites").collect()))
    assert "".join(f for c, _, f, _ in found if c == 2) == _strict()(turns) and not any(r[3] for r in found)
    # a thought more than CONTEXT turns back goes when the last word comes
    forgets = lambda turns: "".join(t[-1:] if turns[-1][1] == "stop" else t for _, t in turns)
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "thought|a")] + [(1, t, "user", "x") for t in range(2, 30)] + [(1, 30, "user", "stop")]
    assert [r["index"] for r in chat.format_conversations(_table(spark, rows), forgets).where("rewrites").collect()] == [30]


def test_no_conversations(spark):
    assert chat.digests(chat.format_conversations(_table(spark, []))).count() == 0
