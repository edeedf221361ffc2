import hashlib

import pytest
from basket_spark.llm import chat
from hypothesis import given
from hypothesis import strategies as st

CONV = "conv_id long, turn long, role string, text string"
nasty = st.lists(st.sampled_from(["\\", "###", "#", "</turn>", "\n", "### Assistant: ", "a", "=", ":", " ", "<", "é"]), max_size=8).map("".join)


@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "User", "=x"]), nasty), nasty), max_size=5))
def test_any_text_comes_back(turns):
    formatted = "".join(chat.head(r) + chat.escape(t) + chat.END for r, t in turns)
    assert [(r, t) for r, t, *_ in chat.read_turns(formatted)] == turns
    assert all(formatted[a:b] == chat.escape(t) for _, t, a, b in chat.read_turns(formatted))


def digests(turns):
    replies = [t for r, t in turns if r == "assistant"]
    return len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), sum(map(len, replies)), hashlib.sha256("".join(replies).encode()).hexdigest()


def test_real_conversations(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    turns = {}
    for r in sorted(table.collect(), key=lambda r: (r.conv_id, r.turn)):
        turns.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    got = {r.conv_id: tuple(r)[1:5] for r in chat.read_back(chat.examples(table)).collect()}
    assert got == {k: digests(t) for k, t in turns.items()}
    assert len({r.conv_id for r in chat.examples(table).collect()}) == len(turns)


def test_one_example_for_each_reply(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "u1"), (1, 2, "assistant", "a###1"), (1, 3, "user", "u2"), (1, 4, "assistant", "a2"), (1, 5, "user", "left")]
    got = sorted(chat.examples(spark.createDataFrame(rows, CONV)).collect(), key=lambda r: r.example)
    assert [[t for _, t, *_ in chat.read_turns(r.formatted)] for r in got] == [["s", "u1", "a###1"], ["s", "u1", "a###1", "u2", "a2"], ["s", "u1", "a###1", "u2", "a2", "left"]]
    assert [None if r.loss_start is None else chat.unescape(r.formatted[r.loss_start : r.loss_end]) for r in got] == ["a###1", "a2", None]


def test_odd_rows(spark):
    rows = [(None, 1, "user", None), (None, None, None, "x"), (2, 0, "assistant", None), (2, 0, "assistant", None), (3, 0, "user", ""), (4, 1, "assistant", "b"), (4, 1, "assistant", "a"), (5, 0, "assistant", "\\### Assistant: </turn> ok" * 2000)]
    df = spark.createDataFrame(rows, CONV).selectExpr("*", "1 AS example", "2 AS turns")
    got = {r.conv_id: tuple(r)[1:5] for r in chat.read_back(chat.examples(df)).collect()}
    assert got[None] == digests([("", "x"), ("user", "")])
    assert got[2] == digests([("assistant", ""), ("assistant", "")])
    assert got[3] == digests([("user", "")])
    assert got[4] == digests([("assistant", "a"), ("assistant", "b")])
    assert chat.read_back(chat.examples(df.limit(0))).count() == 0


def test_other_text_is_refused():
    for bad in ("x", "### User: a", "### User: a</turn>\nrest", "### Nobody: a</turn>\n"):
        with pytest.raises((ValueError, KeyError)):
            chat.read_turns(bad)
