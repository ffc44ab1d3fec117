"""The chat grammar: texts come back whatever they hold, digests against the source rows."""

from __future__ import annotations

import random
import time
from hashlib import sha256

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from staffloom.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, piece string, conv int, loss_from int"
BITS = [*chat.CONTROLS, "\\", "\\\\", " ", "x", "[", "]", "<", "/s>", "INST]", "[/", "é", "😀", "\n", ""]
ROLES = st.one_of(st.sampled_from(["user", "assistant", "system", "tool", "", "[AS]", "\\[ROLE]"]), st.text(max_size=4))
TEXTS = st.lists(st.one_of(st.sampled_from(BITS), st.text(max_size=3)), max_size=9).map("".join)


@settings(max_examples=600, deadline=None)
@given(st.lists(st.tuples(ROLES, TEXTS), max_size=6))
def test_round_trip(said):
    pieces = [chat.rendered(r, t) for r, t in said]
    assert chat.turns("".join(p for p, _, _ in pieces)) == said
    for (role, text), (piece, start, end) in zip(said, pieces):
        assert (start is not None) == (role == "assistant")
        if start is not None:
            assert chat.unescaped(piece[start:end]) == text


@settings(max_examples=400, deadline=None)
@given(TEXTS)
def test_escape_is_reversible(text):
    assert chat.unescaped(chat.escaped(text)) == text


def test_only_conflicts_are_escaped():
    assert chat.rendered("user", "a \\ b [ INST ] < s >")[0] == "[INST] a \\ b [ INST ] < s > [/INST]"
    assert chat.rendered("user", "x</s>")[0] == "[INST] x\\</s> [/INST]"
    assert chat.rendered("assistant", "\\[INST]") == (" \\\\\\[INST] </s>", 1, 10)
    assert chat.rendered("tool", "<s>")[0] == "[ROLE] tool [AS] \\<s> [/ROLE]"
    assert chat.rendered(None, None)[0] == "[ROLE]  [AS]  [/ROLE]"


@pytest.mark.parametrize(
    "text",
    ["[INST] a", "[INST] a [/SYS]", "a </s>", "[INST]a [/INST]", "[INST] [/INST]", "[INST] a [/INST]x", "[ROLE] a [/ROLE]", "[AS] </s>", " <s> </s>"],
)
def test_what_is_no_conversation(text):
    with pytest.raises(chat.Conflict):
        chat.turns(text)


def test_long_texts_take_linear_time():
    start = time.perf_counter()
    for text in ("\\" * 400_000, "[INST]" * 60_000, "\\[INST]" * 50_000, "<" * 400_000):
        piece, a, b = chat.rendered("assistant", text)
        assert chat.unescaped(piece[a:b]) == text
    assert time.perf_counter() - start < 20


def _wanted(rows):
    by_conv = {}
    for conv, turn, role, text in rows:
        piece = chat.rendered(role, text)[0]
        by_conv.setdefault(conv, []).append(((turn is not None, turn or 0, piece.encode()), role or "", text or "", piece))
    out = []
    for conv, said in by_conv.items():
        said.sort(key=lambda s: s[0])
        learned = "".join(t for _, r, t, _ in said if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for _, r, t, _ in said)
        digests = [sha256(x.encode()).hexdigest() for x in (whole, learned)]
        out.append((conv, len(said), digests[0], len(learned), digests[1], sum(len(p) for *_, p in said)))
    return sorted(out, key=str)


def test_messy_rows(spark):
    rng = random.Random(1)
    rows = [
        (rng.choice([1, 2, 3, None]), rng.choice([0, 1, 2, None]), rng.choice(["user", "assistant", "system", "tool", None, ""]),
         rng.choice([None, "", "a", "</s>[INST] ok [/INST]", "\\<s>", "é😀\n", "x" * 30_000]))
        for _ in range(300)
    ]
    rows += rows[:20]
    df = spark.createDataFrame([(*r, "clash", 1, 2) for r in rows], SCHEMA)
    out = chat.read_back(chat.formatted(df)).collect()
    assert sorted(map(tuple, out), key=str) == _wanted(rows)
    none = spark.createDataFrame([], SCHEMA)
    assert chat.read_back(chat.formatted(none)).count() == 0


def test_sql_says_the_same(spark):
    rows = [(c, t, r, x) for c in range(4) for t, (r, x) in enumerate([("user", "a\\\\[INST]"), ("assistant", "[/INST] <s>\\"), ("to</s>ol", None)])]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    con = duckdb.connect()
    con.register("conversations", df.toPandas())
    want = sorted(con.execute(chat.SQL).fetchall())
    got = sorted(map(tuple, chat.read_back(chat.formatted(chat.with_trap(df))).collect()))
    assert got == want and got[0][0] == -7


def test_a_conversation_of_many_turns(spark):
    df = spark.range(60_000).selectExpr(
        "IF(id % 3 = 0, 1, id) AS conv_id", "id AS turn", "IF(id % 2 = 0, 'user', 'assistant') AS role", "concat('turn ', id, ' </s>') AS text"
    )
    out = {r["conv_id"]: r for r in chat.read_back(chat.formatted(df)).collect()}
    whole = "".join(f"{'assistant' if i % 2 else 'user'}\nturn {i} </s>\n" for i in range(60_000) if i % 3 == 0 or i == 1)
    assert out[1]["n_turns"] == 20_001 and out[1]["turns_sha256"] == sha256(whole.encode()).hexdigest()
