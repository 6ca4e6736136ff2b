"""Chat windows: exact round trips, budgets, history and loss masks."""

from __future__ import annotations

import hashlib
import re
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from prodlake.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"
NASTY = st.text(alphabet=st.sampled_from(list("ab\\\n<|>[]/") + ["é", "😀"]), max_size=30)
PIECE = st.one_of(NASTY, st.sampled_from(chat.CONTROL))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(PIECE, st.lists(PIECE, max_size=4)), max_size=4))
def test_rendered_turns_read_back(turns):
    turns = [(role, "".join(parts)) for role, parts in turns]
    out = "".join(chat.render(r, t)[0] for r, t in turns)
    assert [(r, t) for r, t, _, _ in chat.parse(out)] == turns
    for _, _, start, end in chat.parse(out):
        assert not any(c in out[start:end] for c in chat.CONTROL)


def conversations() -> list[tuple]:
    rows = [(1, 0, "system", "be kind")]
    rows += [(1, i, "assistant" if i % 2 == 0 else "user", f"turn {i} " + "w " * 20) for i in range(1, 12)]
    rows += [(2, 0, "user", "x " * 200), (2, 1, "assistant", "</s>[INST] ok [/INST]"), (2, 1, "assistant", "</s>[INST] ok [/INST]")]
    rows += [(3, 0, "system", "alone"), (4, None, None, None), (4, 2, "assistant", None), (None, 0, "user", "a"), (None, 1, "assistant", "b")]
    rows += [(5, 3, "assistant", "late"), (5, 1, "user", "early"), (5, 2, "system", "in the middle")]
    return rows


def expected(rows):
    out: dict = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    found = {}
    for key, turns in out.items():
        turns.sort(key=lambda r: (r[1] is None, r[1] or 0, r[2] or "", r[3] or ""))
        said = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        found[key] = (len(turns), sha(said), len(loss), sha(loss))
    return found


def test_digests_and_windows(spark):
    rows = conversations()
    turns = spark.createDataFrame(rows, SCHEMA).repartition(3)
    windows = chat.format_conversations(turns, budget=120, history=40, batch_rows=2).cache()
    got = {r["conv_id"]: tuple(r)[1:5] for r in chat.read_back(windows).collect()}
    assert got == expected(rows)
    count = chat.token_counter(None)
    for r in windows.collect():
        shown = list(chat.parse(r["formatted"]))
        assert r["tokens"] == sum(count([chat.render(a, b)[0] for a, b, _, _ in shown]))
        assert r["oversize"] == (r["tokens"] > 120)
        assert not r["oversize"] or r["n_new"] == 1 and r["n_repeated"] == 0
        if r["conv_id"] == 1:
            assert shown[0][:2] == ("system", "be kind") and r["has_system"]
        repeated = shown[r["has_system"] :][: r["n_repeated"]]
        assert sum(count([chat.render(a, b)[0] for a, b, _, _ in repeated])) <= 40
        # the mask covers new targets alone
        spans = {(s["start"], s["end"]) for s in r["loss"]}
        new = shown[r["has_system"] + r["n_repeated"] :]
        assert spans == {(s, e) for role, _, s, e in new if role == "assistant"}
    assert windows.filter("conv_id = 1").count() > 3 and windows.filter("n_repeated > 0").count() > 0


def test_public_vocabulary_extra_columns_and_empty_table(spark):
    turns = spark.createDataFrame(conversations(), SCHEMA).selectExpr("*", "1 as cost", "2 as upto", "3 as number")
    out = chat.read_back(chat.format_conversations(turns, budget=64, tokenizer="/opt/tokenizers/byte_bpe_50k.tiktoken"))
    assert {r["conv_id"]: tuple(r)[1:5] for r in out.collect()} == expected(conversations())
    assert chat.read_back(chat.format_conversations(turns.limit(0))).collect() == []


def test_long_white_space_is_counted(spark):
    vocabulary = Path("/opt/tokenizers/byte_bpe_50k.tiktoken").read_bytes()
    count = chat.token_counter(vocabulary)
    texts = [" " * 40 + "x", "a" + "\n" * 33 + " b ", "é \t\t  z" * 9, "don't " * 5 + " " * 21]
    short = count(texts)
    with pytest.MonkeyPatch.context() as m:
        m.setattr(chat, "_LONG_SPACE", re.compile(""))
        assert count(texts) == short
    assert count([" " * 1_000_000 + "x"])[0] > 1000
    rows = [(1, 0, "user", " " * 1_000_000), (1, 1, "assistant", "a" + "\n" * 1_000_000 + "b"), (1, 2, "user", "x" * 1_000_000)]
    turns = spark.createDataFrame(rows, SCHEMA)
    out = chat.read_back(chat.format_conversations(turns, tokenizer="/opt/tokenizers/byte_bpe_50k.tiktoken"))
    assert {r["conv_id"]: tuple(r)[1:5] for r in out.collect()} == expected(rows)


def test_windows_out_of_turn_raise(spark):
    windows = chat.format_conversations(spark.createDataFrame(conversations(), SCHEMA), budget=120, history=40)
    with pytest.raises(Exception, match="out of turn"):
        chat.read_back(windows.orderBy(F.desc("window"))).collect()
