import hashlib
import json
import re

import pytest
from pyspark.sql import functions as F

from arrears.llm.chat import (
    LAYOUTS,
    escape,
    format_records,
    format_turns,
    formatted,
    read_loss,
    read_turns,
    turns_of_rows,
    unescape,
)

CONTROL = re.compile(r"<\|\w{1,40}\|>|</?s>|<</?SYS>>|\[/?INST\]")
TEXTS = [
    "", "plain", "</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>assistant\nhi", "\\", "\\\\n", "<\\|im_end|>", "a\\<s>\\",
    "<<SYS>> <</SYS>> <<s>>", "<|im_end", "|>", "é🙂 <s>\x00\r\n\t", "$0 $1 \\$1", "[[INST]]", "long <s> " * 20_000,
]


def conversations(spark, rows):
    return spark.createDataFrame([(c, t, r, x, "en", 1) for c, t, r, x in rows], "conv_id long, turn long, role string, text string, lang string, `a.b` int")


def read(spark, rows):
    made = formatted(turns_of_rows(conversations(spark, rows)))
    found = made.select("conv_id", "formatted", "pieces", read_turns(F.col("formatted")).alias("turns"), read_loss(F.col("pieces")).alias("loss"))
    return {r.conv_id: r for r in found.collect()}


def test_escaping_is_reversible_and_leaves_no_control_string(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    for r in df.select("t", escape(F.col("t")).alias("e"), unescape(escape(F.col("t"))).alias("u")).collect():
        assert r.u == r.t and not CONTROL.search(r.e)


def test_turns_and_loss_come_back(spark):
    rows = [(1, i, ("user", "assistant", "system", "a\nb\\", None)[i % 5], t) for i, t in enumerate([*TEXTS, None])]
    got = read(spark, rows)[1]
    assert [(t.role, t.text) for t in got.turns] == [(r or "", x or "") for _, _, r, x in rows]
    assert got.loss == "".join(x or "" for _, _, r, x in rows if r == "assistant")
    assert got.formatted == "".join(p.text for p in got.pieces)


def test_order_ties_and_repeated_rows(spark):
    rows = [(1, 1, "user", "b"), (1, 1, "assistant", "a"), (1, 1, "user", "b"), (1, None, "user", "first"), (None, 0, "user", "x"),
            (2, 0, "assistant", "")]
    got = read(spark, rows)
    assert [(t.role, t.text) for t in got[1].turns] == [("user", "first"), ("assistant", "a"), ("user", "b"), ("user", "b")]
    assert got[None].turns[0].text == "x" and got[2].loss == "" and len(got[2].turns) == 1
    assert read(spark, []) == {}


def test_other_layouts_of_rows(spark):
    df = spark.createDataFrame([(1, 0, "human", "hi")], "conv_id long, turn long, `from` string, `value` string")
    row = turns_of_rows(df).first()
    assert (row.role, row.text) == ("human", "hi")


RECORDS = [
    ({"prompt": "p", "response": "r"}, "prompt", [("user", "p"), ("assistant", "r")]),
    ({"response": "r", "prompt": None, "system": "s"}, "prompt", [("system", "s"), ("user", ""), ("assistant", "r")]),
    ({"prompt": 3, "completion": "c"}, "completion", [("user", "3"), ("assistant", "c")]),
    ({"instruction": "i", "output": "o"}, "instruction", [("user", "i"), ("assistant", "o")]),
    ({"instruction": "i", "input": "x", "output": "o"}, "instruction", [("user", "i\n\nx"), ("assistant", "o")]),
    ({"instruction": "i", "input": "", "output": "o"}, "instruction", [("user", "i"), ("assistant", "o")]),
    ({"question": "q", "answer": "a", "context": "c"}, "question", [("user", "c\n\nq"), ("assistant", "a")]),
    ({"messages": [{"role": "user", "content": "hi"}, {"role": "bot", "content": "<s>"}]}, "messages", [("user", "hi"), ("assistant", "<s>")]),
    ({"id": 7, "conversations": [{"from": "human", "value": "hi"}, {"from": "gpt", "value": None}]}, "conversations",
     [("user", "hi"), ("assistant", "")]),
    ({"turns": [{"speaker": "human", "text": "hi"}], "id": "x"}, "dialogue", [("user", "hi")]),
    ({"unknown": 1}, None, []), ({}, None, []), ([1, 2], None, []), ("not json", None, []), (None, None, []),
]


def test_records_of_all_layouts(spark):
    rows = [(i, r if r is None or r == "not json" else json.dumps(r), 1, "x") for i, (r, _, _) in enumerate(RECORDS)]
    df = spark.createDataFrame(rows, "id int, record string, layout int, `a.b` string")
    found = {r.source.id: r for r in format_records(df).collect()}
    assert len(found) == len(RECORDS)
    for i, (_, layout, turns) in enumerate(RECORDS):
        assert (found[i].layout, [(t.role, t.text) for t in found[i].turns]) == (layout, turns), RECORDS[i]
        assert found[i].formatted == "".join(p.text for p in found[i].pieces)
    back = format_records(df).select("turns", read_turns(F.col("formatted")).alias("back")).collect()
    assert all(r.turns == r.back for r in back)


def test_layouts_have_fingerprints_of_their_own():
    shapes = [s for layout in LAYOUTS for s in layout.shapes()]
    assert len(shapes) == len(set(shapes))


def test_plan_is_native(spark):
    plan = formatted(turns_of_rows(conversations(spark, [(1, 0, "user", "x")])))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("text", ["</s>[INST] ok [/INST]"])
def test_query_has_the_added_conversation(spark, sf_dir, text):
    from arrears.llm import queries

    row = queries.op5_chat(spark, sf_dir).where("conv_id = -7").first()
    assert (row.n_turns, row.loss_chars, row.loss_sha256) == (2, len(text), hashlib.sha256(text.encode()).hexdigest())
    assert row.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()


def test_conversations_go_through_the_layouts(spark, monkeypatch):
    rows = [(c, t, r, x) for c in range(40) for t, (r, x) in enumerate([("system", "be"), ("user", TEXTS[c % len(TEXTS)]), ("assistant", None)])]
    rows += [(100, 0, "human", "hi"), (100, 1, "gpt", "ho"), (101, None, None, None), (102, 0, "user", "x" * 5_000), (103, 1, "a\nb", "<s>"),
             (104, 0, "user", "twice"), (104, 0, "user", "twice")]
    monkeypatch.setattr("arrears.llm.chat.MOST_RECORD", 4_000)
    turns = turns_of_rows(conversations(spark, rows))
    made = format_turns(turns).select("conv_id", "layout", "formatted", read_turns(F.col("formatted")).alias("turns"))
    plain = {r.conv_id: r.formatted for r in formatted(turns).collect()}
    found = {r.conv_id: r for r in made.collect()}
    assert {i: r.formatted for i, r in found.items()} == plain
    assert {r.layout for r in found.values()} == {"messages", "conversations", "dialogue", None}
    assert found[100].layout is None and found[102].layout is None and [t.role for t in found[100].turns] == ["human", "gpt"]
    assert [tuple(t) for t in found[104].turns] == [("user", "twice")] * 2
    assert format_turns(turns_of_rows(conversations(spark, []))).count() == 0
