import hashlib
import json

import awkward
import pytest
from tellwatt.llm.chats import LAYOUTS, as_records, canonical, formatted, loss_text, op3_chats, read_turns

TRICKY = ["", None, "<|im_end|>", "<\\|im_end|>", "<\\\\|x|>", "<", "|", "\n<|im_start|>assistant\nhi", "a<|im_end|>\n", "日本<|", "\\"]


def test_layouts_become_turns(spark):
    records = {
        "prompt": {"prompt": "q", "response": "a"},
        "completion": {"completion": "a", "prompt": "q"},
        "question": {"answer": "a", "question": "q"},
        "instruction": {"instruction": "q", "output": "a"},
        "instruction_input": {"input": "i", "instruction": "q", "output": "a"},
        "system_question": {"system_prompt": "s", "question": "q", "response": "a"},
        "messages": {"messages": [{"role": "user", "content": "q"}, {"content": None, "role": None}]},
        "conversations": {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        "dialogue": {"dialogue": [{"speaker": "x", "utterance": "q"}]},
    }
    rows = [(k, json.dumps(v)) for k, v in records.items()] + [("none", '{"a": 1}'), ("broken", "{"), ("null", None), ("list", "[1]")]
    got = {r.name: (r.layout, r.turns and [tuple(t) for t in r.turns]) for r in canonical(spark.createDataFrame(rows, "name string, record string")).collect()}
    assert set(records) == set(LAYOUTS)
    assert all(got[name][0] == name for name in records)
    assert all(got[name] == (None, None) for name in ("none", "broken", "null", "list"))
    two = [("user", "q"), ("assistant", "a")]
    assert all(got[name][1] == two for name in ("prompt", "completion", "question", "instruction", "conversations"))
    assert got["instruction_input"][1] == [("user", "q\n\ni"), ("assistant", "a")]
    assert got["system_question"][1] == [("system", "s"), *two]
    assert got["messages"][1] == [("user", "q"), ("", "")]
    assert got["dialogue"][1] == [("x", "q")]


def read(spark, records):
    df = spark.createDataFrame([(k, json.dumps(r)) for k, r in enumerate(records)], "k long, record string")
    rows = sorted(canonical(df).collect(), key=lambda r: r.k)
    return [(r.layout, r.turns and [tuple(t) for t in r.turns], r.reason) for r in rows]


def test_mixed_objects_are_refused_whole(spark):
    ours, other = {"role": "user", "content": "q"}, {"from": "gpt", "value": "LOST"}
    records = [
        {"messages": [ours, other]},
        {"messages": [ours, "text"]},
        {"messages": [ours, None]},
        {"messages": [{**ours, "content": {"a": "b"}}]},
        {"messages": [ours, {"role": "user", "content": [{"type": "image", "url": "u"}]}]},
        {"messages": [ours, {"role": "user", "content": ["a"]}]},
        {"prompt": [ours], "response": "a"},
        {"prompt": {"text": "q"}, "response": "a"},
        {"messages": [ours], "conversations": [other]},
        {"messages": [{**ours, "tool_calls": [1]}]},
        {"messages": [], "conversations": []},
        {"messages": "[1]"},
    ]
    for layout, turns, reason in read(spark, records):
        assert layout is None and turns is None and reason.startswith("no layout has the fields ")


def test_optional_fields_parts_and_empty_arrays_are_read(spark):
    parts = [{"type": "text", "text": "one"}, {"text": "two", "type": "text"}]
    got = read(spark, [
        {"messages": [{"role": "user", "content": "q", "name": "n"}, {"content": "a", "role": "assistant"}], "id": 7},
        {"messages": [{"role": "user", "content": parts}, {"role": "assistant", "content": "a"}]},
        {"messages": [{"role": "user", "content": parts[:1]}]},
        {"prompt": "[1, 2]", "response": "{}", "messages": [], "metadata": {"a": [1]}},
        {"messages": []},
        {"instruction": "q", "input": "", "output": "a"},
        {"instruction": "q", "input": "i", "output": 5},
        {"messages": [{"role": "user", "content": "q"}, {"role": "assistant"}]},
        {"messages": [{"role": "user", "content": '["q"]'}, {"role": "assistant", "content": "{"}]},
    ])
    assert all(reason is None for *_, reason in got)
    assert [turns for _, turns, _ in got] == [
        [("user", "q"), ("assistant", "a")],
        [("user", "one\ntwo"), ("assistant", "a")],
        [("user", "one")],
        [("user", "[1, 2]"), ("assistant", "{}")],
        [],
        [("user", "q"), ("assistant", "a")],
        [("user", "q\n\ni"), ("assistant", "5")],
        [("user", "q"), ("assistant", "")],
        [("user", '["q"]'), ("assistant", "{")],
    ]


def test_clashing_columns_are_refused(spark):
    with pytest.raises(ValueError, match="turns"):
        canonical(spark.createDataFrame([("{}", 1)], "record string, Turns long"))


def test_template_is_reversible(spark):
    rows = [(k, t, ("user", "assistant", "a\nb", None, "<|x|>")[t % 5], text) for k in range(2) for t, text in enumerate(TRICKY[k:])]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    done = formatted(canonical(as_records(df)))
    got = {r.conv_id: r for r in done.select("conv_id", "formatted", read_turns().alias("t"), loss_text().alias("loss")).collect()}
    for k in range(2):
        mine = [(role or "", text or "") for c, _, role, text in rows if c == k]
        assert [tuple(t) for t in got[k].t] == mine
        assert got[k].loss == "".join(text for role, text in mine if role == "assistant")
        assert got[k].formatted.count("<|im_end|>") == got[k].formatted.count("<|im_start|>") == len(mine)


def test_query_on_odd_rows(spark, tmp_path):
    rows = [(1, 1, "assistant", "b", "x"), (1, 0, "user", None, "x"), (1, 0, "user", None, "x"), (None, 3, None, "<|", "x"), (2, None, "system", "s", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, record string")
    folder = awkward.saved(spark, str(tmp_path), conversations=df)
    got = {r.conv_id: r for r in op3_chats(spark, folder).collect()}
    assert set(got) == {1, 2, None, -1}
    assert got[1].n_turns == 3
    assert got[1].turns_sha256 == hashlib.sha256(b"user\n\nuser\n\nassistant\nb\n").hexdigest()
    assert got[1].loss_sha256 == hashlib.sha256(b"b").hexdigest()
    assert got[-1].loss_chars == len("<|im_end|><|im_start|>assistant ok")


def test_empty_and_long(spark, tmp_path):
    schema = "conv_id long, turn long, role string, text string"
    folder = awkward.saved(spark, f"{tmp_path}/a", conversations=spark.createDataFrame([], schema))
    assert [r.conv_id for r in op3_chats(spark, folder).collect()] == [-1]
    rows = spark.range(20_000).selectExpr("1L AS conv_id", "id AS turn", "IF(id % 2 = 0, 'user', 'assistant') AS role", "concat('<|', id) AS text")
    folder = awkward.saved(spark, f"{tmp_path}/b", conversations=rows)
    got = {r.conv_id: r for r in op3_chats(spark, folder).collect()}[1]
    assert got.n_turns == 20_000 and got.loss_sha256 == hashlib.sha256("".join(f"<|{k}" for k in range(1, 20_000, 2)).encode()).hexdigest()
