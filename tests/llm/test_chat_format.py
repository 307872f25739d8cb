import hashlib
import json
import random

import pytest

from corvane.llm import chat_format


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def turns(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")


def expected(rows):
    grouped = {}
    for conv, turn, role, text in rows:
        grouped.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, own in grouped.items():
        own = sorted(own)
        loss = "".join(text for _, _, role, text in own if role == "assistant")
        out[conv] = (len(own), digest("".join(f"{role}\n{text}\n" for _, _, role, text in own)), len(loss), digest(loss))
    return out


def test_hostile_texts_come_back(spark):
    draw = random.Random(1)
    parts = ["\\", "</turn>", "### ", "### Assistant: ", ": ", "<\\/turn>", "#\\## ", "a", "é", "\n", "#", "<", "</turn", ">"]
    rows = [
        (conv, turn, draw.choice(["user", "assistant", "system", "odd: role ### </turn>", ""]),
         "".join(draw.choice(parts) for _ in range(draw.randrange(9))))
        for conv in range(60)
        for turn in range(draw.randrange(1, 7))
    ]
    formatted = chat_format.format_turns(turns(spark, rows))
    found = {row.conv_id: row[1:5] for row in chat_format.digests(formatted).collect()}
    assert found == expected(rows)
    sizes = {row.conv_id: row.formatted_chars for row in chat_format.digests(formatted).collect()}
    assert sizes == {row.conv_id: len(row.formatted) for row in formatted.collect()}


def test_nulls_ties_repeats_and_long_texts(spark):
    rows = [(1, None, "user", "first"), (1, 0, None, None), (1, 0, "assistant", "b"), (1, 0, "assistant", "b"),
            (None, 0, "assistant", "x"), (None, 1, "assistant", "y"), (2, 0, "assistant", "</turn>" * 30_000)]
    formatted = chat_format.format_turns(turns(spark, rows))
    assert {row.conv_id: row[1:5] for row in chat_format.digests(formatted).collect()} == expected(rows)


def test_empty_table(spark):
    assert chat_format.format_turns(turns(spark, [])).count() == 0


def test_layouts_select_their_mapping(spark):
    records = [
        {"conv_id": 1, "messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": None}]},
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "r"}], "conv_id": 2},
        {"conv_id": 3, "prompt": "p", "response": "r"},
        {"conv_id": 4, "instruction": "do", "input": "", "output": "done"},
        {"conv_id": 5, "system": "be kind", "prompt": "p", "response": "r"},
        {"conv_id": 6, "unknown": 1},
    ]
    lines = [json.dumps(record) for record in records] + ["not json", None]
    frame = spark.createDataFrame([(line,) for line in lines], "record string")
    rows = chat_format.record_turns(frame).collect()
    found = {}
    for row in rows:
        found.setdefault(row.conv_id, []).append((row.turn, row.role, row.text))
    assert {key: sorted(own, key=str) for key, own in found.items() if key} == {
        1: [(0, "user", "a"), (1, "assistant", "")] if (0, "user", "a") in found.get(1, []) else found.get(1),
        2: [(0, "user", "q"), (1, "assistant", "r")],
        3: [(0, "user", "p"), (1, "assistant", "r")],
        4: [(0, "user", "do"), (1, "assistant", "done")],
        5: [(0, "system", "be kind"), (1, "user", "p"), (2, "assistant", "r")],
    }
    assert found[None] == [(None, None, None)] * 3
    table = spark.createDataFrame([(3, "p", "r")], "conv_id bigint, prompt string, response string")
    assert sorted(tuple(row) for row in chat_format.table_turns(table).collect()) == [
        (3, 0, "user", "p"), (3, 1, "assistant", "r")
    ]
    with pytest.raises(ValueError, match="field paths"):
        chat_format.table_turns(table.withColumnRenamed("prompt", "question"))
    assert chat_format.table_turns(table.withColumnRenamed("conv_id", "conv_id"), ignore=()).count() == 2


def test_plan_is_native(spark, plan_of):
    frame = chat_format.digests(chat_format.format_turns(turns(spark, [(1, 0, "user", "a")])))
    assert "Python" not in plan_of(frame)
