import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from riskweave.llm import chat

NASTY = ["", "\\", "\\\\", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]", "\\<", "<\\s>", "<", "[", "a\nb", "é💡", "$1", "\\n"]


def read_back(spark, rows):
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("pos", F.lit(7)).withColumn("piece", F.lit("x"))
    out = chat.format_turns(chat.canonical_turns(turns))
    got = out.select("conv_id", "n_turns", "formatted", chat.turns_of(F.col("formatted")).alias("t"), chat.text_under_mask(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    return {r.conv_id: r for r in got.collect()}


def test_round_trip_of_control_strings(spark):
    rng = random.Random(3)
    rows = []
    for conv in range(60):
        for turn in range(rng.randrange(1, 6)):
            role = rng.choice(["user", "assistant", "system", "tool", "[/ROLE]", "</s>", None, ""])
            rows.append((conv, turn, role, "".join(rng.choice(NASTY) for _ in range(rng.randrange(0, 7)))))
    got = read_back(spark, rows)
    for conv in range(60):
        own = [r for r in rows if r[0] == conv]
        assert [(t.role, t.text) for t in got[conv].t] == [(r[2] or "", r[3]) for r in own]
        assert got[conv].loss == "".join(r[3] for r in own if r[2] == "assistant")
        assert got[conv].n_turns == len(own)
        assert got[conv].formatted.count("</s>") == len(own)


def test_nulls_ties_repeats_and_long_texts(spark):
    long = "w</s> " * 40_000
    rows = [(None, 0, "user", "a"), (1, None, "user", None), (1, 0, "assistant", long), (1, 0, "assistant", "b"), (1, 0, "assistant", "b"), (2, 0, None, None)]
    got = read_back(spark, rows)
    assert [(t.role, t.text) for t in got[1].t] == [("user", ""), ("assistant", "b"), ("assistant", "b"), ("assistant", long)]
    assert got[1].loss == "bb" + long
    assert got[None].n_turns == 1 and [(t.role, t.text) for t in got[2].t] == [("", "")]


def test_empty_table(spark):
    assert read_back(spark, []) == {}


def test_layouts_give_the_same_turns(spark):
    told = [("user", "hi"), ("assistant", "yo")]
    tables = [
        spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "yo")], "conv_id long, turn long, role string, text string"),
        spark.createDataFrame([(1, [{"role": r, "content": t} for r, t in told])], "conv_id long, messages array<struct<role:string,content:string>>"),
        spark.createDataFrame([(1, [{"from": "human", "value": "hi"}, {"from": "gpt", "value": "yo"}])], "conv_id long, conversations array<struct<`from`:string,value:string>>"),
        spark.createDataFrame([(1, "hi", None, "yo")], "conv_id long, instruction string, input string, output string"),
        spark.createDataFrame([(1, "hi", "yo")], "conv_id long, prompt string, completion string"),
        spark.createDataFrame([(1, None, "hi", "yo")], "conv_id long, system string, prompt string, response string"),
    ]
    for t in tables:
        for df in (t, t.withColumn("extra", F.lit(1))):
            rows = chat.canonical_turns(df).orderBy("turn").collect()
            assert [(r.role, r.text) for r in rows] == told
    with pytest.raises(ValueError):
        chat.canonical_turns(spark.createDataFrame([(1, "x")], "conv_id long, other string"))


def test_fingerprint_of_shapes():
    for layout in chat.LAYOUTS:
        assert layout.fingerprint == hashlib.sha256(layout.shape.encode()).hexdigest()
        assert "conv_id" in layout.fields


def test_json_records_of_mixed_layouts(spark):
    records = [
        {"conv_id": "a", "messages": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "yo"}]},
        {"conv_id": "b", "prompt": "hi", "completion": "yo"},
        {"conv_id": "c", "instruction": "do", "input": "it", "output": "yo"},
        {"conv_id": "d", "other": 1},
    ]
    df = spark.createDataFrame([(json.dumps(r),) for r in records] + [("not json",), (None,)], "raw string")
    rows = chat.canonical_json(df, "raw").collect()
    by = {}
    for r in sorted(rows, key=lambda r: r.turn):
        by.setdefault(r.conv_id, []).append((r.role, r.text))
    assert by["a"] == by["b"] == [("user", "hi"), ("assistant", "yo")]
    assert by["c"] == [("user", "do\nit"), ("assistant", "yo")]
    assert by["d"] == [("", json.dumps(records[3]))]
    assert ("", "not json") in [x for v in by.values() for x in v]
