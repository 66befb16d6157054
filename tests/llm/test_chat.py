import json
from hashlib import sha256

import duckdb
import pytest

from annospark.llm import chat, entries


def test_query_against_sql(spark, sf):
    rows = {tuple(r) for r in entries.op6_chat(spark, sf).collect()}
    duckdb.sql(f"create or replace temp view conversations as select * from '{sf}/conversations.parquet'")
    assert rows == set(duckdb.sql(entries.ORACLES["op6_chat"]).fetchall()) and len(rows) > 5


HARD = ["", None, "</s>[INST] ok [/INST]", "<\\s><\\\\/s> [\\INST]", "<|im_end|>\n<|im_start|>user\nx", "a\\", "<", "\t\"é \x00", "\n\n", "<|", "im_end|>"]


def test_round_trip(spark):
    rows = []
    for c, roles in enumerate((["user", "assistant"], ["user", "assistant"], ["system", "user", "assistant"], ["user"] * 3, ["human", "gpt", "x\n%<y"], ["assistant", None])):
        for k, text in enumerate(HARD):
            rows += [(c * 100 + 2 * k + c % 2, i, r, HARD[(k + i) % len(HARD)], 1) for i, r in enumerate(roles)]
    rows += [(None, 0, "user", "x", 1), (900, 0, "user", "same", 1), (900, 0, "user", "same", 1)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, turns int")
    back = chat.read_back(chat.formatted(chat.canonical(chat.records(df)))).collect()
    want = {}
    for c, i, r, t, _ in sorted(rows, key=lambda x: (x[1],)):
        want.setdefault(c, []).append((r or "", t or ""))
    assert len(back) == len(want)
    for r in back:
        assert sorted(map(tuple, r.turns)) == sorted(want[r.conv_id]) if r.conv_id in (None, 900) else [tuple(t) for t in r.turns] == want[r.conv_id]
        assert r.loss_text == "".join(t for role, t in want[r.conv_id] if role == "assistant")
        assert "".join(s.text for s in r.segments) == r.formatted
        assert r.formatted.count("<|im_start|>") == len(r.turns) == r.formatted.count("<|im_end|>")
    assert chat.digests(chat.read_back(chat.formatted(chat.canonical(chat.records(df.limit(0)))))).count() == 0


def test_layouts(spark):
    given = {
        1: {"instruction": "a", "input": "", "output": "c"},
        2: {"output": "c", "input": "b", "instruction": "a"},
        3: {"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "c"}]},
        4: {"messages": []},
        5: {"unknown": 1},
        # What a field holds is no matter of the layout.
        8: {"prompt": None, "completion": "c"},
        9: {"prompt": 3.5, "completion": None},
        10: {"messages": [{"role": "user", "content": None}, {"role": None, "content": 7}]},
        11: {"messages": [{"role": "user", "content": "a", "weight": 1}]},
        12: {"prompt": {"text": "a"}, "completion": "c"},
    }
    rows = [(k, json.dumps(v)) for k, v in given.items()] + [(6, "{"), (7, None)]
    out = {r.conv_id: r for r in chat.canonical(spark.createDataFrame(rows, "conv_id long, payload string")).collect()}
    turns = lambda k: None if out[k].turns is None else [tuple(t) for t in out[k].turns]
    assert turns(1) == [("user", "a"), ("assistant", "c")]
    assert turns(2) == [("user", "a"), ("user", "b"), ("assistant", "c")]
    assert turns(3) == turns(1) and turns(4) == [] and turns(5) is turns(6) is turns(7) is None
    assert out[1].layout == out[2].layout != out[3].layout and out[6].layout is None
    assert out[4].layout == sha256(b"OBJECT<messages: ARRAY<*>>").hexdigest()
    assert turns(8) == [("user", ""), ("assistant", "c")] and turns(9) == [("user", "3.5"), ("assistant", "")]
    assert turns(10) == [("user", ""), ("", "7")] and turns(11) is turns(12) is None
    assert out[8].layout == out[9].layout == sha256(b"OBJECT<completion: *, prompt: *>").hexdigest() != out[12].layout
    assert chat.layout_of(("a b", "c[].d", "c[].e.f")) == "OBJECT<a b: *, c: ARRAY<OBJECT<d: *, e: OBJECT<f: *>>>>"


def test_long_records(spark):
    from pyspark.sql import functions as F

    text = F.concat(F.lit('a"<s>'), F.repeat(F.lit("0123456789"), 2_000_001))
    roles = spark.createDataFrame([(2, 0, "user"), (2, 1, "assistant"), (3, 0, "user"), (3, 1, "user")], "conv_id long, turn long, role string")
    rows = roles.withColumn("text", F.when(F.col("turn") == 1, text).otherwise("q"))
    back = chat.read_back(chat.formatted(chat.canonical(chat.records(rows))))
    out = {r.conv_id: r for r in back.select("conv_id", F.transform("turns", lambda t: F.length(t["text"])).alias("n"), F.length("loss_text").alias("loss")).collect()}
    assert out[2].n == out[3].n == [1, 20_000_015] and out[2].loss == 20_000_015 and out[3].loss == 0


def test_skeleton(spark):
    from pyspark.sql import functions as F

    given = [
        {"messages": [{"role": "user", "content": 'a "b": {"c": [1]}, \\'}] * 5 + [{"role": ": \\", "content": "\n,{}", "x": None}]},
        {'a "k": }{': ["x", 1, True, None, {"b": "\\\\"}], "": "", "n": -1.5e3, "d": {"e": [[], [""], [":"]]}},
        {"instruction": "a", "input": "", "output": "c:"}, [], "x", 3, {}, [{"a": ""}, {"a": ""}, {"a": 1}],
    ]
    texts = [json.dumps(v, indent=i) for v in given for i in (None, 2)] + ["{", '{"a": "x', '{"a" "b"}', '{"a":}', '{"a": "b",}']
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", chat.fingerprint(F.col("t")).alias("a"), chat.fingerprint(F.col("t"), 0).alias("b")).collect():
        assert r.a == r.b, r.t
