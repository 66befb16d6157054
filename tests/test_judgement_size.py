"""Descriptions of judgements take memory and parses that don't grow with the rows of a batch."""

import json

import pyarrow as pa
from pyspark.sql import functions as F

from annospark.functions import judgement
from annospark.plans import queries


def test_batches_are_described_by_slices():
    texts = [json.dumps({"per_criterion": [{"criterion": "x" * n}]}) for n in [10] * 700 + [judgement.BYTES] * 3] + [None, ""]
    parts = list(judgement._described(iter([pa.array(texts), pa.array([], pa.string())])))
    assert sum(map(len, parts)) == len(texts) and max(map(len, parts)) <= judgement.AT_A_TIME
    assert sum(len(p) == 1 for p in parts) >= 3 and max(p.nbytes for p in parts) < 3 * judgement.BYTES
    assert [r["compact"] for p in parts for r in p.to_pylist()][:703] == [json.dumps(json.loads(t), separators=(",", ":")) for t in texts[:703]]


def _run(df) -> str:
    """The plan that ran; what was reused stands in it once."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    return execution.executedPlan().toString().split("== Initial Plan ==")[0]


def test_texts_are_described_once(spark, sf):
    # The attempts, and what is chosen of them.
    assert _run(queries.sft_skips(spark, sf)).count("ArrowEvalPython ") == 2
    assert _run(queries.sft_from_structs(spark, sf)).count("ArrowEvalPython ") == 2


def test_no_attempt_is_chosen_where_ids_are_asked(spark, sf):
    plan = _run(queries.stage2_exhausted(spark, sf))
    assert plan.count("ArrowEvalPython ") == 1 and "Window" not in plan


def test_native_opinion_parses_once(spark):
    df = spark.createDataFrame([("{}",)], "raw string").select(judgement.describe_native(F.col("raw")).alias("s"))
    plan = df._jdf.queryExecution().analyzed().toString()
    assert plan.count("try_parse_json(") == 1 and plan.count("regexp_replace(") == 1
