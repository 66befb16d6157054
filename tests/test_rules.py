"""Rules at their borders: each error code at least once."""

import json

import pytest
from pyspark.sql import functions as F

from annospark.functions import judgement, labels, text


def column(spark, values, f, kind="string"):
    df = spark.createDataFrame(list(enumerate(values)), f"i int, c {kind}")
    return [r[0] for r in df.orderBy("i").select(f(F.col("c"))).collect()]


GOOD = "The light falls from the left and all shadows agree."
TEXTS = [
    (None, ["output_not_string"]),
    ("   ", ["empty_output", "too_short_lt_30_chars", "suspected_truncation_or_incomplete_sentence"]),
    ("x" * 28 + ".", ["too_short_lt_30_chars"]),
    ("x" * 29 + ".", []),
    (GOOD, []),
    ("　" + GOOD + " ", []),
    ("This image is real.", ["too_short_lt_30_chars", "label_only_or_short_answer"]),
    ("the image is real generated ai", ["label_only_or_short_answer"]),
    ("the image is real generated ai image", []),
    ("{ " + GOOD, ["json_like_output_not_allowed"]),
    ("[ " + GOOD, ["json_like_output_not_allowed"]),
    ("``` " + GOOD, ["markdown_code_fence_not_allowed"]),
    (GOOD + ".", []),
    (GOOD + "..", ["suspected_truncation_or_incomplete_sentence"]),
    (GOOD + " Then,", ["suspected_truncation_or_incomplete_sentence"]),
    (GOOD + " It is due to 42", ["suspected_truncation_or_incomplete_sentence"]),
    (GOOD + " including.", ["suspected_truncation_or_incomplete_sentence"]),
    (GOOD + "..", ["suspected_truncation_or_incomplete_sentence"]),
    (GOOD + "\r\n- half a point", ["suspected_truncation_or_incomplete_sentence"]),
    (GOOD + "\n- a whole point.\n\n", []),
    (GOOD + "\n2) half a point", ["suspected_truncation_or_incomplete_sentence"]),
]


def test_free_text(spark):
    none = F.lit(None).cast("string")
    got = column(spark, [t for t, _ in TEXTS], lambda c: text.free_text_errors(c, none, F.lit(None).cast("int")))
    for (t, want), errors in zip(TEXTS, got, strict=True):
        assert errors == want, t


def test_limits(spark):
    df = spark.createDataFrame([(None, 474), (None, 475), (None, None), ("length", 1), ("stop", 1)], "f string, n int")
    cut = df.select(text.truncated(F.lit("All of this hangs together well"), F.col("f"), F.col("n"))).collect()
    assert [r[0] for r in cut] == [False, True, False, True, False]
    assert column(spark, ["json_parse_error: x (char 3)", "per_criterion[3]_not_object"], text.reason) == ["json_parse_error", "per_criterion[]_not_object"]


def test_labels(spark):
    given = ["  Not--Real!", "unreal", "AI generated", "full-synthetic", "Edited / real", "", None, "genuine_photo", "Édited"]
    assert column(spark, given, labels.normalize) == ["not_real", "unreal", "ai_generated", "full_synthetic", "edited_real", "", None, "genuine_photo", "dited"]
    assert column(spark, given, labels.category) == ["real", None, "synthetic", "synthetic", "real", None, None, "real", None]
    assert column(spark, given, labels.representative) == ["real", None, "ai_generated", "full_synthetic", "real", None, None, "genuine", None]
    assert column(spark, ["0", " Full Synthetic", "tampered", "true", "3"], labels.number) == [0, 1, 2, None, None]
    assert column(spark, [1, 1234567], lambda c: labels.sample_id(F.lit("REAL"), c, ("own_", "")), "int") == ["own_000001", "own_1234567"]
    assert column(spark, [7], lambda c: labels.sample_id(F.lit("AI-GENERATED"), c), "int") == ["fake_000007"]
    assert column(spark, [-1, 2, 7, None], lambda c: labels.number(c, whole=True), "int") == [-1, 2, 7, None]
    assert column(spark, ["a.PNG?x=1", "a.png.txt", "b.jpeg"], labels.image_like) == [True, False, True]
    url = column(spark, [b"\x00" * 100], lambda c: labels.data_url(F.lit("x.JPG"), c), "binary")[0]
    assert url.startswith("data:image/jpeg;base64,AAAA") and "\r" not in url and "\n" not in url


def judged(score=0, overall="Real", **change):
    rows = [{"criterion": c, "evidence": "seen", "aigc score": score} for c in judgement.CRITERIA]
    for k, v in change.get("item", {}).items():
        rows[3][k] = v
    return {"per_criterion": change.get("rows", rows), "overall_likelihood": overall}


SWAPPED = {"overall_likelihood": "Real", "per_criterion": judged()["per_criterion"]}
CASES = [
    (json.dumps(judged()), "REAL", []),
    (" " + json.dumps(judged()) + "\n", "REAL", []),
    (json.dumps(judged(score=1)), "REAL", []),
    (json.dumps(judged(score=1, overall="AI-Generated")), "AI-GENERATED", []),
    (json.dumps(judged(overall="AI-Generated")), "AI-GENERATED", ["label_AI_GENERATED_requires_at_least_one_aigc_score_1"]),
    (json.dumps(judged(overall="Uncertain")), "REAL", ["label_REAL_requires_overall_Real"]),
    (json.dumps(judged(overall="Other")), "REAL", ["overall_likelihood_invalid_value", "label_REAL_requires_overall_Real"]),
    (json.dumps(judged(overall=1)), "REAL", ["overall_likelihood_not_string", "label_REAL_requires_overall_Real"]),
    (json.dumps(judged()), "OTHER", ["invalid_manifest_label"]),
    (json.dumps(judged()) + " x", "REAL", ["json_parse_error"]),
    (json.dumps(judged()).replace('"', "'"), "REAL", ["json_parse_error"]),
    (None, "REAL", ["json_parse_error"]),
    ("[]", "REAL", ["top_level_not_object"]),
    ("NaN", "REAL", ["top_level_not_object"]),
    (json.dumps(SWAPPED), "REAL", ["top_level_keys_or_order_invalid"]),
    (json.dumps(judged(rows=[{}] * 7)), "REAL", ["per_criterion_length_7_not_8"]),
    (json.dumps(judged(rows="x")), "REAL", ["per_criterion_not_list"]),
    (json.dumps(judged(rows=[1] * 8)), "REAL", [f"per_criterion[{i}]_not_object" for i in range(8)]),
    (json.dumps(judged(item={"aigc score": True})), "REAL", ["per_criterion[3]_aigc_score_not_int"]),
    (json.dumps(judged(item={"aigc score": 1.0})), "REAL", ["per_criterion[3]_aigc_score_not_int"]),
    (json.dumps(judged(item={"aigc score": "1"})), "REAL", ["per_criterion[3]_aigc_score_not_int"]),
    (json.dumps(judged(item={"aigc score": 2})), "REAL", ["per_criterion[3]_aigc_score_not_0_or_1"]),
    (json.dumps(judged(item={"aigc score": 10**30})), "REAL", ["per_criterion[3]_aigc_score_not_0_or_1"]),
    (json.dumps(judged(item={"evidence": " "})), "REAL", ["per_criterion[3]_evidence_empty"]),
    (json.dumps(judged(item={"evidence": None})), "REAL", ["per_criterion[3]_evidence_not_string"]),
    (json.dumps(judged(item={"criterion": "x"})), "REAL", ["per_criterion[3]_criterion_mismatch"]),
    (json.dumps(judged(item={"more": 1})), "REAL", ["per_criterion[3]_keys_or_order_invalid"]),
    (json.dumps(judged()).replace('"evidence": "seen"', '"evidence": 1, "evidence": "seen"', 1), "REAL", []),
]


def test_judgements(spark):
    df = spark.createDataFrame([(i, r, la) for i, (r, la, _) in enumerate(CASES)], "i int, raw string, label string")
    rows = df.withColumn("s", judgement.describe(F.col("raw"))).withColumn("e", judgement.errors("s", F.col("label"))).orderBy("i").collect()
    for r, (raw, _, want) in zip(rows, CASES, strict=True):
        assert [e.partition(":")[0] for e in r.e] == want, raw
    assert rows[0].s.compact == json.dumps(judged(), separators=(",", ":"))


@pytest.mark.parametrize("kind", ["list", "null"])
def test_kinds(kind):
    assert judgement.describe_text({"list": "[1]", "null": "null"}[kind])["kind"] == kind
