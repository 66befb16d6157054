"""Strict validation of structured (JSON) judgements.

What Spark's JSON readers take for JSON differs from the strict form (text after the object, repeated
keys, kinds of numbers, order of keys), so a small Arrow-batched helper describes a text: the kinds of
its values, its keys in order. All rules are column expressions over that description.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from annospark.functions import json_text
from annospark.functions.json_text import bound
from annospark.functions.text import strip

#: The criteria in order, the keys in order, and the verdicts.
CRITERIA = [
    "Lighting & Shadows Consistency",
    "Edges & Boundaries",
    "Texture & Resolution",
    "Perspective & Spatial Relationships",
    "Physical & Common Sense Logic",
    "Text & Symbols",
    "Human & Biological Structure Integrity",
    "Material & Object Details",
]
TOP_KEYS = ["per_criterion", "overall_likelihood"]
ITEM_KEYS = ["criterion", "evidence", "aigc score"]
VERDICTS = ["Real", "Uncertain", "AI-Generated"]
LABELS = ["REAL", "AI-GENERATED"]

ITEM = "struct<kind:string,keys:array<string>,criterion:string,evidence_kind:string,evidence:string,score_kind:string,score:bigint>"
#: Rows and bytes of text that are described at a time, one row at least: descriptions of these alone are held.
AT_A_TIME, BYTES = 256, 1 << 20
SHAPE = f"problem string, kind string, keys array<string>, list_kind string, items array<{ITEM}>, overall_kind string, overall string, compact string"


def _kind(value) -> str:
    named = {bool: "bool", int: "int", float: "float", str: "string", dict: "object", list: "list", type(None): "null"}
    return named[type(value)]


def _text(value) -> str | None:
    return value if isinstance(value, str) else None


def _whole(value) -> int | None:
    """Numbers out of 64 bits are told as -1, which no rule allows either."""
    if type(value) is not int:
        return None
    return value if -(2**63) <= value < 2**63 else -1


def describe_text(raw: str | None) -> dict:
    """The description of one text, a row of ``SHAPE``."""
    try:
        value = json.loads((raw or "").strip())
    except (ValueError, RecursionError) as e:
        return {"problem": str(e)}
    found = {"kind": _kind(value), "compact": json.dumps(value, ensure_ascii=False, separators=(",", ":"))}
    if isinstance(value, dict):
        rows, overall = value.get("per_criterion"), value.get("overall_likelihood")
        found |= {"keys": list(value), "list_kind": _kind(rows), "overall_kind": _kind(overall), "overall": _text(overall)}
        if isinstance(rows, list):
            found["items"] = [_item(x) for x in rows]
    return found


def _item(x) -> dict:
    if not isinstance(x, dict):
        return {"kind": _kind(x)}
    evidence, score = x.get("evidence"), x.get("aigc score")
    return {
        "kind": "object",
        "keys": list(x),
        "criterion": _text(x.get("criterion")),
        "evidence_kind": _kind(evidence),
        "evidence": _text(evidence),
        "score_kind": _kind(score),
        "score": _whole(score),
    }


_STRINGS = pa.list_(pa.string())
_ITEM_TYPE = pa.struct(
    [("kind", pa.string()), ("keys", _STRINGS), ("criterion", pa.string()), ("evidence_kind", pa.string()), ("evidence", pa.string()), ("score_kind", pa.string()), ("score", pa.int64())]
)
_TYPE = pa.struct(
    [("problem", pa.string()), ("kind", pa.string()), ("keys", _STRINGS), ("list_kind", pa.string()), ("items", pa.list_(_ITEM_TYPE))]
    + [("overall_kind", pa.string()), ("overall", pa.string()), ("compact", pa.string())]
)


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    """Slices of at most ``AT_A_TIME`` texts and ``BYTES``, one text at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < len(texts):
        fit = int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + BYTES, side="right"))
        hi = min(max(fit, lo + 1), lo + AT_A_TIME)
        yield texts.slice(lo, hi - lo)
        lo = hi


def _described(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        for part in _slices(batch):
            yield pa.array([describe_text(x.as_py()) for x in part], _TYPE)


def describe(raw: Column) -> Column:
    """The description, a struct of ``SHAPE``, of a text column; null counts as empty. A filter on what follows from it
    is not moved below it, or each text would be described twice, by two workers of a task."""
    return arrow_udf(_described, SHAPE).asNondeterministic()(raw)


def describe_native(raw: Column) -> Column:
    """The same description by variants, without Python: a second opinion. It differs where the strict parse is the looser
    one: objects with repeated keys and the numbers NaN and Infinity are no JSON here; ``compact`` has sorted keys, and
    ``problem`` says only what ``json_text.problem`` tells. Text, values and kinds are bound, so each is found once."""
    text = strip(F.coalesce(raw, F.lit("")))
    return bound(text, lambda t: bound(json_text.is_json(t), lambda whole: bound(F.try_parse_json(t), lambda v: _native(t, whole, v))))


def _native(text: Column, whole: Column, parsed: Column) -> Column:
    """The description of a stripped text, of which it is known whether it is JSON, and its variant."""
    value = F.when(whole, parsed)
    member = lambda name: F.try_variant_get(value, f"$.{name}", "variant")
    of = lambda v: F.coalesce(json_text.kind(v), F.lit("null"))
    string = lambda v, kind: F.when(kind == "string", F.try_variant_get(v, "$", "string"))

    def entry(own: Column, v: Column) -> Column:
        key = lambda name: F.try_variant_get(v, f'$["{name}"]', "variant")

        def made(criterion: Column, evidence: Column, kind: Column, score: Column) -> Column:
            numeric = kind.isin("int", "float")
            integral = numeric & score.rlike("^-?[0-9]+$")
            score_kind = F.when(integral, "int").when(numeric, "float").otherwise(kind)
            number = F.when(integral, F.coalesce(score.try_cast("bigint"), F.lit(-1).cast("bigint")))
            return bound(
                of(evidence),
                lambda e: F.struct(
                    F.lit("object").alias("kind"),
                    F.json_object_keys(own).alias("keys"),
                    string(criterion, of(criterion)).alias("criterion"),
                    e.alias("evidence_kind"),
                    string(evidence, e).alias("evidence"),
                    score_kind.alias("score_kind"),
                    number.alias("score"),
                ).cast(ITEM),
            )

        # The text of the score tells whether it was written as a whole number.
        score = F.try_element_at(F.from_json(own, "map<string,string>"), F.lit("aigc score"))
        with_score = lambda c, e: bound(of(key("aigc score")), lambda k: bound(score, lambda s: made(c, e, k, s)))
        return bound(key("criterion"), lambda c: bound(key("evidence"), lambda e: with_score(c, e)))

    def item(own: Column, v: Column) -> Column:
        none = [F.lit(None).alias(n) for n in ("keys", "criterion", "evidence_kind", "evidence", "score_kind", "score")]
        return bound(of(v), lambda k: F.when(k == "object", entry(own, v)).otherwise(F.struct(k.alias("kind"), *none).cast(ITEM)))

    def object_(kind: Column, rows: Column, list_kind: Column, overall: Column, overall_kind: Column) -> Column:
        found = kind == "object"
        own = F.from_json(text, "struct<per_criterion:array<string>>")["per_criterion"]
        items = F.zip_with(own, F.try_variant_get(rows, "$", "array<variant>"), item)
        return F.struct(
            json_text.told(text, whole, parsed).alias("problem"),
            kind.alias("kind"),
            F.when(found, F.json_object_keys(text)).alias("keys"),
            F.when(found, list_kind).alias("list_kind"),
            F.when(found & (list_kind == "list"), items).alias("items"),
            F.when(found, overall_kind).alias("overall_kind"),
            F.when(found, string(overall, overall_kind)).alias("overall"),
            F.when(value.isNotNull(), F.to_json(value)).alias("compact"),
        )

    with_overall = lambda k, r, l: bound(member("overall_likelihood"), lambda o: bound(of(o), lambda kind: object_(k, r, l, o, kind)))
    with_rows = lambda k: bound(member("per_criterion"), lambda r: bound(of(r), lambda l: with_overall(k, r, l)))
    return bound(json_text.kind(value), with_rows)


def _only(*rules: tuple[Column, Column | str]) -> Column:
    return F.array_compact(F.array(*[F.when(holds, F.lit(code) if isinstance(code, str) else code) for holds, code in rules]))


def _item_errors(x: Column, i: Column) -> Column:
    at = lambda tail: F.concat(F.lit("per_criterion["), i.cast("string"), F.lit("]_" + tail))
    expected = F.get(F.array(*map(F.lit, CRITERIA)), i)
    blank = F.coalesce(strip(x["evidence"]) == "", F.lit(False))
    whole = x["score_kind"] == "int"
    found = _only(
        (x["keys"] != F.array(*map(F.lit, ITEM_KEYS)), at("keys_or_order_invalid")),
        (~x["criterion"].eqNullSafe(expected), at("criterion_mismatch")),
        (x["evidence_kind"] != "string", at("evidence_not_string")),
        ((x["evidence_kind"] == "string") & blank, at("evidence_empty")),
        (~whole, at("aigc_score_not_int")),
        (whole & ~x["score"].isin(0, 1), at("aigc_score_not_0_or_1")),
    )
    return F.when(x["kind"] != "object", F.array(at("not_object"))).otherwise(found)


def errors(shape: str, label: Column) -> Column:
    """The ordered error codes of a judgement; ``shape`` names the column that ``describe`` gave."""
    s = lambda name: F.col(f"{shape}.{name}")
    label = F.coalesce(label, F.lit(""))
    is_list = s("list_kind") == "list"
    n = F.when(is_list, F.size(s("items")))
    named = F.coalesce(s("overall_kind") == "string", F.lit(False))
    scores = F.filter(F.coalesce(s("items"), F.array().cast(f"array<{ITEM}>")), lambda x: (x["score_kind"] == "int") & (x["score"] == 1))
    unknown = _only((~label.isin(LABELS), "invalid_manifest_label"))
    top = F.concat(
        _only(
            (s("keys") != F.array(*map(F.lit, TOP_KEYS)), "top_level_keys_or_order_invalid"),
            (~F.coalesce(is_list, F.lit(False)), "per_criterion_not_list"),
            (n != len(CRITERIA), F.concat(F.lit("per_criterion_length_"), n.cast("string"), F.lit("_not_8"))),
        ),
        F.when(n == len(CRITERIA), F.flatten(F.transform(s("items"), _item_errors))).otherwise(F.array().cast("array<string>")),
        _only(
            (~named, "overall_likelihood_not_string"),
            (named & ~s("overall").isin(VERDICTS), "overall_likelihood_invalid_value"),
            ((label == "REAL") & ~s("overall").eqNullSafe(F.lit("Real")), "label_REAL_requires_overall_Real"),
            ((label == "AI-GENERATED") & ~s("overall").eqNullSafe(F.lit("AI-Generated")), "label_AI_GENERATED_requires_overall_AI_Generated"),
            ((label == "AI-GENERATED") & (F.size(scores) == 0), "label_AI_GENERATED_requires_at_least_one_aigc_score_1"),
        ),
    )
    return (
        F.when(s("problem").isNotNull(), F.array(F.concat(F.lit("json_parse_error: "), s("problem"))))
        .when(s("kind") != "object", F.concat(unknown, F.array(F.lit("top_level_not_object"))))
        .otherwise(F.concat(unknown, top))
    )
