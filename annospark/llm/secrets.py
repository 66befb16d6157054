"""Secret scans: fixed patterns, and strings that look random to character Markov models.

Two first-order Markov models over the same characters are trained, one on random strings (those that the
patterns for hexadecimal strings and access keys find, and digests written in base 64 and in other letters) and one on
ordinary identifiers (the other words of documents). A run of such characters is reported if the mean of the
logarithm of its likelihood ratio is over a cut, which is chosen on samples that were held out. Only DataFrame
functions are used; a text is scanned where it lies, without a shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annospark.llm.scratch import drop, stored

#: The patterns. A match of the first counts only if its second group has 8 characters.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}+"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
RUN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}+"
KINDS = ["assign", "access", "hex", "markov"]
#: Random strings that are made for training, and the cut of a model without samples of both kinds.
MADE, NO_CUT = 2_000, 0.5
SPANS = "array<struct<start:bigint,end:bigint>>"


class Model(NamedTuple):
    """Log ratio of the probabilities, random over ordinary, of each pair of characters, and the least mean of
    these for a random string."""

    ratios: list[float]
    cut: float


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is found once, however often and wherever the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _parts(array: Column) -> Column:
    """An array, bound, cut into about as many arrays as each has elements."""
    size = F.greatest(F.ceil(F.sqrt(F.size(array))), F.lit(1)).cast("int")
    parts = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(array) / size), F.lit(1)).cast("int") - 1)
    return F.transform(parts, lambda k: F.slice(array, k * size + 1, size))


def _found(text: Column, pattern: str, hint: Column) -> Column:
    """array<struct<start, end>> of the matches, code points; matches are looked for only if ``hint``."""
    between = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(pattern), 0)
    pairs = F.zip_with(between, matches, lambda b, m: F.struct(F.length(b).alias("b"), F.length(m).alias("m")))
    empty = F.array().cast(SPANS)

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["b"]
        end = begin + x["m"]
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(F.struct(begin.alias("start"), end.alias("end")))).alias("spans"))

    def placed(parts: Column) -> Column:
        # An array that grows is copied for each element; in parts, with what lies before each, that stays little.
        lengths = F.transform(parts, lambda p: F.aggregate(p, F.lit(0).cast("bigint"), lambda acc, x: acc + x["b"] + x["m"]))
        zero = F.array(F.lit(0).cast("bigint"))
        before = F.aggregate(lengths, zero, lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))
        spans = F.zip_with(
            parts,
            F.slice(before, F.lit(1), F.size(parts)),
            lambda p, at: F.aggregate(p, F.struct(at.alias("at"), empty.alias("spans")), step, lambda acc: acc["spans"]),
        )
        return F.flatten(spans)

    whole = F.filter(pairs, lambda x: x["m"].isNotNull())
    return F.when(hint, _bound(whole, lambda a: _bound(_parts(a), placed))).otherwise(empty)


def _with_base(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with the spans of the patterns, assign, access, hex, and their values: group 2 of the
    first, the matches of the others."""
    text = F.col("text")
    hint = text.rlike(ASSIGN)
    value = F.regexp_extract_all(text, F.lit(ASSIGN), 2)
    spans = _found(text, ASSIGN, hint)
    assign = F.filter(F.zip_with(spans, F.when(hint, value).otherwise(F.array().cast("array<string>")), lambda s, v: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.length(v).alias("n"))), lambda x: x["n"] >= 8)
    none = F.array().cast("array<string>")
    values = F.concat(
        F.when(hint, F.filter(value, lambda v: F.length(v) >= 8)).otherwise(none),
        F.when(text.contains("AKIA"), F.regexp_extract_all(text, F.lit(ACCESS), 0)).otherwise(none),
        F.when(text.rlike(HEX), F.regexp_extract_all(text, F.lit(HEX), 0)).otherwise(none),
    )
    return docs.select(
        "doc_id",
        "text",
        values.alias("values"),
        F.transform(assign, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))).alias("assign"),
        _found(text, ACCESS, text.contains("AKIA")).alias("access"),
        _found(text, HEX, text.rlike(HEX)).alias("hex"),
    )


def _pairs(s: Column) -> Column:
    """The pairs of neighbouring characters, as numbers; null where one is not of the alphabet."""
    place = F.transform(F.split(s, ""), lambda c: F.nullif(F.position(c, F.lit(ALPHABET)), F.lit(0)) - 1)
    n = len(ALPHABET)
    return _bound(place, lambda p: F.zip_with(F.slice(p, F.lit(1), F.greatest(F.size(p) - 1, F.lit(0))), F.slice(p, F.lit(2), F.greatest(F.size(p) - 1, F.lit(0))), lambda a, b: a * n + b))


def _mean(s: Column, ratios: list[float]) -> Column:
    """Mean log-likelihood ratio of the pairs of a string of the alphabet's characters."""
    table = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")
    total = F.aggregate(_pairs(s), F.lit(0.0), lambda acc, k: acc + F.coalesce(F.get(table, k), F.lit(0.0)))
    return total / F.greatest(F.length(s) - 1, F.lit(1))


def _made(df: DataFrame) -> DataFrame:
    """Random strings (s): digests in base 64, as such, without its other signs, and in capitals."""
    digest = F.sha2(F.concat(F.lit("random "), F.col("id").cast("string")), 256)
    base = F.base64(F.unhex(digest))
    plain = F.regexp_replace(base, "[+/=]", "")
    kinds = [base, plain, F.upper(plain), F.upper(digest)]
    return df.sparkSession.range(MADE).select(F.element_at(F.array(*kinds), (F.col("id") % len(kinds) + 1).cast("int")).alias("s"))


def samples(docs: DataFrame, max_values: int = 20_000, max_documents: int = 2_000) -> DataFrame:
    """Labelled strings: s, random (boolean), held_out (a fifth, by hash; not learned from)."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    text, none = F.col("text"), F.array().cast("array<string>")
    values = F.concat(
        F.when(text.contains("AKIA"), F.regexp_extract_all(text, F.lit(ACCESS), 0)).otherwise(none),
        F.regexp_extract_all(text, F.lit(HEX), 0),
    )
    random = texts.select(F.explode(values).alias("s")).distinct().orderBy(F.md5("s"), "s").limit(max_values).unionByName(_made(docs))
    chosen = texts.select("doc_id").where("doc_id is not null").distinct()
    chosen = chosen.orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(max_documents)
    plain = F.regexp_replace(F.regexp_replace(F.regexp_replace("text", ASSIGN, " "), ACCESS, " "), HEX, " ")
    # At most max_documents rows are broadcast.
    ordinary = texts.join(F.broadcast(chosen), "doc_id").select(F.explode(F.regexp_extract_all(plain, F.lit("[A-Za-z0-9+/_=-]{4,}"), 0)).alias("s"))
    both = random.withColumn("random", F.lit(True)).unionByName(ordinary.withColumn("random", F.lit(False)))
    return both.withColumn("held_out", F.crc32(F.col("s").cast("binary")) % 5 == 0)


def train(docs: DataFrame, max_values: int = 20_000, max_documents: int = 2_000) -> Model:
    """A model from labelled samples: at most ``max_values`` values of patterns, ``MADE`` digests, and the words
    outside of patterns in at most ``max_documents`` documents, chosen by hash.

    Counts start at 1/2. The cut lies in the middle between the mean that one in a thousand of the held-out
    ordinary words of eight characters or more exceeds and that which one in a hundred of the held-out
    random strings falls short of. Without such words it is ``NO_CUT``.
    """
    labelled = stored(samples(docs, max_values, max_documents), "samples")
    learned = labelled.where("not held_out").select("random", F.explode(_pairs(F.col("s"))).alias("pair"))
    # A row for each pair of the alphabet at most.
    counted = {(r.random, r.pair): r.n for r in learned.where("pair is not null").groupBy("random", "pair").agg(F.count("*").alias("n")).collect()}
    n, logs = len(ALPHABET), {}
    for kind in (True, False):
        rows = [[counted.get((kind, a * n + b), 0) + 0.5 for b in range(n)] for a in range(n)]
        logs[kind] = [math.log(x / sum(row)) for row in rows for x in row]
    ratios = [a - b for a, b in zip(logs[True], logs[False], strict=True)]
    held = labelled.where("held_out and length(s) >= 8").select("random", _mean(F.col("s"), ratios).alias("x"))
    at = held.agg(
        F.percentile_approx(F.when(~F.col("random"), F.col("x")), F.lit(0.999), F.lit(10_000)).alias("plain"),
        F.percentile_approx(F.when(F.col("random"), F.col("x")), F.lit(0.01), F.lit(10_000)).alias("random"),
    ).first()
    drop(labelled)
    return Model(ratios, NO_CUT if at.plain is None or at.random is None else (at.plain + at.random) / 2)


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, assign, access, hex, markov (arrays of start and end, code points, end exclusive) and n_random (of
    the first three, those whose longest run is random by ``model``) of every row of ``docs``, which needs doc_id and
    text; other columns are not read.

    The first three have the leftmost matches of each pattern that do not overlap, markov the runs
    of at least 16 characters of the alphabet that overlap none of them and are random by ``model``.
    Null and empty texts have none. Rows with equal or null doc_id are scanned each.
    """
    rows = _with_base(docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")))
    text, hint = F.col("text"), F.col("text").rlike(RUN)
    runs = F.when(hint, F.regexp_extract_all(text, F.lit(RUN), 0)).otherwise(F.array().cast("array<string>"))
    named = F.zip_with(_found(text, RUN, hint), runs, lambda s, v: F.struct(s["start"].alias("start"), s["end"].alias("end"), v.alias("s")))
    base = F.sort_array(F.concat("assign", "access", "hex"))

    def ranged(spans: Column) -> Column:
        # Spans in parts with the range of each: a run looks into few of them.
        parts = F.filter(_parts(spans), lambda p: F.size(p) > 0)
        return F.transform(parts, lambda p: F.struct(p[0]["start"].alias("lo"), F.array_max(F.transform(p, lambda b: b["end"])).alias("hi"), p.alias("spans")))

    def free(x: Column) -> Column:
        meets = lambda r: F.exists(
            x["parts"],
            lambda p: (p["lo"] < r["end"]) & (p["hi"] > r["start"]) & F.exists(p["spans"], lambda b: (b["start"] < r["end"]) & (b["end"] > r["start"])),
        )
        return F.filter(x["runs"], lambda r: ~meets(r) & (_mean(r["s"], model.ratios) >= model.cut))

    both = F.struct(named.alias("runs"), _bound(base, ranged).alias("parts"))
    rows = rows.select("*", F.when(hint, _bound(both, free)).alias("random"))
    rows = rows.withColumn("random", F.coalesce("random", F.array().cast("array<struct<start:bigint,end:bigint,s:string>>")))
    markov = F.transform("random", lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end")))
    longest = lambda v: F.array_max(F.transform(F.split(v, "[.]+"), lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"]
    n_random = F.size(F.filter("values", lambda v: _mean(longest(v), model.ratios) >= model.cut)).cast("long")
    return rows.select("doc_id", "assign", "access", "hex", markov.alias("markov"), n_random.alias("n_random"))


def joined(kinds: list[str]) -> Column:
    """kind:start:end of the spans of the columns ``kinds``, by start, then kind in that order."""
    def named(i: int, kind: str) -> Column:
        return F.transform(kind, lambda s: F.struct(s["start"].alias("start"), F.lit(i).alias("i"), s["end"].alias("end"), F.lit(kind).alias("k")))

    every = [named(i, kind) for i, kind in enumerate(kinds)]
    ordered = F.sort_array(F.concat(*every))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["k"], s["start"], s["end"])), ",")
