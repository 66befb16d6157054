"""Quality rules: fixed limits, then robust multivariate outliers by language and source.

Per language and source, a minimum-covariance-determinant estimate of location and scatter is made of
five transformed statistics; documents whose Mahalanobis distance is too large are rejected. Only
DataFrame functions are used.

The estimate starts, in two ways, from the documents nearest to the medians and takes concentration
steps: mean and covariance of the nearest three quarters, distances by these, again the nearest three
quarters. Of the two results the one with the lesser determinant holds. Quantiles come from counts in
bins and sums are of whole numbers, so the result doesn't hang on the order of rows, every group
is summed before it is shuffled, and what is joined back has one row per group.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annospark.llm.scratch import scoped, small, stored

#: Share of a group that the estimate rests on, and steps.
SHARE, STEPS = 0.75, 3
#: Groups of fewer documents are joined to one per language, and such of fewer are judged by all documents.
MIN_GROUP = 60
#: Share of normal vectors that would be rejected: one in a million, for of a corpus of many millions of documents hardly
#: any ordinary one may go.
LEVEL = 1e-6
#: Fixed value: 0.75 / P(chi2(7) <= chi2 quantile(5, 0.75)), which makes the scatter of the nearest
#: three quarters that of the whole, for normal statistics.
CONSISTENCY = 1.413
#: Least standard deviation of each statistic: what is nearly constant must not look far away.
FLOORS = {"length": 0.5, "word": 0.08, "symbols": 0.03, "lines": 0.35, "repeats": 0.12}
NAMES = list(FLOORS)
SCALE = 10_000
#: Name of the group of all documents; others hold a line feed.
ALL = "*"
WORD_BREAK = "[ \\t-\\r]+"


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = F.coalesce("text", F.lit(""))
    split = docs.select(
        F.col("doc_id").cast("long"),
        "lang",
        "source",
        text.alias("text"),
        F.filter(F.split(text, WORD_BREAK), lambda w: w != "").alias("w"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike("[^ \\t-\\r]")).alias("lines"),
    )
    n = F.size("w")
    three = F.expr("transform(slice(w, 1, greatest(size(w) - 2, 0)), (x, i) -> xxhash64(x, w[i + 1], w[i + 2]))")
    counted = split.select(
        "doc_id",
        "lang",
        "source",
        n.cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", WORD_BREAK, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        three.alias("three"),
    )
    # Equal windows stand side by side when sorted; then each repeated one covers the words up to
    # the next one, three at most.
    some = F.size(F.array_distinct("three")) < F.size("three")
    sorted_ = F.when(some, F.expr("sort_array(transform(three, (h, i) -> struct(h as h, i as i)))"))
    counted = counted.select("*", sorted_.alias("s")).drop("three")
    again = "(k > 0 and get(s, k - 1).h = x.h) or (k < size(s) - 1 and get(s, k + 1).h = x.h)"
    counted = counted.select("*", F.expr(f"sort_array(transform(filter(s, (x, k) -> {again}), x -> x.i))").alias("p")).drop("s")
    covered = F.expr("aggregate(transform(p, (x, k) -> least(3, coalesce(get(p, k + 1) - x, 3))), 0L, (a, x) -> a + x)")
    return counted.select("*", F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words")).drop("p")


def cut(level: float = LEVEL) -> float:
    """The squared distance that a normal vector of five statistics exceeds with probability ``level``: the chi-square
    quantile, by halving."""

    def beyond(x: float) -> float:
        return math.erfc(math.sqrt(x / 2)) + math.sqrt(2 * x / math.pi) * math.exp(-x / 2) * (1 + x / 3)

    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if beyond(mid) > level else (low, mid)
    return high


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _vector() -> list[Column]:
    """The transformed statistics, as whole numbers of 1/SCALE."""
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    values = {
        "length": F.log(words),
        "word": F.log(chars / words),
        "symbols": F.sqrt(F.col("n_symbols") / chars),
        "lines": F.log1p("n_dup_lines"),
        "repeats": F.sqrt(F.col("n_repeat_words") / words),
    }
    return [F.round(values[k] * SCALE).cast("long").alias(k) for k in NAMES]


def _at_share(counts: DataFrame, keys: list[str], shares: dict[str, float]) -> DataFrame:
    """For each key and share, the least bin at which that share of the rows is reached. ``counts`` has
    the columns keys, bin, k; a group has as many rows here as it has bins."""
    order = Window.partitionBy(*keys)
    upto = counts.select(*keys, "bin", F.sum("k").over(order.orderBy("bin")).alias("upto"), F.sum("k").over(order).alias("all"))
    picks = [F.min(F.when(F.col("upto") >= F.col("all") * s, F.col("bin"))).alias(name) for name, s in shares.items()]
    return upto.groupBy(*keys).agg(*picks)


def _medians(rows: DataFrame) -> DataFrame:
    """grp, and for each statistic its median and spread, from the quartiles of bins of 1/200."""
    tall = rows.select("grp", F.explode(F.array(*[F.struct(F.lit(k).alias("name"), F.col(k).alias("v")) for k in NAMES])).alias("x"))
    counts = tall.groupBy("grp", F.col("x.name").alias("name"), F.floor(F.col("x.v") * 200 / SCALE).alias("bin")).agg(F.count("*").alias("k"))
    found = _at_share(counts, ["grp", "name"], {"q1": 0.25, "q2": 0.5, "q3": 0.75})
    pick = lambda c, k: F.max(F.when(F.col("name") == k, c))
    columns = []
    for k in NAMES:
        columns.append((pick((F.col("q2") + 0.5) / 200, k)).alias(f"mid_{k}"))
        columns.append(F.greatest(pick((F.col("q3") - F.col("q1")) / 200 / 1.349, k), F.lit(FLOORS[k])).alias(f"spread_{k}"))
    return found.groupBy("grp").agg(*columns)


def _nearest(rows: DataFrame) -> DataFrame:
    """Of rows (grp, start, d2, statistics) those within the share of least distances, by bins."""
    binned = rows.withColumn("bin", F.floor(F.log(F.col("d2") + 1e-6) * 20))
    counts = binned.groupBy("grp", "start", "bin").agg(F.count("*").alias("k"))
    limit = stored(_at_share(counts, ["grp", "start"], {"most": SHARE}), "limits")
    return binned.join(small(limit), ["grp", "start"]).where("bin <= most")


def _estimate(rows: DataFrame) -> DataFrame:
    """grp, start, means, the Cholesky factor of the covariance, and logdet."""
    exact = lambda c: F.sum(c.cast("decimal(25,0)")).cast("double")
    sums = [exact(F.col(a)).alias(f"s_{a}") for a in NAMES]
    sums += [exact(F.col(a) * F.col(b)).alias(f"s_{a}_{b}") for i, a in enumerate(NAMES) for b in NAMES[: i + 1]]
    found = rows.groupBy("grp", "start").agg(F.count("*").alias("n"), *sums)
    found = found.select("grp", "start", "n", *[(F.col(f"s_{a}") / F.col("n") / SCALE).alias(f"m_{a}") for a in NAMES], *[
        F.col(f"s_{a}_{b}") / F.col("n") / SCALE**2 - F.col(f"s_{a}") / F.col("n") * F.col(f"s_{b}") / F.col("n") / SCALE**2
        for i, a in enumerate(NAMES) for b in NAMES[: i + 1]
    ]).toDF("grp", "start", "n", *[f"m_{a}" for a in NAMES], *[f"c_{a}_{b}" for i, a in enumerate(NAMES) for b in NAMES[: i + 1]])
    for j, b in enumerate(NAMES):
        for a in NAMES[j:]:
            value = F.col(f"c_{a}_{b}") * CONSISTENCY
            if a == b:
                value = F.greatest(value, F.lit(0.0)) + FLOORS[a] ** 2
            for c in NAMES[:j]:
                value = value - F.col(f"l_{a}_{c}") * F.col(f"l_{b}_{c}")
            value = F.sqrt(F.greatest(value, F.lit(1e-9))) if a == b else value / F.col(f"l_{b}_{b}")
            found = found.withColumn(f"l_{a}_{b}", value)
    logdet = sum((F.log(f"l_{a}_{a}") for a in NAMES[1:]), F.log(f"l_{NAMES[0]}_{NAMES[0]}"))
    return stored(found.drop(*[c for c in found.columns if c[:2] == "c_"]).withColumn("logdet", logdet), "estimates")


def _distances(rows: DataFrame, estimate: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``rows`` with d2, the squared Mahalanobis distance."""
    found = rows.join(small(estimate), keys, how)
    for i, a in enumerate(NAMES):
        value = F.col(a) / SCALE - F.col(f"m_{a}")
        for b in NAMES[:i]:
            value = value - F.col(f"l_{a}_{b}") * F.col(f"y_{b}")
        found = found.withColumn(f"y_{a}", value / F.col(f"l_{a}_{a}"))
    d2 = sum((F.col(f"y_{a}") ** 2 for a in NAMES[1:]), F.col(f"y_{NAMES[0]}") ** 2)
    return found.select(*rows.columns, d2.alias("d2"))


@scoped
def check(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    distance2 of every row of ``docs``, which needs doc_id, text, lang and source.

    Words are runs of characters other than ASCII white space. n_dup_lines counts lines with a word
    that equal an earlier one of their text, n_repeat_words the words in windows of three words that
    the text has twice or more (windows are told apart by 64-bit hashes). A document fails the base
    rules with fewer than 50 words, or with more than half of them repeated; only others enter the
    estimates. Null texts count as empty; a null lang or source is a value of its own. Rows with
    equal or null doc_id are judged each. distance2 is null for documents of a language and source none of whose
    documents pass the base rules. No documents give no rows.
    """
    rows = statistics(docs).withColumn("base_failed", base_failed())
    named = lambda c: F.coalesce(F.concat(F.lit("="), c), F.lit("-"))
    pool = F.concat(named("lang"), F.lit("\n"))
    rows = rows.select("*", pool.alias("pool"), F.concat(pool, named("source")).alias("own"), *_vector()).drop("lang", "source")
    rows = stored(rows, "statistics")
    sizes = rows.where(~F.col("base_failed")).groupBy("pool", "own").agg(F.count("*").alias("size"))
    sizes = sizes.withColumn("grp", F.when(F.col("size") >= MIN_GROUP, F.col("own")).otherwise(F.col("pool")))
    sizes = sizes.select("own", "grp", F.sum("size").over(Window.partitionBy("grp")).alias("size"))
    groups = stored(sizes.select("own", F.when(F.col("size") >= MIN_GROUP, F.col("grp")).otherwise(ALL).alias("grp")), "groups")
    rows = rows.join(small(groups), "own", "left").drop("own", "pool")

    fit = rows.where(~F.col("base_failed")).select("grp", *NAMES)
    if not groups.where(F.col("grp") == ALL).isEmpty():
        fit = fit.where(F.col("grp") != ALL).unionByName(fit.withColumn("grp", F.lit(ALL)))
    fit = stored(fit, "fit")
    middle = fit.join(small(stored(_medians(fit), "medians")), "grp")
    off = [(F.col(k) / SCALE - F.col(f"mid_{k}")) / F.col(f"spread_{k}") for k in NAMES]
    total, most = sum((z * z for z in off[1:]), off[0] * off[0]), F.greatest(*[z * z for z in off])
    starts = F.explode(F.array(F.struct(F.lit(0).alias("start"), total.alias("d2")), F.struct(F.lit(1).alias("start"), most.alias("d2"))))
    near = _nearest(middle.select("grp", *NAMES, starts.alias("x")).select("grp", *NAMES, "x.*"))
    both = fit.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("start"))
    for _ in range(STEPS):
        near = _nearest(_distances(both, _estimate(near), ["grp", "start"]))
    final = _estimate(near)
    fields = [c for c in final.columns if c not in ("grp", "start", "n", "logdet")]
    best = final.groupBy("grp").agg(F.min(F.struct("logdet", "start", *fields)).alias("b")).select("grp", "b.*")
    judged = _distances(rows, stored(best, "estimates"), ["grp"], "left")
    kept = ~F.col("base_failed") & F.coalesce(F.col("d2") <= cut(), F.lit(True))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *counts, "base_failed", kept.alias("kept"), F.col("d2").alias("distance2"))
