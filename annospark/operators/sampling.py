"""Class-balanced draws, their ids, and counts of labels. DataFrames in, DataFrames out."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from annospark.functions import labels
from annospark.operators import paths, profile
from annospark.sources import work


def priority(seed: int, *keys: str) -> Column:
    """A number, as text, that depends on the seed and the keys alone."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def draw(rows: DataFrame, by: str, key: str, k: int, seed: int = 42) -> DataFrame:
    """A uniform sample of min(k, size) rows of each class ``by``, without replacement, the same
    whatever the partitions. Each task passes on at most k rows a class."""
    order = Window.partitionBy(by).orderBy(F.desc("_priority"), key)
    ranked = rows.withColumn("_priority", priority(seed, key)).withColumn("_rank", F.row_number().over(order))
    return ranked.where(F.col("_rank") <= k).drop("_priority", "_rank")


def pool_size(per_class: int) -> int:
    """Rows of a class to draw so that enough remain when some turn out unreadable."""
    return max(3 * per_class, per_class + 100)


def fill(pool: DataFrame, by: str, key: str, k: int, ok: str, preference: str, seed: int = 42) -> DataFrame:
    """The first k rows of each class for which ``ok`` holds, by ``preference`` (least first), then by
    descending priority, with rank from 1."""
    order = Window.partitionBy(by).orderBy(preference, F.desc("_priority"), key)
    good = pool.where(F.col(ok)).withColumn("_priority", priority(seed, key)).withColumn("rank", F.row_number().over(order))
    return good.where(F.col("rank") <= k).drop("_priority")


def fill_errors(pool: DataFrame, by: str, key: str, k: int, ok: str, preference: str, seed: int = 42) -> DataFrame:
    """Rows that ``fill`` met and passed over: those that fail before the class is full. A class gives its last
    filled row, one at most, to the join; its rows are not ordered as a whole."""
    place = F.struct(F.col(preference).alias("a"), F.translate("_priority", "0123456789abcdef", "fedcba9876543210").alias("b"), F.col(key).alias("c"))
    rows = pool.withColumn("_priority", priority(seed, key)).withColumn("_place", place).drop("_priority")
    last = fill(pool, by, key, k, ok, preference, seed).where(F.col("rank") == k).select(by, key)
    last = rows.join(last, [by, key]).groupBy(by).agg(F.max("_place").alias("_last"))
    failed = rows.where(~F.col(ok)).join(last, by, "left")
    return failed.where(F.col("_last").isNull() | (F.col("_place") < F.col("_last"))).drop("_place", "_last")


def fill_lazily(
    pool: DataFrame, by: str, key: str, k: int, verify: Callable[[DataFrame], DataFrame], preference: str, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """(chosen, failed) as ``fill`` and ``fill_errors`` give them, but without knowing ``ok`` of the whole pool: rows of
    ``pool`` are verified in ranges of rank, and no more ranges than a class needs.

    ``verify`` takes rows and returns them with a boolean ok, and what else it tells; null counts as false. Of each class as
    many rows as it lacks are verified, a half more for each share that failed so far, until k are ok or none is left.
    A class is a row to the driver. Rows of a round are written before the next. chosen has rank from 1 within its class.
    """
    order = Window.partitionBy(by).orderBy(preference, F.desc("_priority"), key)
    rows = pool.withColumn("_priority", priority(seed, key)).withColumn("_place", F.row_number().over(order)).drop("_priority")
    rows = work.written(rows, "pool")
    # One row for each class.
    sizes = {r[by]: r["n"] for r in rows.groupBy(by).agg(F.count("*").alias("n")).collect()}
    seen, good, done = dict.fromkeys(sizes, 0), dict.fromkeys(sizes, 0), []
    while short := [c for c in sizes if good[c] < k and seen[c] < sizes[c]]:
        upto = {}
        for c in short:
            rate = max(good[c], 1) / max(seen[c], 1) if seen[c] else 1.0
            upto[c] = min(seen[c] + max(1, round((k - good[c]) / max(rate, 0.1))), sizes[c])
        wanted = reduce(Column.__or__, [F.col(by).eqNullSafe(F.lit(c)) & F.col("_place").between(seen[c] + 1, upto[c]) for c in short])
        told = work.written(verify(rows.where(wanted)).withColumn("ok", F.coalesce("ok", F.lit(False))), "verified")
        for r in told.where("ok").groupBy(by).agg(F.count("*").alias("n")).collect():
            good[r[by]] += r["n"]
        seen |= upto
        done.append(told)
    if not done:
        done = [verify(rows.limit(0))]
    told = reduce(DataFrame.unionByName, done)
    # The verified rows alone are ranked again: about k for each class.
    so_far = Window.partitionBy(by).orderBy("_place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = told.withColumn("rank", F.count_if("ok").over(so_far).cast("int"))
    chosen = counted.where(F.col("ok") & (F.col("rank") <= k)).drop("_place", "ok")
    return chosen, counted.where(~F.col("ok") & (F.col("rank") < k)).drop("_place", "ok", "rank")


def first_of_class(rows: DataFrame, by: str, order: str, k: int) -> DataFrame:
    """The first k rows of each class in stream order, with rank from 1."""
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(order)))
    return ranked.where(F.col("rank") <= k)


def ranked(rows: DataFrame, by: str, order: str, tie: str | None = None) -> DataFrame:
    """``rows`` with rank, their place from 1 in their class by ``order``, then ``tie``, without one task for a class: rows
    are dealt out by ranges of class, order and tie, so a class, or a value that many rows share, lies in many tasks; each
    row's place in its range is known there, and the counts of the ranges before, a row for each range and class, are
    added. Rows with a null order come first. Without ``tie`` rows of equal order take any place among themselves, the
    same for one reading of the rows."""
    keys = [by, order, tie or "_row"]
    placed = rows.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    # Written, so that places are those of one run, whatever is lost.
    placed = work.written(placed.withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33)).drop("_row"), "ranked")
    counts = placed.groupBy(by, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select(F.col(by).alias("_by"), F.col("_part").alias("_of"), (before - F.col("_first")).alias("_move"))
    both = placed.join(starts, F.col(by).eqNullSafe(F.col("_by")) & (F.col("_part") == F.col("_of")))
    return both.withColumn("rank", F.col("_at") + F.col("_move") + 1).drop("_by", "_of", "_move", "_at", "_part")


def payload(source: DataFrame, chosen: DataFrame, key: str, max_bytes: int = 64 << 20) -> DataFrame:
    """The rows of ``source``, with all their columns, that ``chosen`` (key, and what it adds) names. A draw needs
    keys alone; the rest of a row is read for those that it chose. ``chosen`` is evaluated once, into a table, and
    broadcast if its rows, by the length of their JSON, have at most ``max_bytes``; else rows are joined by a shuffle."""
    extra = [c for c in chosen.columns if c == key or c not in source.columns]
    keys = work.written(chosen.select(*extra), "chosen")
    size = keys.agg(F.sum(F.octet_length(F.to_json(F.struct(*extra))) + 16).alias("n")).first()["n"] or 0
    return source.join(F.broadcast(keys) if size <= max_bytes else keys, key)


def file_sample(files: DataFrame, by: str, name: str, path: str, k: int, seed: int = 42) -> DataFrame:
    """Exactly k files of each class, all where a class has k, with rank from 1 by file name, then path;
    ``ValueError`` if a class has fewer."""
    short = files.groupBy(by).count().where(F.col("count") < k).first()
    if short:
        raise ValueError(f"{short[by]} has {short['count']} files of {k}")
    order = Window.partitionBy(by).orderBy(name, path)
    return draw(files, by, path, k, seed).withColumn("rank", F.row_number().over(order))


#: A manifest's order: real before others, each by its place in the source.
ORDER = ["label_id", "source_original_index"]


def ordered(sample: DataFrame) -> DataFrame:
    """A manifest as it is written."""
    return sample.orderBy(*ORDER, "id")


def draw_summary(sample: DataFrame) -> DataFrame:
    """One row: n, n_real, n_fake, n_sources of a manifest, first_index and last_index of what it was drawn from."""
    return sample.agg(
        F.count("*").alias("n"),
        F.count_if(F.col("label") == "REAL").alias("n_real"),
        F.count_if(F.col("label") == "AI-GENERATED").alias("n_fake"),
        F.count_distinct("source_dataset").alias("n_sources"),
        F.min("source_original_index").alias("first_index"),
        F.max("source_original_index").alias("last_index"),
    )


def label_names(rows: DataFrame, raw: str, card: DataFrame, classes: DataFrame | None, others: list[str] | None = None) -> DataFrame:
    """``rows`` with label_name: that of the card (raw_value, label_name), else that of the class names (class_id,
    class_name), where the label has such, else the raw value if it is a string. Values that have none get the explicit
    name of the string columns ``others``, if these are given and agree. Card and classes are small tables with each value once."""
    value = F.col(raw).cast("string")
    names = card.select(F.col("raw_value").alias("_raw"), F.col("label_name").alias("_card"))
    both = rows.join(names, value == F.col("_raw"), "left").withColumn("_name", F.lit(None).cast("string"))
    if classes is not None:
        own = classes.select(F.col("class_id").cast("long").alias("_class"), F.col("class_name").alias("_own"))
        both = both.join(own, F.btrim(value).try_cast("long") == F.col("_class"), "left").withColumn("_name", F.col("_own")).drop("_class", "_own")
    given = [F.col("_card"), F.col("_name")] + ([value] if isinstance(rows.schema[raw].dataType, StringType) else [])
    if others:
        given.append(profile.explicit_name(others, raw)[0])
    return both.withColumn("label_name", F.coalesce(*given)).drop("_raw", "_card", "_name")


def until_complete(rows: DataFrame, by: str, order: str, k: int, classes: list[str]) -> DataFrame:
    """``rows`` up to the one with which the last class gets its k-th row; all, if one never does."""
    nth = first_of_class(rows.where(F.col(by).isin(classes)), by, order, k).groupBy(by).agg(F.count("*").alias("n"), F.max(order).alias("at"))
    full = nth.agg(F.when(F.count_if(F.col("n") == k) == len(classes), F.max("at")).alias("cutoff"))
    # One row.
    return rows.join(F.broadcast(full)).where(F.col("cutoff").isNull() | (F.col(order) <= F.col("cutoff"))).drop("cutoff")


def manifest(sample: DataFrame, label: str, order: str, path: Column, source: Column, prefixes: tuple[str, str] = labels.ID_PREFIXES) -> DataFrame:
    """id, image_path, label, label_id, source_dataset and source_original_index of sampled rows:
    ids by rank in ``order`` within the label, after one of ``prefixes``."""
    rank = F.row_number().over(Window.partitionBy(label).orderBy(order))
    rows = sample.withColumn("_rank", rank)
    return rows.select(
        labels.sample_id(F.col(label), F.col("_rank"), prefixes).alias("id"),
        path.alias("image_path"),
        F.col(label).alias("label"),
        F.when(F.col(label) == "REAL", 0).otherwise(1).alias("label_id"),
        source.alias("source_dataset"),
        F.col(order).alias("source_original_index"),
    )


def with_metadata(rows: DataFrame, metadata: DataFrame, order: str, root: str = "/") -> DataFrame:
    """``rows`` with what ``metadata`` has for their image_path; of several rows the last counts. Paths are compared as
    ``paths.resolved`` makes them, relative ones below ``root``; metadata without a path says nothing. Values of rows
    that metadata doesn't have stay."""
    extra = [c for c in metadata.columns if c not in ("image_path", order)]
    named = metadata.where(F.col("image_path") != "").withColumn("_key", paths.resolved(F.col("image_path"), root))
    one = named.groupBy("_key").agg(F.max_by(F.struct(*[F.col(c).alias(f"_{c}") for c in extra]), order).alias("_last"))
    joined = rows.withColumn("_key", paths.resolved(F.col("image_path"), root)).join(one, "_key", "left").select("*", "_last.*")
    kept = {c: F.coalesce(f"_{c}", c) if c in rows.columns else F.col(f"_{c}") for c in extra}
    return joined.withColumns(kept).drop("_key", "_last", *[f"_{c}" for c in extra])


def shuffled(rows: DataFrame, seed: int, key: str = "id") -> DataFrame:
    """``rows`` in an order that depends on the seed and the key alone."""
    return rows.orderBy(priority(seed, key), key)


def scan_report(rows: DataFrame, split: str, raw: str, kind: str) -> DataFrame:
    """dimension, value, n: counts by split, raw label and category, and in all, in one pass."""
    rows = rows.select(F.coalesce(split, F.lit("unknown")).alias("s"), F.coalesce(raw, F.lit("null")).alias("r"), F.coalesce(kind, F.lit("unknown")).alias("k"))
    sets = rows.groupingSets([["s"], ["r"], ["k"], []], "s", "r", "k").agg(F.count("*").alias("n"), F.grouping_id().alias("g"))
    dimension = F.when(F.col("g") == 3, "split").when(F.col("g") == 5, "raw_label").when(F.col("g") == 6, "category").otherwise("total")
    return sets.select(dimension.alias("dimension"), F.coalesce("s", "r", "k", F.lit("all")).alias("value"), "n")


def label_map(rows: DataFrame, raw: str, name: str, kind: str, order: str) -> DataFrame:
    """raw_label, label_name (the last in order), category, example (the first row), n, conflict."""
    return rows.where(F.col(raw).isNotNull()).groupBy(F.col(raw).alias("raw_label")).agg(
        F.max_by(name, order).alias("label_name"),
        F.min(kind).alias("category"),
        F.min(order).alias("example"),
        F.count("*").alias("n"),
        (F.count_distinct(kind) > 1).alias("conflict"),
    )


def gate_violations(rows: DataFrame, raw: str, kind: str, label: str, quota: int) -> DataFrame:
    """gate, value, n of what a strict run stops at: labels without a category, raw labels with two,
    and classes that don't reach ``quota``."""
    unknown = rows.where(F.col(kind).isNull()).groupBy(F.coalesce(raw, F.lit("null")).alias("value")).agg(F.count("*").alias("n"))
    twice = rows.groupBy(F.col(raw).alias("value")).agg(F.count_distinct(kind).alias("n")).where("n > 1")
    classes = F.array(F.lit("REAL"), F.lit("AI-GENERATED"))
    have = rows.agg(*[F.count_if(F.col(label) == c).alias(c) for c in ("REAL", "AI-GENERATED")])
    short = have.select(F.explode(F.transform(classes, lambda c: F.struct(c.alias("value"), F.when(c == "REAL", F.col("REAL")).otherwise(F.col("`AI-GENERATED`")).alias("n")))).alias("x"))
    short = short.select("x.*").where(F.col("n") < quota)
    named = [df.select(F.lit(gate).alias("gate"), "value", F.col("n").cast("long").alias("n")) for gate, df in (("unknown_label", unknown), ("two_categories", twice), ("quota_not_reached", short))]
    return named[0].unionByName(named[1]).unionByName(named[2])


def strict(violations: DataFrame) -> None:
    """Raise if there is a violation."""
    if first := violations.first():
        raise ValueError(f"gate {first['gate']}: {first['value']}")
