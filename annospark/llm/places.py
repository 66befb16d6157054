"""Rows of documents told apart where a doc_id repeats, and joins with keys that many rows share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annospark.llm.scratch import small, stored

#: Keys with more than this share of all rows are never shuffled; there are at most this many.
HOT_KEYS = 20_000


def placed(docs: DataFrame, *columns: str | Column) -> DataFrame:
    """Rows doc_id, part, text and ``columns`` of ``docs``. part is 0, but where a doc_id has several rows a hash
    of the text (of 31 bits), so rows with equal doc_id and text are one place."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *columns)
    repeated = rows.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("k")).where("k > 1").select("doc_id", F.lit(1).alias("again"))
    repeated = stored(repeated, "repeated")
    if repeated.isEmpty():
        return rows.select("doc_id", F.lit(0).cast("long").alias("part"), *rows.columns[1:])
    part = F.when(F.col("again").isNotNull(), F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(1 << 31))).otherwise(0)
    return rows.join(small(repeated), "doc_id", "left").select("doc_id", part.alias("part"), *rows.columns[1:])


def joined(rows: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Inner join of ``rows`` with ``keys``, a stored table with one row for each key and the number k of its
    rows. Few keys are broadcast. Of many, those with a large share of the rows are, which are at most
    ``HOT_KEYS``, and the rest is shuffled, so no task gets all rows of a hot key. k isn't returned."""
    size = keys.agg(F.count("*").alias("n"), F.sum("k").alias("all")).first()
    if size.n <= 400_000:
        return rows.join(F.broadcast(keys.drop("k")), on)
    limit = size["all"] // HOT_KEYS
    hot, cold = keys.where(F.col("k") > limit).drop("k"), keys.where(F.col("k") <= limit).drop("k")
    marked = rows.join(F.broadcast(hot.select(*on, F.lit(True).alias("_hot"))), on, "left")
    rest = marked.where(F.col("_hot").isNull()).drop("_hot").join(cold, on)
    return rows.join(F.broadcast(hot), on).unionByName(rest)
