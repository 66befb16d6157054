"""Connected components of a set of links, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from annospark.llm.scratch import stored


def _written(links: DataFrame) -> tuple[DataFrame, dict]:
    """``links`` stored, and a mark of its rows, taken while they are written."""
    seen = Observation()
    mark = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("mark")
    return stored(links.observe(seen, F.count(F.lit(1)).alias("n"), mark), "links"), seen.get


def components(links: DataFrame, together: int = 0) -> DataFrame:
    """(node, component) of every node of ``links`` (columns a, b); component is the least node
    that can be reached.

    Large-star and small-star steps alternate until no link changes; each step joins and groups by
    one node, sums before it shuffles, and each pair of steps is written to the shared folder. Their
    number grows with the logarithm of the longest path. Up to ``together`` links are handled by one task, without
    shuffles. No links give no rows.
    """
    links, mark = _written(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    )
    while mark["n"]:
        # No more than two rows for each link; where these are few, they go to the rows.
        near = F.broadcast if mark["n"] <= 200_000 else lambda df: df
        dealt = (lambda df: df.coalesce(1)) if mark["n"] <= together else lambda df: df
        both = dealt(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        # Large star: the larger neighbours of a node go to the least of its neighbourhood.
        star = both.join(near(least), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        # Small star: a node and its smaller neighbours go to the least of these.
        least = star.groupBy("a").agg(F.min("b").alias("m"))
        moved = star.join(near(least), "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links, now = _written(dealt(moved.unionByName(least.select("a", F.col("m").alias("b")))).distinct())
        if now == mark:
            break
        mark = now
    members = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return members.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
