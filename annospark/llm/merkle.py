"""Merkle dataset manifest: digests of rows, of each source and of the whole, with a proof for every row.

A level of the tree is kept as one hex string for each aligned block of ``FAN ** 2`` nodes. Parents are digests of
fixed-width substrings of it, the substrings that flank a node in its run are its siblings, and the roots of the blocks
are the nodes of the next tier, until a group has one block. No task sees more than a block at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annospark.llm.scratch import small, stored

#: Nodes of a run, and hex digits of a digest.
FAN, HEX = 16, 64
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(**changed: Column) -> Column:
    """Digest of a row of documents; ``changed`` are columns to take in place of the row's own."""
    return F.sha2(F.concat(*[field(changed.get(c, F.col(c))) for c in COLUMNS]), 256)


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings, from the lowest level up, lead to."""
    return F.aggregate(path, start, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def proof(path: Column) -> Column:
    """Digest of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def numbered(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """``rows``, stored, with pos, their place from 0 in their group by ``order``; rows that tie take any. Rows are
    dealt out by ranges of group and order, so a hot group lies in many tasks and only counts of ranges are summed."""
    keys = [group, *order, "_row"]
    ranges = rows.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = stored(ranges.withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33)).drop("_row"), "placed")
    counts = placed.groupBy(group, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = stored(counts.select(group, "_part", (before - F.col("_first")).alias("_move")), "starts")
    return placed.join(small(starts), [group, "_part"]).withColumn("pos", F.col("_at") + F.col("_move")).drop("_at", "_part", "_move")


def _cut(level: Column, start: Column, width: Column) -> Column:
    return level.substr((start + 1).cast("int"), width.cast("int"))


def _parents(level: Column) -> Column:
    """The level above: a digest for each run, the last of which may be short."""
    runs = F.sequence(F.lit(0), F.floor((F.length(level) - 1) / F.lit(FAN * HEX)).cast("int"))
    return F.array_join(F.transform(runs, lambda k: F.sha2(_cut(level, k * FAN * HEX, F.lit(FAN * HEX)), 256)), "")


def _siblings(level: Column, node: Column) -> Column:
    """left and right: the digests of the node's run before and after it."""
    inside = node % FAN
    left = _cut(level, (node - inside) * HEX, inside * HEX)
    return F.struct(left.alias("left"), _cut(level, (node + 1) * HEX, (F.lit(FAN - 1) - inside) * HEX).alias("right"))


def _tier(nodes: DataFrame) -> DataFrame:
    """Blocks of ``nodes`` (group, pos, node with its hash), stored: group, block, nodes, the two lower levels, their
    number of steps and root. The first block is alone if it isn't full; only then fewer than two steps are taken."""
    blocks = nodes.groupBy("group", F.floor(F.col("pos") / FAN**2).alias("block")).agg(F.sort_array(F.collect_list(F.struct("pos", "node"))).alias("nodes"))
    n, first = F.size("nodes"), F.col("block") == 0
    steps = F.when(first & (n == 1), 0).when(first & (n <= FAN), 1).otherwise(2)
    blocks = blocks.withColumns({"level0": F.array_join(F.transform("nodes", lambda x: x["node"]["hash"]), ""), "steps": steps})
    blocks = blocks.withColumn("level1", F.when(F.col("steps") > 0, _parents(F.col("level0"))))
    root = F.when(F.col("steps") == 0, F.col("level0")).when(F.col("steps") == 1, F.col("level1")).otherwise(F.sha2("level1", 256))
    return stored(blocks.withColumn("root", root), "blocks")


def _tiers(nodes: DataFrame) -> list[DataFrame]:
    """Blocks of the nodes, of the blocks' roots, and so on until each group has one block."""
    tiers = [_tier(nodes)]
    while not tiers[-1].where("block > 0").isEmpty():
        tiers.append(_tier(tiers[-1].select("group", F.col("block").alias("pos"), F.struct(F.col("root").alias("hash")).alias("node"))))
    return tiers


def _paths(tiers: list[DataFrame], tops: DataFrame) -> DataFrame:
    """node, path and the other columns of ``tops`` (group, path above the group's root, others) for every node."""
    others = [c for c in tops.columns if c not in ("group", "path")]
    above = tops.withColumn("block", F.lit(0).cast("long"))
    for tier in reversed(tiers):
        blocks = tier.select("group", "block", "nodes", "level0", "level1", "steps").join(above, ["group", "block"])
        at = blocks.select("*", F.posexplode("nodes").alias("at", "x"))
        own = F.array(_siblings(F.col("level0"), F.col("at")), _siblings(F.col("level1"), F.floor(F.col("at") / FAN)))
        path = F.concat(F.slice(own, F.lit(1), F.col("steps")), "path")
        above = at.select("group", F.col("x.pos").alias("block"), "x.node", path.alias("path"), *others)
    return above


def manifest(docs: DataFrame, *carried: Column) -> DataFrame:
    """doc_id, leaf, path, subroot, root of every row of ``docs``, and the named columns ``carried``.

    ``docs`` needs the columns of documents; others may follow and are not part of a leaf. A leaf digests the five
    fields, each with its length, a null as a dash. The leaves of a source ascend by doc_id (null first; equal ids by
    leaf, so repeated rows take any order of the same tree). While a source has several nodes, every ``FAN`` of
    them, the last run as many as there are, get a parent; what remains is the subroot, and the subroots, null source
    first, have a tree of their own, whose root is the manifest's. path holds the siblings of a leaf, left and
    right, for each level up to the root; a level where the node has none holds two empty texts. ``folded(leaf, path)``
    is the root again. No documents give no rows. Tables are written to the scratch folder; see ``scratch.scope``.
    """
    source = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    leaves = docs.select(F.col("doc_id").cast("long").alias("doc_id"), source.alias("group"), leaf().alias("hash"), *carried)
    leaves = numbered(leaves, "group", "doc_id", "hash")
    payload = [c for c in leaves.columns if c not in ("group", "pos")]
    tiers = _tiers(leaves.select("group", "pos", F.struct("hash", *[c for c in payload if c != "hash"]).alias("node")))
    subroots = tiers[-1].select(F.lit("all").alias("group"), F.col("group").alias("of"), F.col("root").alias("hash"))
    subroots = numbered(subroots, "group", "of")
    top = _tiers(subroots.select("group", "pos", F.struct("hash", "of").alias("node")))
    none = F.array().cast("array<struct<left:string,right:string>>")
    of_sources = _paths(top, top[-1].select("group", "root", none.alias("path")))
    of_sources = stored(of_sources.select(F.col("node.of").alias("group"), "path", F.col("node.hash").alias("subroot"), "root"), "subroots")
    found = _paths(tiers, of_sources)
    return found.select("node.doc_id", F.col("node.hash").alias("leaf"), "path", "subroot", "root", *[F.col("node")[c].alias(c) for c in payload if c not in ("doc_id", "hash")])
