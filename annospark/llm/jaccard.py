"""Exact set-similarity join of documents on word shingles: a size-aware heavy-light join.

Sets that cannot be similar to another are told first: whatever order the shingles have, a set that has a partner
shares with some other set at least ``l`` of the first ``spare + l`` of them, where spare is the number that a similar
set may lack. In order of their digests, each task picks these for itself, and one aggregation finds those of one set
alone. The sets that remain are ordered by how rare their shingles are among them, those of one set first. Of two similar
sets, the first spare + 1 of each then have one in common, and the first spare + 2 have two. What the smaller one may lack
is less, as it is similar to one that is no smaller: of its first, those up to that many are indexed, and the rest only probe for smaller sets.

Small (light) sets enumerate the subsets of two of their spare + 2, so that they meet under a key only if they share
both; large (heavy) sets scan the inverted lists of their spare + 1, in which light sets that are large enough to be
similar are listed too. The boundary between small and large is the size with the least cost: subsets enumerated by
those below, list entries scanned by those above, a few of each list. So a light set has few subsets however many copies there are of it.

Sets under one key, or in one list, form a bucket, if one of them is indexed there. Not all its pairs are formed: in turns, more each time, members of a
bucket are compared with all others, and are done with; a bucket is done when its members are linked, by whatever
links, or have all been compared. So no link between two components is lost, and the links of one are not all formed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annospark.llm import words
from annospark.llm.graph import components
from annospark.llm.places import joined
from annospark.llm.scratch import drop, scoped, small, stored

#: Words of 64 bits of the parities of a set's elements: an element that one of two sets has alone changes one bit.
PARITY = 8
#: Elements of the first filter beyond spare: one of so many.
EXTRA = 16
#: Bits of the digest of a set in the first filter. Sets that share it with another set pass.
SHORT = 40
#: Bits of an element (``words.sets``). Above them goes its rank, so many for each octave of the sets that have it.
BITS, RANKS = 54, 16
#: Entries of a list that count as scanned by a set, at most. Buckets are compared in turns, most of whose members one
#: other links, so a set does not meet all of a long list; counting all would enumerate ever larger sets as lists grow.
SCANNED = 4
#: Members of a bucket that are compared with all others in the first turn, how many times more in each next one, and
#: pairs left in all buckets up to which they are compared at once, by their parities where they are joined.
FIRST, MORE, AT_ONCE = 1, 16, 1 << 25
#: Links that one task joins to components.
FEW = 50_000
#: Pairs of one set that one task verifies with it.
TOGETHER = 2_000


def spare(n: Column, similarity: tuple[int, int]) -> Column:
    """Elements of a set of n that a similar one may lack, at most."""
    over, under = similarity
    return F.floor(n * (under - over) / under + 1e-9).cast("long")


def spare_smaller(n: Column, similarity: tuple[int, int]) -> Column:
    """Elements of a set of n that a similar one may lack, at most, if it has n or more itself."""
    over, under = similarity
    return F.floor(n * (under - over) / (under + over) + 1e-9).cast("long")


def _signed(width: int, similarity: tuple[int, int]):
    """(doc_id, n_shingles, d1, d2, parity, first): size, digests, parities and first elements of the set of each text."""
    over, under = similarity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in words.pieces(batch["text"]):
                n = p.hi - p.lo
                text, element = words.sets(*words.shingles(p, width))
                count = np.bincount(text, minlength=n)
                has = np.flatnonzero(count)
                begin = np.cumsum(count) - count
                digests, parity = np.zeros((2, n), dtype=np.uint64), np.zeros((n, PARITY), dtype=np.uint64)
                if len(has):
                    spread = words.mix(element + words.ODD[40])
                    digests[0, has] = np.add.reduceat(spread, begin[has])
                    digests[1, has] = np.add.reduceat(words.mix(element ^ words.ODD[41]), begin[has])
                    bit, of = words.U(1) << (spread & words.U(63)), spread >> words.U(6) & words.U(PARITY - 1)
                    for k in range(PARITY):
                        parity[has, k] = np.bitwise_xor.reduceat(np.where(of == k, bit, words.U(0)), begin[has])
                wanted = np.where(count > 1, count * (under - over) // under + np.maximum(1, count // EXTRA), 0)
                first = element[np.arange(len(element)) - begin[text] < wanted[text]]
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(wanted)], pa.int32()), pa.array(first.view(np.int64)))
                bits = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * PARITY, pa.int32()), pa.array(parity.view(np.int64).ravel()))
                columns = [batch["doc_id"].slice(p.lo, n), pa.array(count.astype(np.int64)), *(pa.array(d.view(np.int64)) for d in digests), bits, lists]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "d1", "d2", "parity", "first"])

    return run


def _elements(width: int):
    """(id, n, elements) of the set of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in words.pieces(batch["text"]):
                n = p.hi - p.lo
                text, element = words.sets(*words.shingles(p, width))
                count = np.bincount(text, minlength=n)
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(count)], pa.int32()), pa.array(element.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(p.lo, n), pa.array(count.astype(np.int64)), lists], names=["id", "n", "elements"])

    return run


def _candidates(signed: DataFrame, classes: DataFrame) -> DataFrame:
    """id, n, parity of those of ``classes``, the different sets, that may have a similar one: enough of their first
    elements are in another set too."""
    full = signed.where("n_shingles > 1 and doc_id is not null")
    short = F.col("d1").bitwiseAND(F.lit((1 << SHORT) - 1)).alias("d")
    owners = full.select(short, F.explode("first").alias("e")).groupBy("e").agg(F.min("d").alias("a"), F.max("d").alias("b"))
    alone = owners.where("a = b").groupBy(F.col("a").alias("d")).agg(F.count("*").alias("alone"))
    twins = stored(classes.groupBy(short).agg(F.count("*").alias("k")).where("k > 1").select("d", F.lit(True).alias("twin")), "twins")
    shared = F.col("n_first") - F.coalesce("alone", F.lit(0))
    every = classes.where("n_shingles > 1 and id is not null").withColumn("d", short).join(alone, "d", "left").join(small(twins), "d", "left")
    return every.where(F.col("twin").isNotNull() | (shared >= F.greatest(F.lit(1), F.floor(F.col("n_shingles") / EXTRA)))).select("id", F.col("n_shingles").alias("n"), "parity")


def _prefixes(sets: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """id, n, prefix (k, e) of each set: its shared elements among the first spare + 2 of all, rarest first, by the rank of the
    number k of sets that have them; indexed: how many of them are among the first spare_smaller + 2."""
    # Rows of an element are counted where they meet, so they move once; an element has a row for each set at most.
    postings = sets.select("id", F.explode("elements").alias("e")).withColumn("k", F.count("*").over(Window.partitionBy("e")))
    # One number holds rank and element, so that a list of them is sorted, and moved, as it is.
    rank = F.least(F.lit(511), F.floor(RANKS * F.log2("k"))).cast("long")
    at = F.shiftleft(rank, BITS).bitwiseOR(F.col("e"))
    lists = postings.where("k > 1").groupBy("id").agg(F.sort_array(F.collect_list(at)).alias("shared"))
    lists = lists.join(small(stored(sets.select("id", "n"), "sizes")), "id")
    alone = F.col("n") - F.size("shared")
    length, indexed = ((f(F.col("n"), similarity) + 2 - alone).cast("int") for f in (spare, spare_smaller))
    first = F.slice("shared", F.lit(1), F.greatest(F.lit(0), length))
    prefix = F.transform(first, lambda x: F.struct(F.pow(F.lit(2.0), F.shiftright(x, BITS) / RANKS).cast("long").alias("k"), x.bitwiseAND(F.lit((1 << BITS) - 1)).alias("e")))
    return stored(lists.select("id", "n", prefix.alias("prefix"), indexed.alias("indexed")).where("size(prefix) > 1"), "prefixes")


def boundary(prefixes: DataFrame, similarity: tuple[int, int]) -> int:
    """The size from which on sets are heavy. Costs are summed by size, in quarters of octaves: a row for each of
    these, of which there are as many as the logarithm of the longest text's words."""
    over, under = similarity
    step = F.floor(4 * F.log2("n"))
    pairs = F.size("prefix") * (F.size("prefix") - 1) / 2
    scanned = F.aggregate(F.slice("prefix", F.lit(1), F.size("prefix") - 1), F.lit(0).cast("long"), lambda s, x: s + F.least(x["k"], F.lit(SCANNED)))
    rows = prefixes.groupBy(step.alias("step")).agg(F.min("n").alias("n"), F.max("n").alias("most"), F.sum(pairs).alias("pairs"), F.sum(scanned).alias("scanned"), F.sum(F.size("prefix")).alias("listed")).orderBy("step").collect()
    cuts = [r["n"] for r in rows] + [r["most"] + 1 for r in rows[-1:]]

    def cost(x: int) -> float:
        light, heavy = [r for r in rows if r["n"] < x], [r for r in rows if r["n"] >= x]
        return sum(r["pairs"] for r in light) + sum(r["scanned"] for r in heavy) + sum(r["listed"] for r in light if heavy and under * r["most"] >= over * x)

    return min(cuts, key=cost) if cuts else 0


def _buckets(prefixes: DataFrame, x: int, similarity: tuple[int, int]) -> DataFrame:
    """key, id, n, role, score of the members of buckets of two and more. role: 0 under a subset and 1 heavy in a list, both
    indexed; 2 light in a list, where it is met by heavy sets alone; 3 and 4 as 0 and 1, but not indexed, where it is met by
    smaller sets alone that are. Of buckets with the same members one is kept. A set has a greater score the fewer
    of its elements are its own."""
    over, under = similarity
    p, c = F.col("prefix"), F.size("prefix")
    place = lambda i: F.when(i < F.col("indexed"), 0).otherwise(3)
    row = lambda role, *e: F.struct(F.xxhash64(*e).alias("key"), role.cast("int").alias("role"))
    subsets = F.flatten(F.transform(F.sequence(F.lit(0), c - 2), lambda i: F.transform(F.sequence(i + 1, c - 1), lambda j: row(place(j), F.get(p, i)["e"], F.get(p, j)["e"]))))
    singles = F.transform(F.sequence(F.lit(0), c - 2), lambda i: row(F.when(F.col("n") < x, F.when(place(i + 1) == 0, 2).otherwise(5)).otherwise(place(i + 1) + 1), F.get(p, i)["e"]))
    light = F.col("n") < x
    by_pair = prefixes.where(light).select(F.inline(subsets), "id", "n", c.alias("score"))
    # Light sets are smaller than those that scan their lists, so the ones that are not indexed are not listed.
    listed = prefixes.where(~light | (F.col("n") * under >= x * over)).select(F.inline(singles), "id", "n", c.alias("score")).where("role < 5")
    rows = by_pair.unionByName(listed)
    marks = [F.bit_xor(F.xxhash64("id", "role")).alias("m1"), F.bit_xor(F.xxhash64("role", "id", F.lit(1))).alias("m2")]
    sizes = [F.min(F.when(F.col("role") < 3, F.col("n"))).alias("least"), F.count_if(F.col("role") < 3).alias("indexed"), F.max("n").alias("most")]
    buckets = rows.groupBy("key").agg(F.count("*").alias("k"), F.count_if(F.col("role") != 2).alias("able"), *sizes, *marks)
    buckets = buckets.where("k > 1 and able > 0 and (indexed > 1 or most > least)")
    kept = stored(buckets.groupBy("m1", "m2", "k").agg(F.min("key").alias("key"), F.first("least").alias("least")).select("key", "k", "least"), "buckets")
    return stored(joined(rows, kept, ["key"]).where("role < 3 or n > least").drop("least"), "members")


def _beside(pairs: DataFrame, sets: DataFrame, side: str, other: str) -> DataFrame:
    """``pairs`` with n_<side> and set_<side>. A set that many pairs have is copied, and these are dealt out among the copies."""
    ids = pairs.select(F.col(side).alias("id")).distinct()
    needed, dealt = sets.join(small(stored(ids, "ids")), "id", "left_semi").withColumn("copies", F.lit(1)), pairs.withColumn("_copy", F.lit(1))
    if pairs.count() > TOGETHER:
        often = pairs.groupBy(F.col(side).alias("id")).agg(F.count("*").alias("_k")).where(F.col("_k") > TOGETHER)
        hot = stored(often.select("id", F.ceil(F.col("_k") / TOGETHER).cast("int").alias("copies")), "hot")
        needed = needed.drop("copies").join(small(hot), "id", "left").withColumn("copies", F.coalesce("copies", F.lit(1)))
        dealt = pairs.join(small(hot).withColumnRenamed("id", side), side, "left")
        dealt = dealt.withColumn("_copy", F.pmod(F.xxhash64(other), F.coalesce("copies", F.lit(1))).cast("int") + 1).drop("copies")
    copies = needed.select(F.col("id").alias(side), F.col("n").alias(f"n_{side}"), F.col("elements").alias(f"set_{side}"), F.explode(F.sequence(F.lit(1), "copies")).alias("_copy"))
    return dealt.join(copies, [side, "_copy"]).drop("_copy")


def _links(pairs: DataFrame, sets: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Those of ``pairs`` (a, b) whose whole sets are similar."""
    over, under = similarity
    both = _beside(_beside(pairs, sets, "b", "a"), sets, "a", "b")
    common = F.size(F.array_intersect("set_a", "set_b"))
    return both.where(common * (under + over) >= over * (F.col("n_a") + F.col("n_b"))).select("a", "b")


def _resolved(members: DataFrame, parities: DataFrame, sets: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """node, component of the sets that are linked with another of some bucket, directly or not."""
    over, under = similarity
    open_, turn, found = members, 0, None
    differ = sum((F.bit_count(F.get("x.parity", F.lit(k)).bitwiseXOR(F.get("y.parity", F.lit(k)))) for k in range(PARITY)), F.lit(0))
    can_be = F.coalesce(differ * (under + over) <= (F.col("x.n") + F.col("y.n")) * (under - over), F.lit(True))
    fits = (F.least("x.n", "y.n") * under >= F.greatest("x.n", "y.n") * over) & ((F.col("x.role") != 2) | (F.col("y.role") != 2))
    # Of two sets the smaller one is indexed, or both are.
    fits = fits & ((F.col("x.role") < 3) | (F.col("x.n") > F.col("y.n"))) & ((F.col("y.role") < 3) | (F.col("y.n") > F.col("x.n")))
    while True:
        placed = open_.withColumn("c", F.col("id"))
        if found is not None:
            placed = open_.join(small(found).select(F.col("node").alias("id"), "component"), "id", "left").withColumn("c", F.coalesce("component", "id")).drop("component")
        # The main component of a bucket is that of the member with the best score; any would do.
        state = placed.groupBy("key").agg(F.max_by("c", F.struct("score", "id")).alias("main"), F.min("c").alias("low"), F.max("c").alias("high"), F.count("*").alias("k"))
        state = stored(state.where("low < high").select("key", "main", "k", F.col("k").alias("size")), "state")
        if state.isEmpty():
            break
        rows = joined(placed, state, ["key"])
        if turn:
            # From the second turn on, sets whose parities differ too much aren't compared.
            rows = rows.join(small(parities, 100_000), "id")
        rows = stored(rows, "open")
        item = F.struct(*[c for c in ("id", "n", "c", "role", "parity") if c in rows.columns])
        outside = rows.where("c <> main")
        last = turn > 0 and outside.agg(F.sum("size").alias("n")).first().n <= AT_ONCE
        slot = F.col("id") if last else F.pmod(F.xxhash64("id"), F.lit(FIRST * MORE**turn))
        # Members outside of the main component are done with in turn; once they all are, one component is left.
        pick = outside if turn else rows
        picked = stored(pick.groupBy("key", slot.alias("slot")).agg(F.max_by(item, F.struct(F.col("role") < 2, "score", "id")).alias("x"), F.count("*").alias("k")), "picked")
        tried = joined(rows.select("key", item.alias("y")), picked.select("key", "x", "k"), ["key"]).where("x.c <> y.c").where(fits)
        pairs = stored((tried.where(can_be) if turn else tried).select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct(), "pairs")
        links = _links(pairs, sets, similarity)
        if found is not None:
            links = links.unionByName(found.select(F.col("node").alias("a"), F.col("component").alias("b")))
        found = stored(components(links, FEW), "components")
        if last:
            break
        rest = rows.drop("c", "main", "size", "parity").join(picked.select("key", F.col("x.id").alias("id")), ["key", "id"], "left_anti")
        drop(open_, pairs)
        open_, turn = stored(rest, "open"), turn + 1
    return found if found is not None else components(members.select(F.col("id").alias("a"), F.col("id").alias("b")))


@scoped
def near_duplicates(docs: DataFrame, width: int = 5, similarity: tuple[int, int] = (80, 100)) -> DataFrame:
    """doc_id, n_shingles, component_id of every document.

    ``docs`` needs doc_id and text; other columns are not read. A document's set has its distinct runs of ``width`` words
    (A-Z lower-cased); with fewer words the whole sequence is the one element, and without words (null and empty texts)
    the set is empty and linked with nothing. Two documents are linked if intersection / union of their sets is at least
    ``similarity``, over a half; component_id is the least doc_id that links lead to. Equal sets are one node, whose rows give
    a row each; rows of one doc_id are judged by their own texts. A null doc_id gives a row with a null component. No
    documents give no rows.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    shape = "doc_id long, n_shingles long, d1 long, d2 long, parity array<long>, first array<long>"
    signed = stored(texts.mapInArrow(_signed(width, similarity), shape), "signed")
    of_set = F.min("doc_id").alias("id"), F.first("parity").alias("parity"), F.first(F.size("first")).alias("n_first")
    own = stored(signed.where("n_shingles > 0").groupBy("d1", "d2", "n_shingles").agg(*of_set), "classes")
    able = stored(_candidates(signed, own), "candidates")
    rows = stored(signed.select("doc_id", "n_shingles", "d1", "d2"), "rows")
    drop(signed)
    chosen = texts.join(small(able.select(F.col("id").alias("doc_id")).distinct()), "doc_id", "left_semi")
    sets = stored(chosen.mapInArrow(_elements(width), "id long, n long, elements array<long>"), "sets")
    if sets.count() > able.count():
        sets = stored(sets.distinct(), "sets")
    prefixes = _prefixes(sets, similarity)
    members = _buckets(prefixes, boundary(prefixes, similarity), similarity)
    # A doc_id with several texts has no parities of its own.
    parities = stored(able.groupBy("id").agg(F.when(F.count("*") == 1, F.first("parity")).alias("parity")), "parities")
    found = _resolved(members, parities, sets, similarity)
    of_class = own.drop("parity", "n_first").join(found.withColumnRenamed("node", "id"), "id", "left").select("d1", "d2", "n_shingles", F.coalesce("component", "id").alias("component"))
    named = rows.join(stored(of_class, "classes"), ["d1", "d2", "n_shingles"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return named.select("doc_id", "n_shingles", component.alias("component_id"))
