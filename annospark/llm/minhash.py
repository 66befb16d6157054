"""Near-duplicate documents by MinHash with tensored banding, links verified on whole shingle sets.

Each set gets ``collections`` small collections of ``rows`` minhashes. A table key combines the values of
two collections, so ``c`` collections give ``c (c - 1) / 2`` tables for the price of ``c * rows`` minhashes.
Two sets of similarity s meet in a table if at least two collections agree, each with probability
s**rows: with 13 collections of 2 rows a pair at 0.8 is missed with probability 4e-5, one at 0.9 with 1e-9.
A set gets rows in the tables of those collections alone that agree with another set's, which one aggregation of
``c`` values a set tells, so sets that are near nothing have hardly any.

Rows of a table with one key form a bucket. No bucket is gathered and its pairs are not all formed:
every member is first compared with the bucket's hub, and in crowds with a few others. As long as members
of a bucket lie in different components, those outside the hub's component are compared with the
others of another component, so at the end every two members of a bucket have been compared or are
linked by others.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annospark.llm import words
from annospark.llm.graph import components
from annospark.llm.scratch import drop, scoped, small, stored

COLLECTIONS = 13
ROWS = 2
#: A bucket is a crowd if it has more open pairs, those of a member outside of its hub's component. In the first turns, PIVOTS members of a crowd are compared with all others.
CROWD, PIVOTS, TURNS = 1024, 12, 1
#: Words of 64 bits, a power of two, of the parities of a set's elements. An element that only one of
#: two sets has changes one bit, so sets whose parities differ in more bits than similar sets have such
#: elements are not compared.
PARITY = 8
#: Open pairs up to which they are formed at once after that.
AT_ONCE = 1 << 22

_rng = np.random.Generator(np.random.PCG64(77))
_SEEDS = _rng.integers(1, 2**63, (2, 256), dtype=np.uint64) * words.U(2) + words.U(1)


def _lists(rows: np.ndarray) -> pa.Array:
    bounds = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(rows.view(np.int64).ravel()))


def _signatures(width: int, n_collections: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_shingles", "d1", "d2", "minhash", "parity"]
        for batch in batches:
            doc = batch["doc_id"]
            for p in words.pieces(batch["text"]):
                n = p.hi - p.lo
                text, element = words.sets(*words.shingles(p, width))
                count = np.bincount(text, minlength=n)
                has = np.flatnonzero(count)
                first = (np.cumsum(count) - count)[has]
                digests = np.zeros((2, n), dtype=np.uint64)
                bands = np.zeros((n, n_collections), dtype=np.uint64)
                parity = np.zeros((n, PARITY), dtype=np.uint64)
                if len(has):
                    spread = words.mix(element + words.ODD[40])
                    digests[0, has] = np.add.reduceat(spread, first)
                    digests[1, has] = np.add.reduceat(words.mix(element ^ words.ODD[41]), first)
                    bit, of = words.U(1) << (spread & words.U(63)), spread >> words.U(6) & words.U(PARITY - 1)
                    for k in range(PARITY):
                        parity[has, k] = np.bitwise_xor.reduceat(np.where(of == k, bit, words.U(0)), first)
                    for c in range(n_collections):
                        band = np.zeros(len(has), dtype=np.uint64)
                        for r in range(rows):
                            value = (spread ^ _SEEDS[0, c * rows + r]) * _SEEDS[1, c * rows + r]
                            value ^= value >> words.U(32)
                            band = words.mix(band * words.ODD[42] + np.minimum.reduceat(value, first))
                        bands[has, c] = band
                columns = [doc.slice(p.lo, n), pa.array(count.astype(np.int64)), *(pa.array(x.view(np.int64)) for x in digests)]
                columns += [_lists(bands), _lists(parity)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _verified(width: int, similarity: tuple[int, int]):
    """Keep the rows whose texts have intersection / union >= similarity, on all their shingles."""

    def element_lists(texts: pa.Array) -> list[np.ndarray]:
        found = []
        for p in words.pieces(texts):
            text, element = words.sets(*words.shingles(p, width))
            found += np.split(element, np.cumsum(np.bincount(text, minlength=p.hi - p.lo))[:-1])
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        over, under = similarity
        last: tuple = (None, None, None)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                keep = []
                left_ids = part["a"].to_pylist()
                for left_id, left_text, right in zip(left_ids, part["text_a"], element_lists(part["text_b"]), strict=True):
                    if left_id != last[0] or not left_text.equals(last[1]):  # a doc_id may have several texts
                        last = (left_id, left_text, element_lists(pa.array([left_text.as_py()]))[0])
                    left = last[2]
                    if len(left) > len(right):
                        left, right = right, left
                    at = np.searchsorted(right, left)
                    at[at == len(right)] = 0
                    both = int((right[at] == left).sum()) if len(right) else 0
                    union = len(left) + len(right) - both
                    keep.append(under * both >= over * union and both > 0)
                part = part.select(["a", "b"]).filter(pa.array(keep))
                if part.num_rows:
                    yield part

    return run


def _links(pairs: DataFrame, texts: DataFrame, width: int, similarity: tuple[int, int]) -> DataFrame:
    """Those of ``pairs`` (a, b, each once) that are similar enough. Texts move by id, the text of
    the side that few pairs share; the other side's is joined where it lies."""
    ids = stored(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "ids")
    used = texts.join(small(ids), "id")
    half = pairs.join(used.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    both = half.join(used.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    both = both.select("a", "b", "text_a", "text_b")
    return both.mapInArrow(_verified(width, similarity), "a long, b long")


def _tables(classes: DataFrame, n_collections: int) -> DataFrame:
    """id, n, key: rows of ``classes`` in the tables. A row of a bucket of two and more agrees with another set in both
    collections, so collections whose value one set alone has are left out, and with them most rows."""
    bits = (n_collections - 1).bit_length()
    # The number of the collection is in the lower bits of its value; the upper ones that go for it tell a few values less apart.
    values = classes.select("id", F.posexplode("minhash").alias("k", "value"))
    values = values.select("id", F.shiftleft("value", bits).bitwiseOR(F.col("k").cast("long")).alias("value"))
    owners = values.groupBy("value").agg(F.min("id").alias("id"), F.max("id").alias("other"))
    own = F.expr(f"shiftleft(1L, cast(value & {(1 << bits) - 1} as int))")
    alone = owners.where("id = other").groupBy("id").agg(F.bit_or(own).alias("alone"))
    # A doc_id with several sets is not told which of them a value belongs to.
    shared = F.when(F.col("sets") > 1, F.lit(-1)).otherwise(F.bitwise_not(F.coalesce("alone", F.lit(0).cast("long"))).bitwiseAND(F.lit((1 << n_collections) - 1)))
    met = classes.groupBy("id").agg(F.count("*").alias("sets")).join(alone, "id", "left").select("id", shared.cast("long").alias("shared"))
    met = stored(met.where(F.bit_count("shared") > 1), "meeting")
    keys = [
        F.when(F.col("shared").bitwiseAND(F.lit(both := 1 << i | 1 << j)) == both, F.xxhash64(F.lit(k), F.col("minhash")[i], F.col("minhash")[j]))
        for k, (i, j) in enumerate(combinations(range(n_collections), 2))
    ]
    return classes.join(small(met), "id").select("id", F.col("n_shingles").alias("n"), F.explode(F.array_compact(F.array(*keys))).alias("key"))


@scoped
def near_duplicates(
    docs: DataFrame, width: int = 5, similarity: tuple[int, int] = (80, 100), n_collections: int = COLLECTIONS, rows: int = ROWS
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document.

    ``docs`` needs doc_id and text; other columns are not read. A document's set has its distinct runs
    of ``width`` words (A-Z lower-cased); with fewer words the whole sequence is the one element, and
    without words (null and empty texts) the set is empty and linked with nothing. Two documents are
    linked if intersection / union of their sets is at least ``similarity``. component_id is the
    least doc_id that links lead to, and kept marks the document that has it. Documents with equal
    sets are one node; rows with the same doc_id give a row each. A null doc_id gives a row with
    nulls that is kept. No documents give no rows.
    """
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    signed = stored(
        texts.mapInArrow(
            _signatures(width, n_collections, rows), "doc_id long, n_shingles long, d1 long, d2 long, minhash array<long>, parity array<long>"
        ),
        "signatures",
    )
    full = signed.where("n_shingles > 0 and doc_id is not null")
    classes = full.groupBy("d1", "d2", "n_shingles").agg(F.min("doc_id").alias("id"), F.first("minhash").alias("minhash"), F.first("parity").alias("parity"))
    classes = stored(classes, "classes")

    tables = _tables(classes, n_collections)
    buckets = tables.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    members = stored(tables.join(buckets, "key"), "members")
    # The hub of a bucket is its member that meets most others in all buckets, such as the text that
    # the others are edited copies of.
    scores = stored(members.groupBy("id").agg(F.sum("size").alias("score")), "scores")
    members = members.join(small(scores), "id")
    hubs = members.groupBy("key").agg(F.max(F.struct("score", (-F.col("id")).alias("low"), "n")).alias("h"))
    hubs = hubs.select("key", (-F.col("h.low")).alias("hub"), F.col("h.n").alias("m"))
    members = stored(members.join(hubs, "key"), "members")

    over, under = similarity
    fits = F.least("n", "m") * under >= F.greatest("n", "m") * over
    ends = F.least("hub", "id").alias("a"), F.greatest("hub", "id").alias("b")
    compared = members.where("id <> hub").where(fits).select(*ends).distinct()
    by_id = texts.withColumnRenamed("doc_id", "id")
    links = _links(stored(compared, "pairs"), by_id, width, similarity)
    found = stored(components(links), "components")

    # Buckets of three and more may still hold members that nothing has compared. Two members meet
    # in many buckets; their pair is formed in the first one of them alone.
    agree = F.filter(F.sequence(F.lit(0), F.lit(n_collections - 1)), lambda k: F.get("x.minhash", k) == F.get("y.minhash", k))
    i, j = F.get("agree", F.lit(0)), F.get("agree", F.lit(1))
    number = (F.expr(f"agree[0] * {2 * n_collections - 1} - agree[0] * agree[0]") / 2 + j - i - 1).cast("int")
    differ = sum((F.bit_count(F.get("x.parity", F.lit(k)).bitwiseXOR(F.get("y.parity", F.lit(k)))) for k in range(PARITY)), F.lit(0))
    can_be = differ * (under + over) <= (F.col("x.n") + F.col("y.n")) * (under - over)
    meets_first = F.xxhash64(number, F.get("minhash", i), F.get("minhash", j)) == F.col("key")

    open_rows, turn = members.where("size > 2").select("key", "hub", "id", "n", "score"), 0
    while True:
        placed = open_rows.join(small(found).withColumnsRenamed({"node": "id", "component": "c"}), "id", "left")
        placed = placed.withColumn("c", F.coalesce("c", "id"))
        state = placed.groupBy("key").agg(F.min("c").alias("low"), F.max("c").alias("high"), F.max(F.when(F.col("id") == F.col("hub"), F.col("c"))).alias("hub_c"), F.count("*").alias("size"))
        state = state.where("low < high").select("key", "hub_c", "size")
        placed = placed.join(state, "key").join(classes.select("id", "minhash", "parity"), "id")
        placed = stored(placed.withColumn("outside", F.col("c") != F.col("hub_c")), "open")
        many = stored(placed.groupBy("key", "size").agg(F.count_if("outside").alias("k")).withColumn("pairs", F.col("k") * F.col("size")), "crowds")
        if many.isEmpty():
            break
        crowded = many.where(F.col("pairs") > CROWD).limit(1).count() > 0 if turn < TURNS else False
        limit = CROWD if crowded else AT_ONCE
        rows = placed.join(small(many.select("key", (F.col("pairs") > limit).alias("crowd"))), "key")
        # In crowds a few members that meet many others are tried first.
        part = F.pmod(F.xxhash64("id"), F.lit(PIVOTS))
        pick = rows.where("crowd" if crowded else "crowd and outside")
        pivots = pick.groupBy("key", part.alias("part")).agg(F.max_by(F.struct("id", "n", "c", "minhash", "parity"), F.struct("score", "id")).alias("x"))
        every = rows.where(F.lit(not crowded) & ~F.col("crowd") & F.col("outside")).select("key", F.struct("id", "n", "c", "minhash", "parity").alias("x"))
        probe = stored(every.unionByName(pivots.select("key", "x")), "probes")
        pairs = (
            rows.select("key", "hub", F.struct("id", "n", "c", "minhash", "parity").alias("y"))
            .join(probe, "key")
            .where("x.c <> y.c and x.id <> y.id and x.id <> hub and y.id <> hub")
            .where((F.least("x.n", "y.n") * under >= F.greatest("x.n", "y.n") * over) & can_be & (F.size(agree) > 1))
            .select("key", F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"), agree.alias("agree"), F.col("x.minhash").alias("minhash"))
        )
        fresh = stored(pairs.where(meets_first).select("a", "b").distinct(), "pairs")
        links = _links(fresh, by_id, width, similarity)
        star = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
        found = stored(components(links.unionByName(star)), "components")
        # Buckets whose open pairs were all formed, and members that have met all others, are done.
        if not crowded:
            open_rows = rows.where("crowd").select("key", "hub", "id", "n", "score")
            open_rows = open_rows.join(probe.select("key", F.col("x.id").alias("id")), ["key", "id"], "left_anti")
        turn += 1

    of_class = classes.select("d1", "d2", "n_shingles", "id").join(found.withColumnRenamed("node", "id"), "id", "left")
    of_class = of_class.select("d1", "d2", "n_shingles", F.coalesce("component", "id").alias("component"))
    named = signed.select("doc_id", "n_shingles", "d1", "d2").join(stored(of_class, "classes"), ["d1", "d2", "n_shingles"], "left")
    component = F.when(F.col("doc_id").isNull(), None).otherwise(F.coalesce("component", "doc_id"))
    return named.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept")
    )
