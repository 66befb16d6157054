import random

import duckdb
from pyspark.sql import functions as F

from annospark.llm import entries, jaccard
from tests.llm.test_minhash import brute


def want(docs, width=5):
    return {row[:3] for row in brute(docs, width)}


def test_against_brute_force(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = entries.op12_jaccard(spark, sf).collect()
    assert {tuple(r) for r in rows} == want(docs) and len(rows) == len(docs)
    assert sum(r.component_id != r.doc_id for r in rows) > 3
    duckdb.sql(f"create or replace temp view documents as select * from '{sf}/documents.parquet'")
    assert {tuple(r) for r in rows} == set(duckdb.sql(entries.ORACLES["op12_jaccard"]).fetchall())


def corpus():
    """Edited copies of texts of several sizes, chains, equal sets, a passage that many share, short texts."""
    rng = random.Random(8)
    docs = {0: None, 1: "", 2: " \n", 3: "one", 4: "ONE", 5: "one two", 6: "one  two"}
    passage = [f"p{i}" for i in range(30)]
    for size in (9, 14, 25, 60, 300):
        for group in range(2):
            base = [f"{size}g{group}w{i}" for i in range(size)]
            for k in range(25):
                own = list(base)
                for _ in range(rng.randint(0, 2 + size // 25)):
                    own[rng.randrange(size) if k % 3 else -1] = f"x{rng.randrange(30)}"
                docs[len(docs) + 100] = " ".join(own)
    for k in range(40):  # each is like the next one alone
        docs[1000 + k] = " ".join(f"c{i}" for i in range(3 * k, 3 * k + 60))
    for k in range(60):
        docs[2000 + k] = " ".join([f"q{k}w{i}" for i in range(k)] + passage)
    return docs


def test_sizes_and_boundaries(spark):
    docs = corpus()
    df = spark.createDataFrame([(k, t, 1, "c") for k, t in docs.items()], "doc_id long, text string, n_shingles int, key string")
    expected, chosen = want(docs), jaccard.boundary
    assert len({c for _, _, c in expected}) < len(docs) - 100
    assert {tuple(r) for r in jaccard.near_duplicates(df).collect()} == expected
    try:  # all heavy, all light, and a boundary within a group of similar sets
        for x in (0, 10**6, 55):
            jaccard.boundary = lambda *_, x=x: x
            assert {tuple(r) for r in jaccard.near_duplicates(df).collect()} == expected
    finally:
        jaccard.boundary = chosen


def test_boundary_is_the_cheapest(spark):
    rows = [(1, 20, 3, 2), (2, 20, 3, 2), (3, 400, 60, 2), (4, 400, 60, 2)]
    prefixes = spark.createDataFrame(rows, "id long, n long, c int, k long")
    prefixes = prefixes.select("id", "n", F.array_repeat(F.struct("k", F.lit(7).cast("long").alias("e")), F.col("c")).alias("prefix"))
    # 3 subsets against 4 entries for each small set, 1,770 against 118 for each large one.
    assert jaccard.boundary(prefixes, (80, 100)) == 400
    assert jaccard.boundary(prefixes.limit(0), (80, 100)) == 0


def test_boundary_stays_with_longer_lists(spark):
    """Large sets in large groups of copies scan lists too: their subsets would be the square of their size."""
    rows = [(1, 20, 3), (2, 20, 3), (3, 400, 60), (4, 400, 60)]
    for k in (2, 1000, 100_000):
        prefixes = spark.createDataFrame([(*r, k) for r in rows], "id long, n long, c int, k long")
        prefixes = prefixes.select("id", "n", F.array_repeat(F.struct("k", F.lit(7).cast("long").alias("e")), F.col("c")).alias("prefix"))
        assert jaccard.boundary(prefixes, (80, 100)) == 400


def test_hot_sets_are_copied(spark):
    docs = {k: t for k, t in corpus().items() if k < 700}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    jaccard.TOGETHER = 3
    try:
        assert {tuple(r) for r in jaccard.near_duplicates(df).collect()} == want(docs)
    finally:
        jaccard.TOGETHER = 2_000


def test_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(None, text), (7, text), (7, text), (9, text + " end"), (8, "a b c d e f"), (8, "other words than these ones are"), (None, None)]
    found = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, found.collect()), key=str) == [(7, 36, 7), (7, 36, 7), (8, 2, 8), (8, 2, 8), (9, 37, 7), (None, 0, None), (None, 36, None)]
    assert jaccard.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_smaller_sets_are_indexed(spark):
    """Pairs at the least similarity, one set within the other, and sets that share their digest in the first filter."""
    docs = {}
    for k, n in enumerate((20, 45, 100, 250)):  # n shingles, and 80 of a hundred of them
        for text in ([f"{k}w{i}" for i in range(n + 4)], [f"{k}w{i}" for i in range(n * 4 // 5 + 4)], [f"{k}w{i}" for i in range(2, n * 4 // 5 + 5)]):
            docs[len(docs)] = " ".join(text)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    expected, chosen, short = want(docs), jaccard.boundary, jaccard.SHORT
    assert len({c for _, _, c in expected}) == 4
    try:
        for x in (0, 10**6, 90):
            jaccard.boundary = lambda *_, x=x: x
            assert {tuple(r) for r in jaccard.near_duplicates(df).collect()} == expected
        jaccard.SHORT = 0
        assert {tuple(r) for r in jaccard.near_duplicates(df).collect()} == expected
    finally:
        jaccard.boundary, jaccard.SHORT = chosen, short


def test_rows_of_buckets(spark, monkeypatch):
    """Copies with edits: members of buckets, which all later joins read."""
    rng, docs, rows = random.Random(3), {}, []
    for group in range(12):
        base = [f"g{group}w{i}" for i in range(60 + 10 * group)]
        for _ in range(30):
            own = list(base)
            own[rng.randrange(len(own))] = f"x{rng.randrange(1000)}"
            docs[len(docs)] = " ".join(own)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    buckets = jaccard._buckets

    def counted(*args):
        members = buckets(*args)
        rows.append(members.count())
        return members

    monkeypatch.setattr(jaccard, "_buckets", counted)
    assert {tuple(r) for r in jaccard.near_duplicates(df).collect()} == want(docs)
    assert 0 < rows[0] < 18_000  # 11,501; 28,956 with all of the first elements indexed
