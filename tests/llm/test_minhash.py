import random
import re

import duckdb

from annospark.llm import entries, minhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(docs, width, over=80, under=100):
    sets = {}
    for k, text in docs.items():
        w = WORD.findall((text or "").translate(LOW))
        sets[k] = {tuple(w)} if 0 < len(w) < width else {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}
    root = {k: k for k in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys, where = sorted(docs), {}
    for k in keys:
        for s in sets[k]:
            where.setdefault(s, []).append(k)
    for k in keys:
        for o in {o for s in sets[k] for o in where[s] if o < k}:
            both = len(sets[k] & sets[o])
            if under * both >= over * (len(sets[k]) + len(sets[o]) - both):
                a, b = sorted((find(k), find(o)))
                root[b] = a
    return {(k, len(sets[k]), find(k), find(k) == k) for k in docs}


def test_against_brute_force(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = entries.op7_minhash(spark, sf).collect()
    assert {tuple(r) for r in rows} == brute(docs, 2) and len(rows) == len(docs)
    assert sum(not r.kept for r in rows) > 5
    duckdb.sql(f"create or replace temp view documents as select * from '{sf}/documents.parquet'")
    assert {tuple(r) for r in rows} == set(duckdb.sql(entries.ORACLES["op7_minhash"]).fetchall())


def test_crowded_buckets(spark):
    """Chains, equal sets, short texts, and buckets with many members that are not all similar."""
    rng = random.Random(2)
    docs = {0: None, 1: "", 2: " \n", 3: "one", 4: "ONE", 5: "one two", 6: "one  two"}
    base = [f"w{i}" for i in range(60)]
    for k in range(50):
        w = list(base)
        for _ in range(rng.randint(0, 9)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(40)}"
        docs[100 + k] = " ".join(w)
    for k in range(40):
        docs[300 + k] = " ".join(rng.choices("abc", k=rng.randint(1, 6)))
    df = spark.createDataFrame([(k, t, 1) for k, t in docs.items()], "doc_id long, text string, n_shingles int")
    minhash.CROWD, minhash.PIVOTS, minhash.TURNS, minhash.AT_ONCE = 10, 2, 1, 40
    try:
        rows = minhash.near_duplicates(df, width=2, n_collections=16).collect()
    finally:
        minhash.CROWD, minhash.PIVOTS, minhash.TURNS, minhash.AT_ONCE = 1024, 12, 1, 1 << 22
    assert {tuple(r) for r in rows} == brute(docs, 2)
    assert minhash.near_duplicates(df.limit(0)).count() == 0
    twice = minhash.near_duplicates(df.where("doc_id = 3").union(df.where("doc_id = 3")).union(df.limit(1).selectExpr("null", "text", "1")))
    assert sorted(map(tuple, twice.collect()), key=str) == [(3, 1, 3, True), (3, 1, 3, True), (None, 0, None, True)]


def shuffled(spark, run):
    """What ``run`` returns, and the rows that are shuffled by its stages."""
    store, total = spark._jsc.sc().statusStore(), 0
    first = spark.range(1).rdd.count() and max(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    found = run()
    spark._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    tracker = spark.sparkContext.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup(None) if j > first for s in tracker.getJobInfo(j).stageIds}
    for s in stages:
        total += store.lastStageAttempt(s).shuffleWriteRecords()
    return found, total


def test_unlike_sets_have_no_tables(spark):
    """Sets near nothing, copies with edits, and one doc_id with two texts of which one has a copy."""
    docs = {k: " ".join(f"{k}w{i}" for i in range(40)) for k in range(400)}
    docs |= {1000 + k: docs[k] + " end" for k in range(5)}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    rows, moved = shuffled(spark, lambda: minhash.near_duplicates(df).collect())
    assert {tuple(r) for r in rows} == brute(docs, 5)
    assert moved < 20_000  # 78 rows of tables for each set were over 31,000 alone
    twice = [(8, docs[8]), (8, docs[9]), (20, docs[8] + " end"), (21, docs[9] + " end")]
    found = minhash.near_duplicates(spark.createDataFrame(twice, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.component_id) for r in found} == {(8, 8), (20, 8), (21, 8)}
