import itertools
import random
import re
import zlib

import duckdb

from annospark.llm import entries, periodic

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words):
    """(start, length, period) of all runs: for each period, stretches that agree with themselves that far on."""
    found, n = [], len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            run = (i, j - i + q, q)
            if j > i and run[1] >= max(6, 4 * q) and not any(s <= i and i + run[1] <= s + k and q % p == 0 for s, k, p in found):
                found.append(run)
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def kept(words, runs):
    gone = {i for s, k, q in runs for i in range(s + q, s + k)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_small_alphabets(spark):
    rng = random.Random(3)
    docs = {}
    for k in range(400):
        words = rng.choices("aB" if k % 2 else "abcd", k=rng.randint(0, 60))
        for _ in range(rng.randint(0, 3)):  # planted repetitions of any period, in one another too
            unit = [*rng.choices(words, k=rng.randint(1, 9))] if words else ["x"]
            at = rng.randint(0, len(words))
            words[at:at] = unit * rng.randint(3, 6) + unit[: rng.randint(0, len(unit) - 1)]
        docs[k] = rng.choice([" ", "\n", " \t "]).join(words)
    docs |= {1000: None, 1001: "", 1002: " \n", 1003: "A a A a", 1004: "é " * 7, 1005: "x x " * 8, 1006: " ".join(map(str, range(3000))) + " y" * 20_000}
    df = spark.createDataFrame([(k, t, "clash", 3) for k, t in docs.items()], "doc_id long, text string, runs string, start int")
    rows = {r.doc_id: r for r in periodic.find(df).collect()}
    assert rows.keys() == docs.keys()
    for k, text in docs.items():
        words = WORD.findall(text or "")
        want = [(3000, 20_000, 1)] if k == 1006 else brute(words)
        assert [tuple(r) for r in rows[k].runs] == want, text
        assert rows[k].collapsed == kept(words, want) and rows[k].n_words == len(words)
    assert sum(len(r.runs) for r in rows.values()) > 300
    assert periodic.find(df.limit(0)).count() == 0
    twice = periodic.find(spark.createDataFrame([(None, "a " * 6), (None, "a " * 6), (1, "a"), (1, "b")], "doc_id long, text string"))
    assert sorted((r.doc_id, r.collapsed) for r in twice.where("doc_id = 1").collect()) == [(1, "a"), (1, "b")] and twice.where("doc_id is null").count() == 2


def test_query(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = {tuple(r) for r in entries.op11_periodic(spark, sf).collect()}
    assert len(rows) == len(docs)
    duckdb.sql(f"create or replace temp view documents as select * from '{sf}/documents.parquet'")
    assert rows == set(duckdb.sql(entries.ORACLES["op11_periodic"]).fetchall())
    planted = 0
    for row in rows:
        h, words = zlib.crc32(str(row[0]).encode()), WORD.findall(docs[row[0]] or "")
        since, period = periodic.cycle(h // 10, len(words)) if h % 10 == 0 and words else (0, 0)
        if period and len(words) - since >= max(6, 4 * period):
            planted += 1
            assert row[1] and len(words) - since <= row[3]
    assert planted > 5


def test_furthest_table():
    """Seeds of one lag on one stretch give one run; stretches of one lag apart give two."""
    import numpy as np

    words = [*"ababababab", "z", *"ababababab", *range(9)]
    ids = {w: i for i, w in enumerate(dict.fromkeys(words))}
    h = np.array([ids[w] + 7 for w in words], dtype=np.uint64)
    text = np.zeros(len(words), dtype=np.int64)
    assert periodic.runs_of(h, text, np.array([len(words)])) == [(0, 0, 10, 2), (0, 11, 10, 2)]
    assert list(itertools.islice(periodic._tiers(), 4)) == [(5, 1, 2), (6, 2, 4), (12, 4, 8), (24, 8, 16)]
