import random
import re
from collections import Counter

import pytest

from annospark.llm import decontaminate, entries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(w):
    return Counter(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1)))


def brute(docs, items):
    found = {}
    for item, text in items.items():
        want = WORD.findall((text or "").translate(LOW))
        if not want:
            continue
        own, near = shingles(want), set(want)
        for doc, body in docs.items():
            spans = [m.span() for m in WORD.finditer(body or "")]
            w = [body[a:b].translate(LOW) for a, b in spans]
            if len(near & set(w)) * 2 < len(near):
                continue
            for i in range(len(w) - len(want) + 1):
                got = shingles(w[i : i + len(want)])
                both = sum((got & own).values())
                union = sum((got | own).values())
                if 5 * both >= 4 * union:
                    s, k = both / union, found.get((doc, item))
                    better = k is None or s > k[0]
                    found[doc, item] = (s, spans[i][0], spans[i + len(want) - 1][1], 1) if k is None else (
                        *((s, spans[i][0], spans[i + len(want) - 1][1]) if better else k[:3]), k[3] + 1)
    return {(*k, *v) for k, v in found.items()}


def test_against_brute_force(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    rows = {tuple(r) for r in entries.op1_decontaminate(spark, sf).collect()}
    assert rows == brute(docs, items) and rows


def test_edited_and_odd_rows(spark):
    rng = random.Random(6)
    items = {k: " ".join(f"b{rng.randrange(400)}" for _ in range(rng.choice([1, 3, 5, 20, 40, 41]))) for k in range(30)}
    items |= {50: None, 51: "", 52: items[3], 53: "z z z z z z z z z z z z"}
    docs = {0: None, 1: "", 2: "z " * 40, 3: "q"}
    for k in range(120):
        w = [f"n{rng.randrange(900)}" for _ in range(rng.randint(5, 60))]
        own = items[rng.randrange(30)].upper().split()
        for _ in range(rng.randint(0, 1)):
            own[rng.randrange(len(own))] = "new"
        docs[10 + k] = " ".join(w) + "\t" + "  ".join(own) + " é " + " ".join(w[:3])
    df = spark.createDataFrame([(k, t, "x") for k, t in docs.items()], "doc_id long, text string, length string")
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    got = {tuple(r) for r in decontaminate.matches(df, bench).collect()}
    assert got == brute(docs, items)
    left = {r.doc_id for r in decontaminate.clean(df, bench).collect()}
    assert left == docs.keys() - {x[0] for x in got}
    assert decontaminate.matches(df.limit(0), bench).count() == 0
    assert decontaminate.matches(df, bench.limit(0)).count() == 0


def test_texts_shorter_than_an_item(spark):
    w = [f"w{k}" for k in range(59)]
    items = [(1, " ".join(w)), (2, " ".join(f"v{k}" for k in range(14)))]
    docs = {1: " é " + " ".join(w[:54]), 2: " ".join(w[11:]), 3: " ".join(w[12:]), 4: " ".join(f"v{k}" for k in range(12)), 5: "v0 v1 v2 v3", 6: " ".join(w)}
    docs[1] = docs[1].replace(" é ", " ")
    rows = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = sorted(tuple(r) for r in decontaminate.matches(rows, spark.createDataFrame(items, "item_id long, text string")).collect())
    end = len(docs[1])
    assert got == [(1, 1, 50 / 55, 1, end, 1), (2, 1, 44 / 55, 0, len(docs[2]), 1), (4, 2, 0.8, 0, len(docs[4]), 1), (6, 1, 1.0, 0, len(docs[6]), 1)]


def test_repeated_null_and_long_rows(spark):
    item = " ".join(f"w{k}" for k in range(30))
    long = " ".join(f"v{k % 7001}" for k in range(20_000))
    docs = [(1, item), (1, "x " + item), (1, None), (None, item), (2, long + " end"), (3, "other words " * 50_000)]
    items = [(1, item), (1, item), (None, item), (7, long), (8, "x")]
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    found = sorted((tuple(r)[:3] + (r.n_windows,) for r in decontaminate.matches(rows, spark.createDataFrame(items, "item_id long, text string")).collect()), key=str)
    assert {x[:2] for x in found} >= {(1, 1), (1, None), (None, 1), (2, 7)} and {x[0] for x in found} == {None, 1, 2}
    assert decontaminate.clean(rows, spark.createDataFrame(items, "item_id long, text string")).count() == 2


@pytest.mark.parametrize("length", [12, 40, 150, 600])
def test_recall_at_the_least_similarity(spark, length):
    """Windows at 0.8 to 0.85, for items of several lengths: the fingerprints of nearly all are within the radius."""
    rng = random.Random(length)
    docs, items = {}, {}
    while len(docs) < 120:
        own = [f"w{rng.randrange(10**6)}" for _ in range(length)]
        new = list(own)
        while True:
            at = rng.randrange(length)
            changed = [*new[:at], f"n{rng.randrange(10**6)}", *new[at + 1 :]]
            both = sum((shingles(changed) & shingles(own)).values())
            if 5 * both < 4 * (2 * (length - 4) - both):
                break
            new = changed
        if new != own or length < 30:
            docs[len(docs)], items[len(items)] = " ".join(new), " ".join(own)
    found = decontaminate.matches(spark.createDataFrame(list(docs.items()), "doc_id long, text string"), spark.createDataFrame(list(items.items()), "item_id long, text string"))
    assert found.where("doc_id = item_id").count() >= 0.98 * len(docs)
