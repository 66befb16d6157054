import random
import re

import duckdb
import pytest

from annospark.llm import entries, lines, scratch

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(docs):
    found, seen, where, known = {}, [], {}, set()
    for doc in sorted(docs):
        for i, line in enumerate((docs[doc] or "").split("\n")):
            s = frozenset(WORD.findall(line.translate(LOW)))
            if not s:
                continue
            gone = s in known
            if not gone:
                for o in {o for w in s for o in where.get(w, ())}:
                    both = len(s & seen[o])
                    gone = gone or 5 * both >= 4 * (len(s) + len(seen[o]) - both)
                for w in s:
                    where.setdefault(w, []).append(len(seen))
                seen.append(s)
                known.add(s)
            if gone:
                found.setdefault(doc, []).append(i)
    return found


def test_against_brute_force(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = {r.doc_id: r for r in entries.op2_lines(spark, sf).collect()}
    assert rows.keys() == docs.keys()
    assert {k: list(map(int, r.removed.split(","))) for k, r in rows.items() if r.removed} == brute(docs)
    assert all(r.n_lines == len(docs[k].split("\n")) and r.n_removed == len(r.removed.split(",") if r.removed else ()) for k, r in rows.items())
    duckdb.sql(f"create or replace temp view documents as select * from '{sf}/documents.parquet'")
    assert {tuple(r) for r in rows.values()} == set(duckdb.sql(entries.ORACLES["op2_lines"]).fetchall())


def odd_docs():
    rng = random.Random(4)
    docs = {0: None, 1: "", 2: "\n \n", 3: "a\nb\nA\n", 4: "b\r\na", 9: "x " * 9000}
    base = [f"w{i}" for i in range(12)]
    for k in range(150):
        out = []
        for _ in range(3):
            w = list(base)
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(12)] = f"x{rng.randrange(30)}"
            out.append(" ".join(rng.sample(w, len(w))))
        out.append(" ".join(rng.choices("abcdefgh", k=rng.randint(1, 7))))
        out.append(" ".join(f"v{rng.choice((i, i + 200))}" if rng.random() < 0.1 else f"v{i}" for i in range(rng.randint(95, 150))))
        docs[10 + k] = "\n".join(out)
    return docs


@pytest.mark.parametrize(("window", "common"), [(1024, 1024), (2, 1024), (40, 3), (1, 3)])
def test_crowds_and_odd_rows(spark, monkeypatch, window, common):
    """Whatever is compared in passing, and whichever words are common, the result is that of brute force."""
    for name, value in {"COMMON": common, "GROUP": 16, "CHUNK_ROWS": 100}.items():
        monkeypatch.setattr(lines, name, value)
    docs = odd_docs()
    df = spark.createDataFrame([(k, t, "c") for k, t in docs.items()], "doc_id long, text string, line string")
    want = brute(docs)
    found = {}
    for r in lines.similar_lines(df, window).collect():
        found.setdefault(r.doc_id, []).append(r.line)
    assert {k: sorted(v) for k, v in found.items()} == want


def test_dedup_keeps_rows_and_columns(spark):
    docs = odd_docs()
    df = spark.createDataFrame([(k, t, "c", "d") for k, t in docs.items()], "doc_id long, text string, line string, part string")
    want = brute(docs)
    rows = lines.dedup(df).collect()
    assert len(rows) == len(docs) and rows[0].__fields__ == df.columns
    for r in rows:
        kept = None if docs[r.doc_id] is None else [x for i, x in enumerate(docs[r.doc_id].split("\n")) if i not in want.get(r.doc_id, ())]
        assert r.text == (None if kept is None else "\n".join(kept)) and r.line == "c"
    assert lines.removed_lines(df.limit(0)).count() == 0 and lines.dedup(df.limit(0)).count() == 0


def test_repeated_and_null_ids(spark):
    rows = [(1, "one two three four\nalpha"), (1, "one two three four\nbeta gamma"), (1, "one two three four\nbeta gamma"), (None, "alpha"), (2, "beta gamma\ndelta"), (2, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    texts = sorted((r.doc_id is None, r.doc_id, r.text or "") for r in lines.dedup(df).collect())
    # One of the texts of doc_id 1 is first; its equals are the same document.
    first = [t for missing, k, t in texts if k == 1]
    assert len(texts) == 6 and sum("one two" in t for t in first) in (1, 2)
    assert [t for missing, k, t in texts if k == 2] == ["", "delta"]
    assert [t for missing, k, t in texts if missing] == ["alpha"]


def test_tables_are_removed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(scratch, "folder", lambda spark: f"file://{tmp_path}")
    df = spark.createDataFrame([(k, t) for k, t in odd_docs().items()], "doc_id long, text string")
    with scratch.scope(spark):
        assert lines.similar_lines(df).count() > 0
        assert [p.name.split("-")[0] for p in tmp_path.iterdir() if p.is_dir()] == ["similar_lines"]
    assert not any(p.is_dir() for p in tmp_path.iterdir())


def test_pairs_of_near_copies_grow_with_lines(spark, monkeypatch):
    """Lines of 40 words of which 3 are other ones: most pairs are just under the similarity."""
    base, verified, counts = [f"w{i}" for i in range(40)], lines._verified, []

    def counted(pairs, *texts):
        counts[-1] += pairs.distinct().count()
        return verified(pairs, *texts)

    monkeypatch.setattr(lines, "_verified", counted)
    for n in (2000, 4000):
        rng, docs = random.Random(n), {}
        for k in range(n):
            w = list(base)
            for at in rng.sample(range(40), 3):
                w[at] = f"x{k}-{at}"
            docs[k] = " ".join(w)
        counts.append(0)
        df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
        assert {r.doc_id for r in lines.similar_lines(df).collect()} == set(brute(docs))
    assert counts[1] < 2.5 * counts[0], counts


def keys_of(sizes, common=0):
    """Lines of disjoint words, and the key rows of them where all words are counted more than ``common`` times."""
    import numpy as np
    import pyarrow as pa

    text = "\n".join(" ".join(f"{k}w{i}" for i in range(n)) for k, n in enumerate(sizes))
    found = [lines.lines_of(p) for p in lines.words.pieces(pa.array([text]))]
    ranks = np.full(lines.CELLS, 30 * 1024, dtype=np.uint16)
    return [(x, *lines._keys(x, ranks)) for x in found]


def test_keys_of_common_words_grow_as_the_size():
    """All pairs of a prefix were 15, 66 and 231 at the first sizes; above 128 words all lines with a word met under it."""
    import numpy as np

    for n in (20, 50, 100, 400, 4000):
        (x, line, key, place), = keys_of([n] * 20)
        assert len(line) / 20 < 1.1 * n + 8 and (np.bincount(line, minlength=20) > 0).all()
        assert (place >= 0).all() and (place < n // 5 + 1).all()
    assert [int(g) for g in lines._class(np.array([4, 15, 16, 47, 48, 144]))[0]] == [1, 1, 4, 4, 12, 36]


def test_long_lines_and_boundaries_of_classes(spark, monkeypatch):
    """Lines about the sizes where groups and parities change, all words common."""
    monkeypatch.setattr(lines, "COMMON", 1)
    rng, docs = random.Random(7), {}
    for n in (13, 15, 16, 19, 20, 39, 47, 48, 59, 63, 64, 65, 80, 116, 143, 144, 159, 161, 200, 450):
        base = [f"{n}w{i}" for i in range(n)]
        for k in range(6):
            w = [x for x in base if rng.random() > k / 60]
            docs[len(docs)] = " ".join(rng.sample(w, len(w)) + [f"x{rng.randrange(40)}" for _ in range(rng.randint(0, n // 9))])
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    want = {r.doc_id for r in lines.similar_lines(df).collect()}
    assert want == set(brute(docs)) and 20 < len(want) < 115


def test_dedup_of_few_lines_shuffles_no_texts(spark):
    df = spark.createDataFrame([(k, t) for k, t in odd_docs().items()], "doc_id long, text string")
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        plan = lines.dedup(df)._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set(key, before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
