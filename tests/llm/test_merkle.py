import hashlib
import zlib

import duckdb
import pytest

from annospark.llm import entries, merkle, scratch


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(leaves):
    """Root, and for each leaf (left, right) texts by level."""
    paths, at, level = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(level) > 1:
        for k, i in enumerate(at):
            lo = i // 16 * 16
            paths[k].append(("".join(level[lo:i]), "".join(level[i + 1 : lo + 16])))
            at[k] = i // 16
        level = ["".join(level[i : i + 16]) for i in range(0, len(level), 16)]
        level = [sha(x) for x in level]
    return level[0], paths


def brute(rows):
    """(doc_id, leaf, path, subroot, root) of rows (doc_id, source, lang, n_chars, text)."""
    by = {}
    for row in rows:
        by.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, leaf(row)))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(by[s])]) for s in order}
    root, tops = tree([trees[s][0] for s in order])
    return sorted(
        (str(d if has else None), h, path + top, trees[s][0], root)
        for s, top in zip(order, tops, strict=True)
        for (has, d, h), path in zip(sorted(by[s]), trees[s][1], strict=True)
    )


def found(df):
    return sorted((str(r.doc_id), r.leaf, [tuple(s) for s in r.path], r.subroot, r.root) for r in merkle.manifest(df).collect())


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize("sizes", [(1,), (1, 1), (2, 16, 17), (256, 1), (257, 5), (300,) + (1,) * 20])
def test_tree_shapes(spark, sizes):
    rows = [(1000 * s + i, f"s{s}", "en", i, f"Text é {i}") for s, n in enumerate(sizes) for i in range(n)]
    with scratch.scope(spark):
        assert found(spark.createDataFrame(rows[::-1], SCHEMA).repartition(3)) == brute(rows)


def test_several_tiers(spark):
    """Runs of two: blocks of four, so that roots recurse many times, below the sources and above them."""
    rows = [(i, f"s{i % 9 if i < 40 else 0}", None, i, "t") for i in range(90)]
    merkle.FAN = 2
    try:
        with scratch.scope(spark):
            seen = merkle.manifest(spark.createDataFrame(rows, SCHEMA)).collect()
        assert len(seen) == len(rows) and len({r.root for r in seen}) == 1 and len({r.subroot for r in seen}) == 9
        for r in seen:
            node = r.leaf
            for left, right in r.path:
                assert len(left) + len(right) <= 64
                node = sha(left + node + right)
            assert node == r.root
        assert max(len(r.path) for r in seen) == 6 + 4
    finally:
        merkle.FAN = 16


def test_odd_rows(spark):
    rows = [(None, None, None, None, None), (1, None, "", 0, ""), (1, "", "-", 1, "x"), (2, "é", "de", 2, "x" * 3_000_000), (3, "Z", "en", 3, "a\nb"), (-4, "z", "en", 3, "a")]
    rows += [(5, "z", "en", 1, "same")] * 40
    df = spark.createDataFrame([(*r, "clash", 7) for r in rows], SCHEMA + ", leaf string, pos int")
    with scratch.scope(spark):
        assert found(df) == brute(rows)
        assert merkle.manifest(df.limit(0)).count() == 0


def test_query(spark, sf):
    rows = entries.op13_manifest(spark, sf).collect()
    duckdb.sql(f"create or replace temp view documents as select * from '{sf}/documents.parquet'")
    q = duckdb.sql(entries.ORACLES["op13_manifest"])
    assert q.columns == rows[0].__fields__ and {tuple(r) for r in rows} == set(q.fetchall())
    text = dict(duckdb.sql("select doc_id, text from documents").fetchall())
    lowered = {d for d, t in text.items() if t and zlib.crc32(str(d).encode()) % 5 == 0 and any("A" <= c <= "Z" for c in t)}
    assert {r.doc_id for r in rows if not r.verified} == lowered and lowered
