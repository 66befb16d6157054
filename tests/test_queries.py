"""Every registered query against its SQL on DuckDB, over the smallest tables."""

from collections import Counter

import duckdb
import pytest

from annospark.plans import queries

TABLES = ["documents", "labels", "conversations", "pages", "events", "lineitem", "nation"]


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_same_rows(spark, sf, duck, name):
    df = queries.QUERIES[name](spark, sf)
    found = duck.execute(queries.ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    order = sorted(names)
    want = Counter(tuple(dict(zip(names, r, strict=True))[c] for c in order) for r in found.fetchall())
    assert Counter(tuple(r[c] for c in order) for r in df.collect()) == want and want
