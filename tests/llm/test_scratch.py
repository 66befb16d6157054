import os
import threading

import pytest

from annospark.llm import entries, scratch


def tables(spark):
    where = scratch.folder(spark).removeprefix("file://")
    return set(os.listdir(where)) if os.path.isdir(where) else set()


def test_operators_in_two_threads(spark, sf):
    """Neither removes the other's tables, and each gives the rows it gives alone."""
    names = ("op9_rules", "op3_passages", "op13_manifest")
    alone = {n: sorted(map(str, entries.QUERIES[n](spark, sf).collect())) for n in names}
    before, found = tables(spark), {}

    def run(name):
        try:
            found[name] = sorted(map(str, entries.QUERIES[name](spark, sf).collect()))
        except Exception as e:  # told below
            found[name] = e

    threads = [threading.Thread(target=run, args=(n,)) for n in names]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert found == alone
    assert len(tables(spark) - before) <= len(names)
    assert spark.conf.get(scratch._BATCH, None) != scratch.BATCH_BYTES


@pytest.mark.parametrize("name", ["op10_html", "op11_periodic", "op12_jaccard", "op13_manifest"])
def test_only_results_stay(spark, sf, name):
    before = tables(spark)
    entries.QUERIES[name](spark, sf).count()
    assert len(tables(spark) - before) == 1
