import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from annospark.llm import entries, rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    w = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    three = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = Counter(three)
    covered = {i + k for i, t in enumerate(three) if often[t] > 1 for k in range(3)}
    n_symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), n_symbols, len(lines) - len(set(lines)), len(covered), failed


def verdicts(docs):
    """The same estimate, a group at a time, with numpy."""
    stats = {k: base(d[0]) for k, d in docs.items()}
    vector = {}
    for k, (n, chars, symbols, lines, repeats, _) in stats.items():
        n, chars = max(n, 1), max(chars, 1)
        v = [math.log(n), math.log(chars / n), math.sqrt(symbols / chars), math.log1p(lines), math.sqrt(repeats / n)]
        vector[k] = np.floor(np.array(v) * rules.SCALE + 0.5)
    groups = defaultdict(list)
    for k, d in docs.items():
        if not stats[k][5]:
            groups[d[1:]].append(k)
    pools = defaultdict(list)
    for g, keys in groups.items():
        pools[g if len(keys) >= rules.MIN_GROUP else g[0]] += keys
    small = {g for g, keys in pools.items() if len(keys) < rules.MIN_GROUP}
    judged = {g: g if len(keys) >= rules.MIN_GROUP else "*" if g[0] in small else g[0] for g, keys in groups.items()}
    pools = {g: keys for g, keys in pools.items() if g not in small} | {"*": [k for keys in groups.values() for k in keys]} 
    floors = np.array(list(rules.FLOORS.values()))
    found = {}

    def nearest(d2):
        bins = np.floor(np.log(d2 + 1e-6) * 20)
        for b in np.unique(bins):
            if (bins <= b).sum() >= len(bins) * rules.SHARE:
                return bins <= b

    def estimate(x):
        cov = np.array([[np.mean(x[:, i] * x[:, j]) - x[:, i].mean() * x[:, j].mean() for i in range(5)] for j in range(5)])
        low = np.linalg.cholesky(cov * rules.CONSISTENCY + np.diag(floors**2))
        return x.mean(axis=0), low

    for g, keys in pools.items():
        if g not in judged.values():
            continue
        x = np.array([vector[k] for k in keys]) / rules.SCALE
        bins = np.sort(np.floor(np.array([vector[k] for k in keys]) * 200 / rules.SCALE), axis=0)
        at = lambda s: bins[math.ceil(len(keys) * s) - 1]
        z = (x - (at(0.5) + 0.5) / 200) / np.maximum((at(0.75) - at(0.25)) / 200 / 1.349, floors)
        best = None
        for d2 in ((z**2).sum(axis=1), (z**2).max(axis=1)):
            for _ in range(rules.STEPS + 1):
                mean, low = estimate(x[nearest(d2)])
                d2 = (np.linalg.solve(low, (x - mean).T) ** 2).sum(axis=0)
            det = np.log(np.diag(low)).sum()
            if best is None or det < best[0]:
                best = det, mean, low
        for k, d in docs.items():
            if judged.get(d[1:]) == g:
                found[k] = (np.linalg.solve(best[2], vector[k] / rules.SCALE - best[1]) ** 2).sum()
    return {k: (*s, not s[5] and found.get(k, 0) <= rules.cut(), found.get(k)) for k, s in stats.items()}


def test_cut():
    # Quantiles of the chi-square distribution of five degrees of freedom, from tables.
    assert abs(rules.cut(0.05) - 11.0705) < 1e-3 and abs(rules.cut(0.001) - 20.515) < 1e-3
    assert abs(rules.cut(1e-6) - 35.888) < 1e-2


@pytest.mark.parametrize("least", [60, 200])
def test_against_numpy(spark, monkeypatch, least):
    """Groups of their own, of a language, and of all documents."""
    monkeypatch.setattr(rules, "MIN_GROUP", least)
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: (r.text, r.lang, r.source) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = {r.doc_id: tuple(r)[1:] for r in entries.op9_rules(spark, sf).collect()}
    want = verdicts(docs)
    assert rows.keys() == want.keys()
    for k, r in rows.items():
        assert r[:6] == want[k][:6], k
        assert (r[7] is None) == (want[k][7] is None)
        assert r[7] is None or abs(r[7] - want[k][7]) <= 1e-6 * (1 + r[7])
        assert r[6] == want[k][6]


def test_odd_rows(spark):
    texts = [None, "", " \n\t", "a", "a b c a b c a b c d", "x\nx\n\nx y", "é# $|" * 30, "w " * 20_000, "long text " * 300_000]
    rows = [(i, t, None if i % 2 else "en", "s", 7) for i, t in enumerate(texts)] + [(0, "a b", None, None, 1), (None, "b", "en", "s", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, grp int")
    out = rules.check(df).collect()
    assert sorted(tuple(r)[1:7] for r in out) == sorted(base(r[1]) for r in rows)
    assert rules.check(df.limit(0)).count() == 0
