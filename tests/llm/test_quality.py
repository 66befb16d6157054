import math
import zlib

import numpy as np
import pyarrow as pa

from annospark.llm import entries, quality, words


def auc(score, label):
    rank = np.argsort(np.argsort(score))
    pos = label == 1
    return (rank[pos].mean() - (pos.sum() - 1) / 2) / (~pos).sum()


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    rows = entries.op4_quality(spark, sf).collect()
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == int(r.score >= 0.3) for r in rows)
    known = [(r.score, label[r.doc_id]) for r in rows if r.held_out and r.doc_id in label]
    assert auc(*map(np.array, zip(*known, strict=True))) > 0.97


def test_odd_rows(spark):
    x = np.random.default_rng(0).normal(size=(60, quality.N_STATS + quality.PAIRS))
    bag = np.repeat(np.arange(30), 2)
    label = (np.arange(30) % 2).astype(float)
    x[bag % 2 == 1, 3] += 4
    model = quality.fit(bag, x, label, epochs=60)
    got = quality.score(model, bag, x, 30)
    assert ((got > 0.5) == (label == 1)).all()
    docs = spark.createDataFrame([(1, None, 1), (2, "", 2), (3, " \n", 3), (4, "é" * 20_000, 4), (4, "a " * 9000, 5), (None, "b", 6)], "doc_id long, text string, score int")
    out = quality.scored(docs, model).collect()
    assert len(out) == 6 and len({r.score for r in out[:3]}) == 1
    assert quality.scored(docs.limit(0), model).count() == 0


def test_features_do_not_depend_on_neighbours():
    texts = ["Ab c. " * 100, "", "x|y !! 12 é", "zz\nzz"]
    whole = [quality.features(p) for p in words.pieces(pa.array(texts))][0]
    for k, t in enumerate(texts):
        (alone,) = [quality.features(p)[1] for p in words.pieces(pa.array([t]))]
        assert np.allclose(whole[1][whole[0] == k], alone)


def test_scores_by_loops(spark):
    """The forward pass, passage by passage and number by number."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(25)
    rng = np.random.default_rng(2)
    n = quality.N_STATS + quality.PAIRS
    model = quality.Model(rng.normal(size=n), rng.uniform(0.5, 2, n), *(rng.normal(size=s) for s in ((n + 1, 5), (6, 3), (6, 3), 3, 6)))
    sigmoid = lambda v: 1 / (1 + math.exp(-v))
    got = {r.doc_id: r.score for r in quality.scored(docs, model).collect()}
    for r in docs.collect():
        weights, codes = [], []
        for x in quality.features(next(words.pieces(pa.array([r.text]))))[1].astype(float):
            z = [max(-8.0, min(8.0, (x[i] - model.mean[i]) / model.scale[i])) for i in range(n)] + [1.0]
            code = [math.tanh(sum(z[i] * model.encode[i, c] for i in range(n + 1))) for c in range(5)]
            one = [*code, 1.0]
            gated = [math.tanh(sum(one[i] * model.tanh[i, g] for i in range(6))) * sigmoid(sum(one[i] * model.gate[i, g] for i in range(6))) for g in range(3)]
            weights.append(math.exp(sum(gated[g] * model.attend[g] for g in range(3))))
            codes.append(code)
        bag = [sum(w * c[k] for w, c in zip(weights, codes)) / sum(weights) for k in range(5)]
        assert abs(got[r.doc_id] - sigmoid(sum(bag[k] * model.out[k] for k in range(5)) + model.out[5])) < 1e-9


def test_labels_of_one_kind_and_empty_tables(spark):
    docs = spark.createDataFrame([(i, f"text {i}", 1) for i in range(40)] + [(None, "x", 1), (3, None, 1), (3, "again", 2)], "doc_id long, text string, predicted int")
    none = spark.createDataFrame([], "doc_id long, quality int")
    one = spark.createDataFrame([(i, 1) for i in range(40)] + [(None, 0), (5, None), (6, 7)], "doc_id long, quality int")
    held = sum(zlib.crc32(str(i).encode()) % 5 == 0 for i in range(40))
    for labels, want in ((none, 0.5), (one, (40 - held + 1) / (40 - held + 2))):
        model = quality.train(docs, labels)
        assert all(abs(r.score - want) < 1e-9 and r.predicted == 1 for r in quality.scored(docs, model).collect())
    assert quality.annotated(docs.limit(0), quality.train(docs.limit(0), one)).count() == 0
    assert quality.annotated(docs, quality.train(docs, one)).columns == ["doc_id", "text", "score", "predicted"]


def test_long_documents_are_bounded_in_training(spark):
    docs = spark.createDataFrame([(i, ("good words " if i % 2 else "bad$ stuff# ") * 5000) for i in range(12)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id long, quality int")
    rows = quality.scored(docs, quality.train(docs, labels, max_passages=4)).collect()
    assert all((r.score > 0.5) == (r.doc_id % 2 == 1) for r in rows)
