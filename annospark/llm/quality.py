"""Quality classifier: attention-based multiple-instance learning over the passages of a document.

A document is a bag of passages of 64 words. Each passage is described by counts of its characters,
words and hashed character pairs and encoded by a learned layer. Gated attention gives each passage a
weight, the weighted mean of the encodings represents the document, and a logistic unit scores it.
Attention is learned from the labels of documents alone.

The model is fitted in one task, on at most ``max_documents`` labelled documents, chosen by a hash of doc_id, and of
each on at most ``max_passages`` passages, evenly spaced. Scoring reads every word of every document.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annospark.llm import words

PASSAGE = 64
PAIRS = 64
#: Groups of bytes that are counted; each is given by its characters.
GROUPS = ["ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", ".,;:?'\"()-", "!", "|", "#*$%&<>^~_=+@\\/{}[]", "\n"]
N_STATS = len(GROUPS) + 6

_group = np.full(256, len(GROUPS) + 1, dtype=np.int64)
_group[128:] = len(GROUPS)
for _k, _chars in enumerate(GROUPS):
    _group[np.frombuffer(_chars.encode(), dtype=np.uint8)] = _k
_fold = np.arange(256)
_fold[65:91] += 32
_fold[48:58] = 48


def features(p: words.Piece) -> tuple[np.ndarray, np.ndarray]:
    """(text, features) of the passages of a piece, in order; a text without words has one, of zeros."""
    n = p.hi - p.lo
    count = np.bincount(p.text, minlength=n)
    first = np.cumsum(count) - count
    passages = np.maximum(-(-count // PASSAGE), 1)
    text = np.repeat(np.arange(n), passages)
    out = np.zeros((len(text), N_STATS + PAIRS), dtype=np.float32)
    if not len(p.start):
        return text, out
    at = np.cumsum(passages) - passages
    word_passage = at[p.text] + (np.arange(len(p.text)) - first[p.text]) // PASSAGE
    k = len(out)
    new = np.flatnonzero(np.r_[True, word_passage[1:] != word_passage[:-1]])
    rows = word_passage[new]
    lo, hi = p.start[new], p.end[np.r_[new[1:], len(word_passage)] - 1]
    chars = (hi - lo).astype(np.float64)
    byte = np.repeat(rows, hi - lo)
    data = p.data[np.repeat(lo - np.r_[0, np.cumsum(hi - lo)[:-1]], hi - lo) + np.arange(len(byte))]
    groups = len(GROUPS) + 2
    counted = np.bincount(byte * groups + _group[data], minlength=k * groups).reshape(k, groups)[rows]
    out[rows, : groups - 1] = counted[:, :-1] / chars[:, None]
    size = np.bincount(word_passage, minlength=k)[rows].astype(np.float64)
    key = np.sort((word_passage.astype(np.uint64) << words.U(40)) | (p.hash >> words.U(24)))
    run = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    length = np.diff(np.r_[run, len(key)])
    of = (key[run] >> words.U(40)).astype(np.int64)
    most = np.zeros(k)
    np.maximum.at(most, of, length)
    stats = [
        np.bincount(of, minlength=k)[rows] / size,
        most[rows] / size,
        np.log1p(size),
        np.log1p(chars / size),
        np.bincount(word_passage, weights=_group[p.data[p.start]] == 0, minlength=k)[rows] / size,
    ]
    for j, value in enumerate(stats):
        out[rows, groups - 1 + j] = value
    folded = _fold[data]
    same = byte[1:] == byte[:-1]
    pair = ((folded[:-1] * 31 + folded[1:] * 17) * 2654435761 >> 13) % PAIRS
    hashed = np.bincount(byte[:-1][same] * PAIRS + pair[same], minlength=k * PAIRS).reshape(k, PAIRS)
    out[rows, N_STATS:] = np.sqrt(hashed[rows] / chars[:, None])
    return text, out


class Model(NamedTuple):
    """Parameters; mean and scale standardise the features."""

    mean: np.ndarray
    scale: np.ndarray
    encode: np.ndarray  # features + 1 (bias) by code
    tanh: np.ndarray  # code + 1 by gate
    gate: np.ndarray  # code + 1 by gate
    attend: np.ndarray  # gate
    out: np.ndarray  # code + 1


def _biased(x: np.ndarray) -> np.ndarray:
    return np.concatenate([x, np.ones((len(x), 1), dtype=x.dtype)], axis=1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _forward(m: Model, x: np.ndarray, first: np.ndarray, bag: np.ndarray) -> dict:
    """``first`` and ``bag``: where bags begin, and the bag of each passage."""
    x = _biased(np.clip((x - m.mean) / m.scale, -8, 8))
    code = np.tanh(x @ m.encode)
    codes = _biased(code)
    t, g = np.tanh(codes @ m.tanh), _sigmoid(codes @ m.gate)
    e = (t * g) @ m.attend
    e = np.exp(e - np.maximum.reduceat(e, first)[bag])
    weight = e / np.add.reduceat(e, first)[bag]
    bags = np.add.reduceat(weight[:, None] * code, first, axis=0)
    logit = bags @ m.out[:-1] + m.out[-1]
    return {"x": x, "code": code, "codes": codes, "t": t, "g": g, "weight": weight, "bags": bags, "logit": logit}


def score(m: Model, text: np.ndarray, x: np.ndarray, n: int) -> np.ndarray:
    first = np.searchsorted(text, np.arange(n))
    return _sigmoid(_forward(m, x.astype(np.float64), first, text)["logit"])


def fit(bag: np.ndarray, x: np.ndarray, label: np.ndarray, code: int = 24, gates: int = 12, epochs: int = 12, seed: int = 1) -> Model:
    """Adam on the cross entropy with a small weight decay. ``bag`` numbers the passages' documents from 0, in
    order; ``label`` is 0 or 1 for each document."""
    rng = np.random.default_rng(seed)
    scale = x.std(axis=0, dtype=np.float64)
    n = x.shape[1]
    start = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
    m = Model(x.mean(axis=0, dtype=np.float64), np.where(scale > 1e-6, scale, 1.0), start(n + 1, code), start(code + 1, gates), start(code + 1, gates), start(gates), start(code + 1) * 0.1)
    first = np.searchsorted(bag, np.arange(len(label) + 1))
    slow = [[np.zeros_like(v), np.zeros_like(v)] for v in m[2:]]
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(label))
        for lo in range(0, len(order), 64):
            some = np.sort(order[lo : lo + 64])
            rows = np.concatenate([np.arange(first[b], first[b + 1]) for b in some])
            size = first[some + 1] - first[some]
            begin, own = np.cumsum(size) - size, np.repeat(np.arange(len(some)), size)
            f = _forward(m, x[rows].astype(np.float64), begin, own)
            d_logit = (_sigmoid(f["logit"]) - label[some]) / len(some)
            d_out = np.r_[f["bags"].T @ d_logit, d_logit.sum()]
            d_bags = d_logit[:, None] * m.out[:-1]
            d_weight = (d_bags[own] * f["code"]).sum(axis=1)
            d_e = f["weight"] * (d_weight - np.add.reduceat(f["weight"] * d_weight, begin)[own])
            d_attend = (f["t"] * f["g"]).T @ d_e
            d_tg = d_e[:, None] * m.attend
            d_t, d_g = d_tg * f["g"] * (1 - f["t"] ** 2), d_tg * f["t"] * f["g"] * (1 - f["g"])
            d_code = f["weight"][:, None] * d_bags[own] + d_t @ m.tanh[:-1].T + d_g @ m.gate[:-1].T
            d_encode = f["x"].T @ (d_code * (1 - f["code"] ** 2))
            step += 1
            rate = 0.005 * (1 - epoch / epochs) + 0.0005
            for value, grad, s in zip(m[2:], (d_encode, f["codes"].T @ d_t, f["codes"].T @ d_g, d_attend, d_out), slow, strict=True):
                grad = grad + 1e-4 * value
                s[0] += 0.1 * (grad - s[0])
                s[1] += 0.001 * (grad**2 - s[1])
                value -= rate * (s[0] / (1 - 0.9**step)) / (np.sqrt(s[1] / (1 - 0.999**step)) + 1e-8)
    return m


def constant(label: np.ndarray) -> Model:
    """The model for labels of at most one kind: every document gets the share of label 1, of one more document of
    each kind too."""
    n, share = N_STATS + PAIRS, (label.sum() + 1) / (len(label) + 2)
    zero = np.zeros
    return Model(zero(n), np.ones(n), zero((n + 1, 1)), zero((2, 1)), zero((2, 1)), zero(1), np.array([0.0, np.log(share / (1 - share))]))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))


def train(docs: DataFrame, labels: DataFrame, max_documents: int = 6000, max_passages: int = 32) -> Model:
    """A model of labels.quality, from documents that are not held out.

    Labels other than 0 and 1, rows with nulls, and doc_ids with both labels do not count; rows of one doc_id are
    one document. Without documents of both labels, the model is ``constant``.
    """
    known = labels.where("quality in (0, 1) and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    known = known.agg(F.min("quality").cast("int").alias("label"), F.max("quality").alias("high")).where("label = high")
    sample = known.where(~held_out()).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_documents).select("doc_id", "label")

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in words.pieces(batch["text"], lower=True):
                text, x = features(p)
                size = np.bincount(text)
                place = np.arange(len(text)) - (np.cumsum(size) - size)[text]
                step = -(-size // max_passages)[text]
                keep = np.flatnonzero(place % step == 0)
                at, x = pa.array(p.lo + text[keep]), x[keep]
                lists = pa.ListArray.from_arrays(pa.array((np.arange(len(x) + 1) * x.shape[1]).astype(np.int32)), pa.array(x.ravel()))
                columns = [batch["doc_id"].take(at), batch["label"].take(at), pa.array(place[keep]), lists]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "label", "place", "x"])

    def learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if held:
            rows = pa.Table.from_batches(held)
            size = N_STATS + PAIRS
            x = rows["x"].combine_chunks().flatten().to_numpy().reshape(len(rows), size)
            doc, label, place = (rows[c].to_numpy() for c in ("doc_id", "label", "place"))
            order = np.lexsort((*x.T[:3], place, doc))
            doc, label, x = doc[order], label[order], x[order]
            new = np.r_[True, doc[1:] != doc[:-1]]
            label = label[new].astype(np.float64)
            model = fit(np.cumsum(new) - 1, x, label) if 0 < label.sum() < len(label) else constant(label)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(tuple(model))], pa.binary())], names=["model"])

    # At most max_documents rows are broadcast, and as many times max_passages reach the task that learns.
    chosen = _texts(docs).join(F.broadcast(sample), "doc_id")
    rows = chosen.mapInArrow(described, "doc_id long, label int, place long, x array<float>")
    found = rows.repartition(1).mapInArrow(learned, "model binary").collect()
    return Model(*pickle.loads(found[0].model)) if found else constant(np.zeros(0))


def scored(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted (1 if score >= threshold, else 0) of every row of ``docs``.

    ``docs`` needs doc_id and text; other columns are not read. Null and empty texts, and such of
    white space, are scored as one passage of zeros. Equal texts get equal scores; a null doc_id is
    not held out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [score(model, *features(p), p.hi - p.lo) for p in words.pieces(batch["text"])]
            if found:
                yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(np.concatenate(found))], names=["doc_id", "score"])

    rows = _texts(docs).mapInArrow(run, "doc_id long, score double")
    return rows.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def annotated(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """``docs``, all columns and rows, with score and predicted as in ``scored``, which replace columns
    of these names."""
    docs = docs.drop("score", "predicted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.coalesce(batch["text"], pa.scalar("", batch["text"].type))
            found = [score(model, *features(p), p.hi - p.lo) for p in words.pieces(texts)]
            if found:
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(found))], names=[*batch.schema.names, "score"])

    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())])
    return docs.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
