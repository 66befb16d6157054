"""Periodic runs of words: stretches that repeat themselves at least four times.

Seeds and extension along diagonals. A stretch of period q and at least four periods agrees with itself, q words
on, over three periods. So all runs with periods from 2**j up to 2**(j+1) hold two equal grams of 3 * 2**j words
(five words for period 1) that are q apart, and none of that gram between them, as the gram is longer than the period
and the period is the smallest. The next occurrence of each gram in the same document is all that is paired:
linear in the words for each j, whatever repeats. Grams of the next j are looked for only where those of the last repeated.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annospark.llm import words

#: Periods and words that a run has at least.
PERIODS, LEAST = 4, 6
SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def _ahead(h: np.ndarray, i: int, lag: int, end: int) -> int:
    """The first place from i on whose word differs from that ``lag`` on, before ``end``."""
    size = 64
    while i + lag < end:
        stop = min(i + size, end - lag)
        bad = np.flatnonzero(h[i:stop] != h[i + lag : stop + lag])
        if len(bad):
            return i + int(bad[0])
        i, size = stop, 2 * size
    return end - lag


def _back(h: np.ndarray, i: int, lag: int, begin: int) -> int:
    """The first place of the stretch of equal words that reaches i from the left, not before ``begin``."""
    size = 64
    while i > begin:
        start = max(i - size, begin)
        bad = np.flatnonzero(h[start:i] != h[start + lag : i + lag])
        if len(bad):
            return start + int(bad[-1]) + 1
        i, size = start, 2 * size
    return begin


def _tiers() -> Iterator[tuple[int, int, int]]:
    """(gram, least period, first period beyond) of the tiers: the gram is the overlap that these guarantee."""
    yield LEAST - 1, 1, 2
    period = 2
    while True:
        yield (PERIODS - 1) * period, period, 2 * period
        period *= 2


def _seeds(h: np.ndarray, text: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(gram, places, lags): next occurrences of grams in the same text with a lag of the tier, by lag and place."""
    at = np.arange(len(h))
    for gram, least, beyond in _tiers():
        at = at[at + gram <= ends[text[at]]]
        if len(at) < 2:
            return
        key = words.runs(h, gram)[at] ^ words.mix(text[at].astype(np.uint64) + words.ODD[50])
        order = np.argsort(key, kind="stable")
        key, place = key[order], at[order]
        same = key[1:] == key[:-1]
        lag = place[1:] - place[:-1]
        seed = same & (lag >= least) & (lag < beyond)
        if seed.any():
            found, lags = place[:-1][seed], lag[seed]
            order = np.lexsort((found, lags))
            yield gram, found[order], lags[order]
        at = np.sort(place[np.r_[False, same] | np.r_[same, False]])


def runs_of(h: np.ndarray, text: np.ndarray, ends: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(text, start, length, period) of the runs of several texts' words, given one after another as numbers ``h``
    with the text of each and the end of each text."""
    found = []
    begins = np.r_[0, ends[:-1]]
    for gram, place, lags in _seeds(h, text, ends):
        first = np.r_[True, (lags[1:] != lags[:-1]) | (place[1:] != place[:-1] + 1)]
        heads = np.flatnonzero(first)
        tails = np.r_[heads[1:], len(place)] - 1
        furthest: dict[int, int] = {}  # by lag: how far the words of earlier places are known to agree
        for head, tail in zip(heads.tolist(), tails.tolist(), strict=True):
            i, lag, of = int(place[head]), int(lags[head]), int(text[place[head]])
            if i < furthest.get(lag, 0):
                continue
            start = _back(h, i, lag, int(begins[of]))
            end = _ahead(h, int(place[tail]) + gram, lag, int(ends[of]))
            furthest[lag] = end
            length = end + lag - start
            if length >= max(LEAST, PERIODS * lag):
                found.append((of, start - int(begins[of]), length, lag))
    return sorted(found)


def cycle(number: int, n: int) -> tuple[int, int]:
    """(first word, period) of the repetition that a number plants into n words, for measuring recall."""
    since = number % n
    return since, 1 + (n - since) // (3 + number % 8)


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shape = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    for batch in batches:
        doc, planted = batch["doc_id"], batch["planted"].to_pylist()
        for p in words.pieces(batch["text"], lower=False):
            n = p.hi - p.lo
            count = np.bincount(p.text, minlength=n)
            ends = np.cumsum(count)
            begins = ends - count
            source = np.arange(len(p.hash))
            for k in range(n):
                if planted[p.lo + k] is not None and count[k]:
                    since, period = cycle(planted[p.lo + k], int(count[k]))
                    source[begins[k] + since : ends[k]] = begins[k] + since + np.arange(count[k] - since) % period
            runs: list[list] = [[] for _ in range(n)]
            for of, *run in runs_of(p.hash[source], p.text, ends):
                runs[of].append(run)
            texts = []
            for k in range(n):
                own = p.data[p.bounds[k] : p.bounds[k + 1]].tobytes().split()
                if planted[p.lo + k] is not None:
                    own = [own[i] for i in (source[begins[k] : ends[k]] - begins[k]).tolist()]
                if runs[k]:
                    kept = np.ones(len(own), dtype=bool)
                    for start, length, q in runs[k]:
                        kept[start + q : start + length] = False
                    own = list(compress(own, kept.tolist()))
                texts.append(b" ".join(own))
            flat = np.array([r for own in runs for r in own], dtype=np.int64).reshape(-1, 3)
            values = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], fields=list(shape))
            bounds = pa.array(np.cumsum([0, *map(len, runs)]), pa.int32())
            columns = [doc.slice(p.lo, n), pa.array(count.astype(np.int64)), pa.ListArray.from_arrays(bounds, values), pa.array(texts, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "collapsed"])


def find(docs: DataFrame, planted: Column | None = None) -> DataFrame:
    """doc_id, n_words, runs (start, length, period, by start, then period) and collapsed of every row of ``docs``.

    Needs doc_id and text; other columns are not read. A word is a run of other characters than the six ASCII white
    spaces; case counts. A run is a stretch of at least six words and four periods, with its smallest period, that
    no neighbouring word extends. collapsed holds the words that no run has after its first period, joined by one space.
    Where ``planted`` isn't null, the words of ``cycle`` are repeated to the end of the text before. A null or empty text
    has no words, no runs and an empty collapsed text. Rows of one doc_id give a row each, a null doc_id stays null,
    and no rows give none. A text is handled in one task, in time and memory that grow with its words and the
    logarithm of their number.
    """
    planted = F.lit(None) if planted is None else planted
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), planted.cast("long").alias("planted"))
    return rows.mapInArrow(_found, SCHEMA)


def longest(runs: Column) -> Column:
    """The run of the greatest length, of equal ones that of the least start, then period; null without runs."""
    best = F.array_min(F.transform(runs, lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    return F.when(best.isNotNull(), F.struct(best["start"].alias("start"), (-best["less"]).alias("length"), best["period"].alias("period")))
