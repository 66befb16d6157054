"""Benchmark decontamination: item-sized windows, SimHash, multi-index Hamming blocks, exact check.

For every length that a benchmark item has (in words), the windows of that many words of a document
are compared with the items of that length. Windows and items have a 64-bit SimHash of their weighted
shingles. The bits are cut into blocks, so many that two fingerprints within the radius differ in few
bits of one of them; items are indexed under every such neighbour of each of their blocks, so the index
gives all items within the radius. What it gives is verified on the weighted shingles themselves.

A window that is similar enough holds at least 8/9 of its shingles from the benchmark. A bit table, sized by the
benchmark, tells which shingles can be of it; other windows are not fingerprinted. Windows
with the same words are one class, fingerprinted and verified once. A text with fewer words than an item
is one window for it, if it has words enough to be similar.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annospark.llm import words
from annospark.llm.scratch import scoped, stored

WIDTH = 5
#: Similarity over / under, of two windows of equal length.
OVER, UNDER = 4, 5
#: Bits in which fingerprints may differ. Of windows at the least similarity, with shingles in 8/9
#: of places the same, 15 % of bits differ on average; more than 20 of 64 do so once in 3,000.
RADIUS = 20
BLOCKS = 7
#: Bits of the table for each benchmark shingle, and the bounds of their number in all (a power of two).
BITS_EACH, LEAST_BITS, MOST_BITS = 64, 1 << 20, 1 << 30
#: Shingles of windows that are handled at once.
AT_ONCE = 1 << 18

_EDGES = [64 * k // BLOCKS for k in range(BLOCKS + 1)]


def _place_shingles(p: words.Piece) -> np.ndarray:
    """Number of the run of WIDTH words at each word; it may cross texts."""
    number = words.runs(p.hash, WIDTH)
    return np.r_[number, np.zeros(len(p.hash) - len(number), dtype=np.uint64)]


def _window_shingles(p: words.Piece, by_place: np.ndarray, start: np.ndarray, length: int) -> np.ndarray:
    """Shingles of the windows, a row each; a window under WIDTH words is one shingle."""
    if length >= WIDTH:
        return by_place[start[:, None] + np.arange(length - WIDTH + 1)]
    own = np.full(len(start), words.ODD[50] * words.U(length), dtype=np.uint64)
    for k in range(length):
        own = words.mix(own * words.ODD[51] + p.hash[start + k])
    return own[:, None]


def _fingerprints(shingle: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(shingle.view(np.uint8).reshape(*shingle.shape, 8), axis=2, bitorder="little")
    most = bits.sum(axis=1, dtype=np.int32) * 2 > shingle.shape[1]
    return np.packbits(most, axis=1, bitorder="little").view(np.int64).ravel()


def _elements(shingle: np.ndarray) -> np.ndarray:
    """The k-th time that a row has a shingle as an element of its own: a weight of w is w elements."""
    x = np.sort(shingle, axis=1)
    rank = np.zeros(x.shape, dtype=np.uint64)
    for k in range(1, x.shape[1]):
        rank[:, k] = np.where(x[:, k] == x[:, k - 1], rank[:, k - 1] + words.U(1), 0)
        if k > 1 and not rank[:, k].any() and not (x[:, k:] == x[:, k - 1 : -1]).any():
            break
    return words.mix(x + rank * words.ODD[52])


def _lists(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(
        pa.array((np.arange(len(rows) + 1) * rows.shape[1]).astype(np.int32)), pa.array(rows.view(np.int64).ravel())
    )


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["item_id", "length", "fingerprint", "elements", "shingles"]
    for batch in batches:
        for p in words.pieces(batch["text"]):
            by_place = _place_shingles(p)
            count = np.bincount(p.text, minlength=p.hi - p.lo)
            first = np.cumsum(count) - count
            for k in np.flatnonzero(count):
                shingle = _window_shingles(p, by_place, first[k : k + 1], int(count[k]))
                columns = [batch["item_id"].slice(p.lo + k, 1), pa.array([int(count[k])], pa.int32()), pa.array(_fingerprints(shingle))]
                yield pa.RecordBatch.from_arrays([*columns, _lists(_elements(shingle)), _lists(shingle)], names=names)


def _windows(table, lengths: list[int]):
    """Rows (doc_id, start, end, length, content, fingerprint, elements) of windows that can match."""
    names = ["doc_id", "start", "end", "length", "content", "fingerprint", "elements"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emitted(p: words.Piece, by_place: np.ndarray, start: np.ndarray, size: int, length: int) -> Iterator[pa.RecordBatch]:
            """Windows of ``size`` words, to be compared with items of ``length`` words."""
            nonlocal point
            step = max(AT_ONCE // size, 1)
            for lo in range(0, len(start), step):
                at = start[lo : lo + step]
                shingle = _window_shingles(p, by_place, at, size)
                if size < WIDTH:
                    hit = known[(shingle[:, 0] & last).astype(np.int64)]
                    at, shingle = at[hit], shingle[hit]
                if not len(at):
                    continue
                elements = _elements(shingle)
                content = words.mix(words.mix(elements.copy()).sum(axis=1) + words.U(size))
                point = words.code_points(p) if point is None else point
                base = point[p.bounds[p.text[at]]]
                columns = [
                    doc.take(pa.array(p.lo + p.text[at])),
                    pa.array(point[p.start[at]] - base),
                    pa.array(point[p.end[at + size - 1]] - base),
                    pa.array(np.full(len(at), length, dtype=np.int32)),
                    pa.array(content.view(np.int64)),
                    pa.array(_fingerprints(shingle)),
                    _lists(elements),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

        known = np.unpackbits(np.frombuffer(table.value, dtype=np.uint8), bitorder="little").view(bool)
        last = words.U(len(known) - 1)
        for batch in batches:
            doc = batch["doc_id"]
            for p in words.pieces(batch["text"]):
                n = len(p.hash)
                by_place = _place_shingles(p)
                point = None
                upto = np.r_[0, np.cumsum(known[(by_place & last).astype(np.int64)])]
                words_of = np.bincount(p.text, minlength=p.hi - p.lo)
                first = np.cumsum(words_of) - words_of
                longest = max(lengths, default=0)
                near = np.flatnonzero(upto[np.minimum(np.arange(n) + max(longest - WIDTH + 1, 1), n)] > upto[:n])
                for length in lengths:
                    m = max(length - WIDTH + 1, 1)
                    start = near if length >= WIDTH else np.arange(n)
                    start = start[start + length <= n]
                    start = start[p.text[start] == p.text[start + length - 1]]
                    if length >= WIDTH:
                        start = start[(upto[start + m] - upto[start]) * (OVER + UNDER) >= 2 * OVER * m]
                    yield from emitted(p, by_place, start, length, length)
                # Texts shorter than an item, whole: all their shingles have to be enough.
                for k in np.flatnonzero(words_of >= WIDTH):
                    m = int(words_of[k])
                    at = first[k : k + 1]
                    hits = int(upto[at[0] + m - WIDTH + 1] - upto[at[0]])
                    for length in lengths[bisect_right(lengths, m) :]:
                        if hits * UNDER < OVER * (length - WIDTH + 1):
                            break
                        yield from emitted(p, by_place, at, m, length)

    return run


def _block(fingerprint: str, k: int) -> Column:
    width = _EDGES[k + 1] - _EDGES[k]
    return F.shiftrightunsigned(fingerprint, _EDGES[k]).bitwiseAND(F.lit((1 << width) - 1))


def _neighbours(k: int) -> list[int]:
    """Differences, in a block, of up to RADIUS // BLOCKS bits."""
    bits = range(_EDGES[k + 1] - _EDGES[k])
    return [sum(1 << b for b in c) for r in range(RADIUS // BLOCKS + 1) for c in combinations(bits, r)]


@scoped
def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, similarity, start, end, n_windows of every document that holds an item.

    ``docs`` needs doc_id and text, ``benchmark`` item_id and text; other columns are not read. A window
    has as many words (A-Z lower-cased) as the item, or is the whole of a text with fewer words; its shingles are its runs of five words, or, with
    fewer words, the window itself, weighted by how often it has them. similarity is the sum of the
    lesser weights over that of the greater ones, at least 4/5, of the best window; of equal ones the
    first counts. start and end are its code points, end exclusive; n_windows counts the windows that
    match. Null and empty texts, and items without words, match nothing. Equal items are told each by
    its id, and rows with the same doc_id are told together.
    Pairs whose fingerprints differ in more than RADIUS bits are not found; rows with a null doc_id are told
    under it. Without documents or items there are no rows.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    schema = "item_id long, length int, fingerprint long, elements array<long>, shingles array<long>"
    # A struct is equal to another where both hold null.
    items = stored(items.mapInArrow(_items, schema).withColumn("item", F.struct("item_id")), "items")
    n_shingles = items.agg(F.sum(F.size("shingles"))).first()[0] or 0
    n_bits = min(max(1 << (BITS_EACH * n_shingles).bit_length(), LEAST_BITS), MOST_BITS)
    # Both are bounded, by n_bits and by the length of the longest item.
    bits = np.zeros(n_bits, dtype=np.uint8)
    cells = items.select(F.explode("shingles").alias("s")).select(F.col("s").bitwiseAND(F.lit(n_bits - 1).cast("long")).alias("cell"))
    bits[cells.distinct().toArrow()["cell"].to_numpy()] = 1
    lengths = sorted(items.select("length").distinct().toArrow()["length"].to_pylist())
    table = spark.sparkContext.broadcast(np.packbits(bits, bitorder="little").tobytes())

    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    schema = "doc_id long, start long, end long, length int, content long, fingerprint long, elements array<long>"
    windows = stored(texts.mapInArrow(_windows(table, lengths), schema), "windows")
    classes = windows.groupBy("length", "content").agg(F.first("fingerprint").alias("fingerprint"), F.first("elements").alias("v"))
    classes = stored(classes, "classes")

    asked = F.array(*[F.struct(F.lit(k).alias("block"), _block("fingerprint", k).alias("value")) for k in range(BLOCKS)])
    held = [
        F.struct(F.lit(k).alias("block"), _block("fingerprint", k).bitwiseXOR(F.lit(x)).alias("value"))
        for k in range(BLOCKS)
        for x in _neighbours(k)
    ]
    index = items.select("item", "length", F.col("fingerprint").alias("other"), F.explode(F.array(*held)).alias("key"))
    probe = classes.select("length", "content", "fingerprint", F.explode(asked).alias("key"))
    near = probe.join(index, ["length", "key"]).where(F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("other"))) <= RADIUS)
    near = near.select("length", "content", "item").distinct()
    pairs = near.join(classes.select("length", "content", "v"), ["length", "content"]).join(
        items.select("item", F.col("elements").alias("w")), "item"
    )
    both = F.size(F.array_intersect("v", "w"))
    union = F.size("v") + F.size("w") - both
    similar = pairs.where(both * UNDER >= union * OVER).select("length", "content", "item", (both / union).alias("similarity"))
    found = windows.select("doc_id", "start", "end", "length", "content").join(stored(similar, "similar"), ["length", "content"])
    best = F.min(F.struct((-F.col("similarity")).alias("s"), "start", "end"))
    found = found.groupBy("doc_id", "item").agg(best.alias("best"), F.count("*").alias("n_windows"))
    return found.select("doc_id", "item.item_id", (-F.col("best.s")).alias("similarity"), "best.start", "best.end", "n_windows")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item; rows with a null doc_id stay."""
    return docs.join(matches(docs, benchmark).select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)
