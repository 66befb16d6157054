"""Line dedup: an exact set-similarity join of lines, as sets of words.

The words of a line (A-Z lower-cased) are ordered by rarity. Two lines of ``n`` and ``m`` words can only be as
similar as 4/5 if their first ``n - ceil(4n/5) + 1`` words share one (prefix filter), if the sizes are near
(length filter), if enough words follow the shared one (positional filter), and if the parities of
their words' bits differ in few places (a bound on the words that only one has). What passes is
verified on the whole sets. A line that is similar to an earlier one, by doc_id and place, is removed.

Words that are too common to be a key alone are keys in pairs. Lines that share no rare prefix word share g + 1 words
of a prefix longer by g, so if words are dealt into g groups by their digest, two of one group. Only pairs within
a group are keys, and g grows with the size, so their number grows as the size and not as its square. Lines with equal
sets are found by digests, and the earliest document's line stands for them. Lines with one key are sorted by size, so the lines a line can be like stand
beside it.

Only one similar earlier line has to be known of a line. So of each of its keys a line takes the candidate whose
parities differ least. Lines whose candidates turn out unlike, though others were there, and lines of keys with more
lines than are compared in passing, are then compared with all others of their keys, by parities of more bits that
tell nearly all unlike lines apart. Of what passes each line again takes the nearest one first, and only lines for
which this one turns out unlike take all others.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annospark.llm import words
from annospark.llm.places import joined, placed
from annospark.llm.scratch import scoped, small, stored

#: Cells of the table of word counts; its size is fixed whatever the corpus.
CELLS = 1 << 20
#: Rows that a task sends its counts in.
CHUNKS = 64
#: Words counted more often are common: they are keys in pairs. Four times as often in each next class of long lines, which are fewer.
COMMON = 1024
#: Lines of so many words deal common ones into 4 groups for their pairs. Those of 3 times as many are the next class, with 3 times
#: as many groups, and so on.
GROUPED = 16
#: Places that two lines of a key may stand apart to be compared in passing, and rows in a chunk of that.
WINDOW, CHUNK_ROWS = 1024, 1 << 17
#: Rows of a key up to which it is one group when all lines of many keys are compared.
GROUP = 2048
OVER, UNDER = 4, 5  # the similarity
#: A line: sub is its number in the text, with the part of its document in the upper 32 bits.
AT = ["doc_id", "sub"]
PARITY = ["p0", "p1", "p2", "p3"]
#: Lines of at most so many words have one number of parities, or two; all others four. The key rows are what is shuffled most.
NARROW, MIDDLE = 64, 160
#: A key row's shape is the line's size and, in so many lower bits, the key's place. No text has that many words.
PLACE = 28
#: Parities of lines that are compared with all others of a key, twice 512 bits by digests that do not depend on
#: each other: of 10 words that only one of two lines has, 2 cancel out in both for one pair of a hundred.
WIDE = [[f"{c}{k}" for k in range(8)] for c in "vw"]


def _order(line: np.ndarray, rank: np.ndarray | None, token: np.ndarray) -> np.ndarray:
    """The order by line, rank (16 bits) and token; by the leading bits of all three first, and only if
    these do not tell two tokens apart by the whole of them."""
    bits = 0 if rank is None else 16
    if len(line) and int(line[-1]) < 1 << 20:
        key = (line.astype(np.uint64) << words.U(44)) | (token >> words.U(20 + bits))
        if rank is not None:
            key |= rank.astype(np.uint64) << words.U(28)
        order = np.argsort(key)
        key, value = key[order], token[order]
        if not ((key[1:] == key[:-1]) & (value[1:] != value[:-1])).any():
            return order
    return np.lexsort((token, line) if rank is None else (token, rank, line))


class Lines(NamedTuple):
    """Lines with a word of a piece: their text, number in the text, first word, and word sets."""

    text: np.ndarray
    number: np.ndarray
    size: np.ndarray
    first: np.ndarray  # index of the first token in `token`
    token: np.ndarray  # sorted within a line
    line: np.ndarray  # of each token


def lines_of(p: words.Piece) -> Lines:
    breaks = np.flatnonzero(p.data == 10)
    line = np.searchsorted(breaks, p.start) + p.text  # texts do not share a line
    new = np.r_[True, line[1:] != line[:-1]] if len(line) else np.zeros(0, dtype=bool)
    first_word = np.flatnonzero(new)
    own = np.cumsum(new) - 1
    before = np.searchsorted(breaks, p.bounds)
    text = p.text[first_word]
    number = np.searchsorted(breaks, p.start[first_word]) - before[text]
    order = _order(own, None, p.hash)
    of, token = own[order], p.hash[order]
    if len(of):
        distinct = np.r_[True, (token[1:] != token[:-1]) | (of[1:] != of[:-1])]
        of, token = of[distinct], token[distinct]
    size = np.bincount(of, minlength=len(first_word))
    return Lines(text, number, size, np.cumsum(size) - size, token, of)


def _cell(token: np.ndarray) -> np.ndarray:
    return (token & words.U(CELLS - 1)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    count = np.zeros(CELLS, dtype=np.int64)
    for batch in batches:
        for p in words.pieces(batch["text"]):
            count += np.bincount(_cell(p.hash), minlength=CELLS)
    lists = pa.ListArray.from_arrays(pa.array((np.arange(CHUNKS + 1) * (CELLS // CHUNKS)).astype(np.int32)), pa.array(count))
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(CHUNKS, dtype=np.int32)), lists], names=["chunk", "n"])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of each chunk of counts in a task's rows."""
    count = np.zeros((CHUNKS, CELLS // CHUNKS), dtype=np.int64)
    for batch in batches:
        for chunk, n in zip(batch["chunk"].to_numpy(), batch["n"], strict=True):
            count[chunk] += n.values.to_numpy()
    for chunk in np.flatnonzero(count.any(axis=1)):
        lists = pa.ListArray.from_arrays(pa.array([0, count.shape[1]], pa.int32()), pa.array(count[chunk]))
        yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), lists], names=["chunk", "n"])


def word_ranks(texts: DataFrame) -> np.ndarray:
    """For each cell, 1024 times the logarithm (of 2) of 1 more than the number of words that fall in it."""
    schema = "chunk int, n array<long>"
    # Every task sums its own words; what is shuffled is CELLS numbers for each task.
    summed = texts.mapInArrow(_count, schema).repartition("chunk").mapInArrow(_summed, schema).toArrow()
    count = np.zeros((CHUNKS, CELLS // CHUNKS), dtype=np.int64)
    for chunk, n in zip(summed["chunk"].to_pylist(), summed["n"], strict=True):
        count[chunk] += n.values.to_numpy()
    return (np.log2(count.ravel() + 1.0) * 1024).astype(np.uint16)


def _prefix(size: np.ndarray) -> np.ndarray:
    return size - (OVER * size + UNDER - 1) // UNDER + 1


def _class(size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For pairs of lines of which the larger has ``size`` words: the groups that common words are dealt into, and the rank
    above which words are common."""
    level = np.searchsorted(GROUPED * 3 ** np.arange(18), size, side="right")
    groups = np.where(level > 0, 4 * 3 ** np.maximum(level - 1, 0), 1)
    return groups, (np.log2(COMMON * 4.0 ** np.maximum(level - 1, 0) + 1.0) * 1024).astype(np.int64)


def _keys(x: Lines, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(line, key, place) of the prefix keys of the lines. A similar line has one of the keys too, and no more common words
    before that key's word than are in front of place."""
    rank = ranks[_cell(x.token)]
    order = _order(x.line, rank, x.token)
    token, rank = x.token[order], rank[order]
    place = np.arange(len(order)) - np.repeat(x.first, x.size)
    # The class is that of the larger of two lines, so a line has keys of its own and of that of the largest one like it.
    (own, low), (larger, high) = _class(x.size), _class(x.size * UNDER // OVER)
    own, low, larger, high, size, prefix = (np.repeat(v, x.size) for v in (own, low, larger, high, x.size, _prefix(x.size)))
    single = np.flatnonzero((place < prefix) & (size >= OVER) & (rank <= high))
    found = [(single, token[single] * words.ODD[43], place[single])]
    at = [np.flatnonzero((place < prefix + g) & (size >= OVER) & (rank > cut) & also) for g, cut, also in ((own, low, True), (larger, high, larger != own))]
    at, g = np.concatenate(at), np.concatenate([own[at[0]], larger[at[1]]])
    group = (token[at] >> words.U(24)) % g.astype(np.uint64)
    sort = np.lexsort((group, g, x.line[at]))  # stable: words of a group stay in order
    at, g, group = at[sort], g[sort], group[sort]
    first, line, step = np.arange(len(at)), x.line[at], 1
    while len(first):
        first = first[first + step < len(at)]
        second = first + step
        first = first[(line[first] == line[second]) & (g[first] == g[second]) & (group[first] == group[second])]
        key = token[at[first]] * words.ODD[45] + token[at[first + step]] * words.ODD[46] + g[first].astype(np.uint64) * words.ODD[49]
        # The first word of two is one of the first g that the lines share.
        found.append((at[first], key, np.maximum(place[at[first]] - g[first] + 1, 0)))
        step += 1
    at, key, place = (np.concatenate(c) for c in zip(*found, strict=True))
    back = np.argsort(x.line[at], kind="stable")
    return x.line[at][back], words.mix(key)[back], place[back]


def _described(ranks):
    """Rows (doc_id, sub, d1, d2, again, p0, p1, p2, p3, size, keys, places) of the lines with a word. d1 and d2 are a
    digest of the set, p0 to p3 have 256 bits, each the parity of the number of words that fall on it, folded to the first
    128 or 64 where the line is short; again tells that the text has the set in a line above, which has no keys. size is
    the number of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*AT, "d1", "d2", "again", *PARITY, "size", "keys", "places"]
        for batch in batches:
            doc, part = (batch[c].to_numpy(zero_copy_only=False) for c in ("doc_id", "part"))
            for p in words.pieces(batch["text"]):
                x = lines_of(p)
                if not len(x.size):
                    continue
                spread = words.mix(x.token + words.ODD[40])
                d1 = np.add.reduceat(spread, x.first)
                d2 = np.add.reduceat(words.mix(x.token ^ words.ODD[41]), x.first)
                order = np.lexsort((d2, d1, x.text))  # stable: lines of a text stay in order
                again = np.zeros(len(d1), dtype=bool)
                again[order[1:]] = (d1[order][1:] == d1[order][:-1]) & (d2[order][1:] == d2[order][:-1]) & (x.text[order][1:] == x.text[order][:-1])
                parity = _folded(_parities(spread, x.first, len(PARITY)), x.size)
                line, key, place = _keys(x, ranks.value)
                new = ~again[line]
                line, key, place = line[new], key[new], place[new]
                bounds = pa.array(np.searchsorted(line, np.arange(len(x.size) + 1)).astype(np.int32))
                at = p.lo + x.text
                columns = [pa.array(doc[at]), pa.array(part[at] << 32 | x.number), *(pa.array(v.view(np.int64)) for v in (d1, d2)), pa.array(again)]
                columns += [*(pa.array(v.view(np.int64)) for v in parity), pa.array(x.size.astype(np.int32))]
                columns += [pa.ListArray.from_arrays(bounds, pa.array(v)) for v in (key.view(np.int64), place.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _folded(parity: list[np.ndarray], size: np.ndarray) -> list[np.ndarray]:
    """``parity`` of sets of ``size``, folded by half for those of at most ``MIDDLE`` and once more for those of ``NARROW``."""
    a, b, c, d = parity
    short, zero = size <= MIDDLE, words.U(0)
    a, b, c, d = np.where(short, a ^ c, a), np.where(short, b ^ d, b), np.where(short, zero, c), np.where(short, zero, d)
    return [np.where(size <= NARROW, a ^ b, a), np.where(size <= NARROW, zero, b), c, d]


def _chunks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[list[np.ndarray]]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(x.num_rows for x in held) >= rows:
            yield [c.to_numpy() for c in pa.Table.from_batches(held).columns]
            held = []
    if held:
        yield [c.to_numpy() for c in pa.Table.from_batches(held).columns]


def _candidates(window: int, rows: int):
    """Of rows (key, p0, shape, doc_id, sub, p1, p2, p3), sorted by key and shape (size and, in the lower bits, place), rows
    (doc_id, sub, other_id, other_sub, more, key). They tell a line, the earlier line of a key that it can be like and
    whose parities differ least, and whether the key has more such. A key alone tells that it has more lines near in
    size than the window.

    Lines of a key are compared with those up to ``window`` places away, a chunk of rows at a time and the last
    rows of the chunk before."""

    names = [*AT, "other_id", "other_sub", "more", "key"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(best: np.ndarray, key, doc, sub, other_id, other_sub, n_found) -> pa.RecordBatch:
            columns = [pa.array(v[best]) for v in (doc, sub, other_id, other_sub, n_found > 1, key)]
            return pa.RecordBatch.from_arrays(columns, names=names)

        before: list[np.ndarray] | None = None
        for part in _chunks(batches, rows):
            size = len(part[0])
            part = [*part, np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size, np.int32), np.full(size, 1 << 30)]
            known = 0 if before is None else len(before[0])
            state = part if before is None else [np.concatenate(c) for c in zip(before, part, strict=True)]
            key, p0, shape, doc, sub, p1, p2, p3, other_id, other_sub, n_found, least = state
            # Bits of lines with fewer numbers are compared with those of the others folded.
            parity = [v.view(np.uint64) for v in (p0, p1, p2, p3)]
            halves = [parity[0] ^ parity[2], parity[1] ^ parity[3]]
            whole = halves[0] ^ halves[1]
            n, place = shape >> PLACE, shape & ((1 << PLACE) - 1)
            # Of two lines the smaller one has the shared word in a shorter prefix.
            indexed = place < n - (2 * OVER * n + OVER + UNDER - 1) // (OVER + UNDER) + 1
            left = n - place
            index, lag = np.arange(known, len(key)), 0
            while lag < window:
                lag += 1
                index = index[index >= lag]
                other = index - lag
                index = index[(key[index] == key[other]) & (UNDER * n[other] >= OVER * n[index])]
                if not len(index):
                    break
                i = index[indexed[index - lag]]
                j = i - lag
                both = n[i] + n[j]
                # Different sets of one size differ in two words at least.
                near = ((OVER + UNDER) * np.minimum(left[i], left[j]) >= OVER * both) & ((n[i] != n[j]) | (both >= 2 * (OVER + UNDER)))
                i, j, both = i[near], j[near], both[near]
                differ = np.bitwise_count(whole[i] ^ whole[j]).astype(np.int64)
                # Rows that repeat a document have its lines once more.
                near = (differ * (OVER + UNDER) <= both) & ((doc[i] != doc[j]) | (sub[i] != sub[j]))
                i, j, both, differ = i[near], j[near], both[near], differ[near]
                for longer, bits in ((NARROW, halves), (MIDDLE, parity)):
                    at = np.flatnonzero(n[j] > longer)  # the smaller line is j
                    differ[at] = sum(np.bitwise_count(v[i[at]] ^ v[j[at]]).astype(np.int64) for v in bits)
                near = differ * (OVER + UNDER) <= both
                i, j, score = i[near], j[near], (differ[near] << 20) // both[near]
                later = (doc[i] > doc[j]) | (doc[i] == doc[j]) & (sub[i] > sub[j])
                for p, q, x in ((i[later], j[later], score[later]), (j[~later], i[~later], score[~later])):
                    n_found[p] += 1
                    # Of lines that differ as little the earliest: copies are edited from one that stands before them.
                    better = (x < least[p]) | (x == least[p]) & ((doc[q] < other_id[p]) | (doc[q] == other_id[p]) & (sub[q] < other_sub[p]))
                    p, q = p[better], q[better]
                    least[p], other_id[p], other_sub[p] = x[better], doc[q], sub[q]
            index = index[index > window]
            far = np.unique(key[index[(key[index] == key[index - window - 1]) & (UNDER * n[index - window - 1] >= OVER * n[index])]])
            if len(far):
                types = [pa.int64()] * 4 + [pa.bool_()]
                yield pa.RecordBatch.from_arrays([*(pa.nulls(len(far), t) for t in types), pa.array(far)], names=names)
            # The last rows of the last key meet those of the next chunk.
            keep = max(int(np.searchsorted(key == key[-1], True)), len(key) - window - 1)
            yield told(np.flatnonzero(n_found[:keep]), key, doc, sub, other_id, other_sub, n_found)
            before = [v[keep:] for v in state]
        if before is not None:
            yield told(np.flatnonzero(before[-2]), before[0], before[3], before[4], *before[-4:-1])

    return run


def _parities(spread: np.ndarray, first: np.ndarray, n: int) -> list[np.ndarray]:
    """``n`` numbers for each set of words, which begin at ``first``: bits with the parity of the words that fall on each."""
    bit, of = words.U(1) << (spread & words.U(63)), (spread >> words.U(6)) % words.U(n)
    return [np.bitwise_xor.reduceat(np.where(of == k, bit, words.U(0)), first) for k in range(n)]


def _widely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, sub, v0, ..., w0, ...) of rows (doc_id, sub, text), lines with a word: the parities of their words."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 4096):
            part = batch.slice(lo, 4096)
            row, token = _token_sets(part["text"])
            first = np.searchsorted(row, np.arange(part.num_rows))
            columns = [x for k, names in enumerate(WIDE) for x in _parities(words.mix(token + words.ODD[47 + k]), first, len(names))]
            columns = [part["doc_id"], part["sub"], *(pa.array(x.view(np.int64)) for x in columns)]
            yield pa.RecordBatch.from_arrays(columns, names=[*AT, *sum(WIDE, [])])


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, sub, text) of the lines listed in `subs`."""
    for batch in batches:
        for doc, text, subs in zip(batch["doc_id"], batch["text"], batch["subs"], strict=True):
            own, subs = text.as_py().split("\n"), subs.values
            lines = pa.array([own[k & 0xFFFFFFFF] for k in subs.to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([doc.as_py()] * len(subs), pa.int64()), subs, lines], names=[*AT, "text"])


def _token_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    row, token = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.uint64)]
    for p in words.pieces(texts):
        order = np.lexsort((p.hash, p.text))
        text, value = p.text[order] + p.lo, p.hash[order]
        distinct = np.r_[True, (text[1:] != text[:-1]) | (value[1:] != value[:-1])][: len(text)]
        row.append(text[distinct])
        token.append(value[distinct])
    return np.concatenate(row), np.concatenate(token)


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The (doc_id, sub) of rows (doc_id, sub, text, other) whose texts are similar enough, on all their words."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            sides = [_token_sets(part[c]) for c in ("text", "other")]
            sizes = sum(np.bincount(row, minlength=part.num_rows) for row, _ in sides)
            row, token = (np.concatenate(c) for c in zip(*sides, strict=True))
            order = np.lexsort((token, row))
            row, token = row[order], token[order]
            both = np.bincount(row[1:][(row[1:] == row[:-1]) & (token[1:] == token[:-1])], minlength=part.num_rows)
            found = part.filter(pa.array(both * (OVER + UNDER) >= OVER * sizes))
            if found.num_rows:
                yield found.select(AT)


def _texts_of(lines: DataFrame, texts: DataFrame) -> DataFrame:
    """doc_id, sub, text of distinct ``lines`` (doc_id, sub), stored."""
    lines = stored(lines, "asked")
    part = F.shiftright("sub", 32)
    lists = lines.groupBy("doc_id", part.alias("part")).agg(F.sort_array(F.collect_list("sub")).alias("subs"))
    # A million numbers of lines are about 20 MB at most, with those of their documents.
    lists = F.broadcast(lists) if lines.count() <= 1_000_000 else lists
    known = texts.join(lists, ["doc_id", "part"]).select("doc_id", "text", "subs")
    return stored(known.mapInArrow(_asked, "doc_id long, sub long, text string"), "known")


def _verified(pairs: DataFrame, texts: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """The lines (doc_id, sub), stored, of ``pairs`` (doc_id, sub, other_id, other_sub) that are similar. Their texts
    are taken from ``known`` (doc_id, sub, text), or else looked up in ``texts``."""
    pairs = stored(pairs.distinct(), "pairs")
    asked = pairs.select(*AT).union(pairs.select("other_id", "other_sub")).distinct()
    known = _texts_of(asked, texts) if known is None else known.join(small(stored(asked, "asked")), AT, "left_semi")
    both = pairs.join(known, AT).join(known.toDF("other_id", "other_sub", "other"), ["other_id", "other_sub"])
    return stored(both.select(*AT, "text", "other").mapInArrow(_similar, "doc_id long, sub long").distinct(), "gone")


def _differ(columns: list[str]) -> Column:
    return reduce(Column.__add__, (F.bit_count(F.col(f"p.{c}").bitwiseXOR(F.col(f"q.{c}"))) for c in columns))


def _close() -> Column:
    """What two rows p and q of keys need to be like, q earlier: the exact filters, in the cheapest order."""
    n, m = F.shiftright("p.shape", PLACE), F.shiftright("q.shape", PLACE)
    place = [F.col(f"{x}.shape").bitwiseAND(F.lit((1 << PLACE) - 1)) for x in "pq"]
    folded = F.bit_count(reduce(Column.bitwiseXOR, (F.col(f"{x}.{c}") for x in "pq" for c in PARITY)))
    return (
        (UNDER * F.least(n, m) >= OVER * F.greatest(n, m))
        & ((n != m) | (n + m >= 2 * (OVER + UNDER)))
        & ((F.col("q.doc_id") < F.col("p.doc_id")) | ((F.col("q.doc_id") == F.col("p.doc_id")) & (F.col("q.sub") < F.col("p.sub"))))
        & (folded * (OVER + UNDER) <= n + m)
        & (F.greatest(*map(_differ, WIDE)) * (OVER + UNDER) <= n + m)
        & ((OVER + UNDER) * F.least(n - place[0], m - place[1]) >= OVER * (n + m))
    )


def _all_pairs(own: DataFrame, rows: DataFrame) -> DataFrame:
    """Pairs (doc_id, sub, other_id, other_sub, differ) of ``own`` rows and all earlier ones of ``rows`` with their keys
    that they can be like. Few rows are broadcast. Of more, the keys with many rows are dealt into parts, each of
    which meets the key's own rows."""
    if own.count() <= 100_000:
        pairs = rows.alias("q").join(F.broadcast(own.alias("p")), (F.col("p.key") == F.col("q.key")) & _close())
    else:
        sizes = rows.groupBy("key").agg(F.count("*").alias("k"))
        cuts = small(stored(sizes.select("key", F.ceil(F.col("k") / GROUP).cast("int").alias("cuts")), "sizes"))
        p = own.join(cuts, "key").withColumn("cut", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
        q = rows.join(cuts, "key").withColumn("cut", F.pmod(F.xxhash64(*AT), "cuts").cast("int"))
        pairs = q.alias("q").join(p.alias("p"), (F.col("p.key") == F.col("q.key")) & (F.col("p.cut") == F.col("q.cut")) & _close())
    return pairs.select("p.doc_id", "p.sub", F.col("q.doc_id").alias("other_id"), F.col("q.sub").alias("other_sub"), F.greatest(*map(_differ, WIDE)).alias("differ"))


def _compared(lines: DataFrame, rows: DataFrame, texts: DataFrame) -> DataFrame:
    """The (doc_id, sub) of ``lines`` (key, doc_id, sub) with a similar earlier line among the ``rows`` of their keys."""
    keys = small(stored(lines.select("key").distinct(), "keys"))
    near = stored(rows.join(keys, "key", "left_semi"), "asked_rows")
    known = _texts_of(near.select(*AT).distinct(), texts)
    wide = stored(known.mapInArrow(_widely, ", ".join(f"{c} long" for c in [*AT, *sum(WIDE, [])])), "wide")
    wide = small(wide, 100_000)
    near = stored(near.join(wide, AT), "near")
    own = stored(near.join(small(lines), ["key", *AT]), "own")

    # The nearest other of each line, and only for lines that it is unlike all others.
    nearest = F.min(F.struct("differ", "other_id", "other_sub")).alias("best")
    best = stored(_all_pairs(own, near).groupBy(*AT).agg(nearest, F.count("*").alias("n")), "nearest")
    gone = _verified(best.select(*AT, "best.other_id", "best.other_sub"), texts, known)
    left = stored(best.where("n > 1").select(*AT).join(small(gone), AT, "left_anti"), "unlike")
    if left.isEmpty():
        return gone
    rest = _all_pairs(stored(own.join(small(left), AT), "own"), near).drop("differ")
    return gone.unionByName(_verified(rest, texts, known))


@scoped
def similar_lines(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, part, line of the lines that are to be removed; lines are split at \\n and count from 0.

    ``docs`` needs doc_id and text; other columns are not read. A line is removed if an earlier one, in a
    smaller doc_id or above it, has a word set with intersection / union >= 4/5; the earlier one may itself be
    removed. Lines without a word, and so null and empty texts, are never removed. Rows with a null doc_id
    are left out. Rows with one doc_id and different texts are told apart, and ordered, by part; such with
    equal texts are one document. No documents give no rows. ``window`` bounds what is compared in passing,
    not what is found.
    """
    spark = docs.sparkSession
    texts = placed(docs.where(F.col("doc_id").isNotNull()))
    texts = texts.select("doc_id", "part", F.coalesce("text", F.lit("")).alias("text"))
    ranks = spark.sparkContext.broadcast(word_ranks(texts.select("text")))
    schema = "doc_id long, sub long, d1 long, d2 long, again boolean, p0 long, p1 long, p2 long, p3 long, size int, keys array<long>, places array<int>"
    described = stored(texts.mapInArrow(_described(ranks), schema), "lines")

    # Of documents with an equal line the first stands for all. A number is summed faster than two.
    single = texts.where("part <> 0").isEmpty()
    own = F.col("doc_id") if single else F.struct("doc_id", F.shiftright("sub", 32).alias("part"))
    new = described.where("not again")
    copied = new.groupBy("d1", "d2").agg(F.min(own).alias("first"), F.count("*").alias("k")).where("k > 1")
    copied = stored(copied, "copied")
    copies = joined(new.select(*AT, "d1", "d2"), copied, ["d1", "d2"]).where(own > F.col("first")).select(*AT)
    copies = stored(copies.unionByName(described.where("again").select(*AT)), "copies")

    few = small(copied.select("d1", "d2", "first"))
    rows = new.where(f"size >= {OVER}").join(few, ["d1", "d2"], "left").where(F.col("first").isNull() | (F.col("first") == own))
    rows = rows.select(*AT, *PARITY, "size", F.inline(F.arrays_zip("keys", "places")).alias("key", "place"))
    shape = F.shiftleft(F.col("size").cast("long"), PLACE) + F.col("place")
    rows = rows.select("key", "p0", shape.alias("shape"), *AT, *PARITY[1:])
    by_key = rows.repartition("key").sortWithinPartitions("key", "shape")
    schema = "doc_id long, sub long, other_id long, other_sub long, more boolean, key long"
    taken = stored(by_key.mapInArrow(_candidates(window, CHUNK_ROWS), schema), "taken")
    gone = _verified(taken.where("doc_id is not null").select(*AT, "other_id", "other_sub"), texts)

    # A key in which a line has one candidate, which was unlike, is done with.
    left = taken.where("more").select("key", *AT)
    crowded = stored(taken.where("doc_id is null").select("key").distinct(), "crowded")
    if not crowded.isEmpty():
        left = left.unionByName(rows.join(small(crowded), "key").select("key", *AT)).distinct()
    left = stored(left.join(small(gone), AT, "left_anti"), "left")
    if not left.isEmpty():
        gone = gone.unionByName(_compared(left, rows, texts))
    every = copies.unionByName(gone).distinct()
    return every.select("doc_id", F.shiftright("sub", 32).alias("part"), F.col("sub").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("line"))


def _by_document(lines: DataFrame, removed: Column) -> DataFrame:
    """doc_id, part and the aggregate ``removed`` of ``lines``, a stored table. It is broadcast if there are at most a million lines,
    about 20 MB, so that texts that it is joined to aren't shuffled."""
    lists = lines.groupBy("doc_id", "part").agg(removed)
    return F.broadcast(lists) if lines.count() <= 1_000_000 else lists


def removed_lines(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines (of all that \\n splits), n_removed, removed (line numbers, ascending) of every
    row; a null text has no line. Otherwise as ``similar_lines``."""
    gone = _by_document(similar_lines(docs), F.sort_array(F.collect_list("line")).alias("removed"))
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n", -1))).cast("long")
    every = placed(docs, n_lines.alias("n_lines")).join(gone, ["doc_id", "part"], "left")
    removed = F.coalesce("removed", F.array().cast("array<int>"))
    return every.select("doc_id", "n_lines", F.size(removed).cast("long").alias("n_removed"), removed.alias("removed"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch["text"].to_pylist()
        for k, removed in enumerate(batch["_removed"]):
            if removed.is_valid:
                gone = set(removed.as_py())
                texts[k] = "\n".join(x for i, x in enumerate(texts[k].split("\n")) if i not in gone)
        yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), *batch.columns[1:]], names=batch.schema.names)


def dedup(docs: DataFrame) -> DataFrame:
    """``docs``, all columns and rows, with the lines of ``similar_lines`` cut out of text."""
    gone = _by_document(similar_lines(docs), F.collect_list("line").alias("_removed"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("_row")
    every = placed(docs, row).join(gone, ["doc_id", "part"], "left").select("text", "_row", "_removed")
    every = every.mapInArrow(_cut, every.schema)
    return every.select(*[F.col("text") if c == "text" else F.col(f"_row.`{c}`") for c in docs.columns])
