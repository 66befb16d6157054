"""Words and word shingles of whole texts as 64-bit numbers, for a batch of texts at once.

A word is a run of bytes other than the six ASCII white-space characters; A-Z may be lower-cased.
A batch is handled in pieces of a quarter of a megabyte (at least one text), so the arrays stay small
whatever the batch holds. Everything here is a function of the text alone, the same in any process.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

U = np.uint64
PIECE_BYTES = 1 << 18
#: Texts in a piece: sets() puts the number of the text into the upper bits of a sort key.
PIECE_TEXTS = 1024
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, *range(9, 14)]] = True

_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
_BYTE[SPACE] = 0
_LOWER = _BYTE.copy()
_LOWER[65:91] = _BYTE[97:123]
ODD = _rng.integers(1, 2**63, 64, dtype=np.uint64) * U(2) + U(1)
_STEP = int(ODD[0])
_BACK = pow(_STEP, -1, 1 << 64)
#: Longer lists of powers, for longer texts, are not kept.
_KEPT = 1 << 20
_known: dict[int, np.ndarray] = {}


def powers(n: int, base: int = _STEP) -> np.ndarray:
    """The first powers of ``base`` modulo 2**64, ``n`` at least."""
    found = _known.get(base)
    if found is None or len(found) < n:
        size = max(1024, n if n > _KEPT else 2 * n)
        found = np.multiply.accumulate(np.r_[U(1), np.full(size - 1, base, dtype=np.uint64)])
        if size <= 2 * _KEPT:
            _known[base] = found
    return found


def mix(x: np.ndarray) -> np.ndarray:
    """Spread each number over all 64 bits (in place where ``x`` is a fresh array)."""
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


class Piece(NamedTuple):
    """Words of the texts lo..hi of a batch; byte offsets count from the start of ``data``."""

    lo: int
    hi: int
    data: np.ndarray
    bounds: np.ndarray  # byte offsets of the texts, hi - lo + 1
    text: np.ndarray  # of each word, from 0
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray


def pieces(texts: pa.Array, lower: bool = True) -> Iterator[Piece]:
    """The words of ``texts`` (no nulls), piece by piece, every text whole."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    n = len(texts)
    if not n:
        return
    if not pa.types.is_string(texts.type):
        texts = texts.cast(pa.large_string())
    kind = np.int32 if pa.types.is_string(texts.type) else np.int64
    offsets = np.frombuffer(texts.buffers()[1], dtype=kind)[texts.offset : texts.offset + n + 1].astype(np.int64)
    body = texts.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + PIECE_BYTES, side="right")) - 1
        hi = min(max(hi, lo + 1), lo + PIECE_TEXTS, n)
        yield _piece(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], lo, hi, lower)
        lo = hi
    pa.default_memory_pool().release_unused()


def _piece(data: np.ndarray, bounds: np.ndarray, lo: int, hi: int, lower: bool) -> Piece:
    word = ~SPACE[data]
    first = word.copy()
    last = word.copy()
    if len(data):
        inner = bounds[(bounds > 0) & (bounds < len(data))]
        edge = np.ones(len(data) + 1, dtype=bool)
        edge[1:-1] = ~word[:-1]
        edge[inner] = True
        first &= edge[:-1]
        after = np.ones(len(data), dtype=bool)
        after[:-1] = ~word[1:]
        after[inner - 1] = True
        last &= after
    start = np.flatnonzero(first)
    end = np.flatnonzero(last) + 1
    if not len(start):
        none = np.zeros(0, dtype=np.int64)
        return Piece(lo, hi, data, bounds, none, none, none, np.zeros(0, dtype=np.uint64))
    # A word's numbers: its bytes' numbers times a power of their place, summed modulo 2**64. The powers count
    # from the start of the piece in the sum, and from that of the word after it is divided by the first of them.
    value = (_LOWER if lower else _BYTE)[data]
    value *= powers(len(data))[: len(data)]
    upto = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(value, out=upto[1:])
    hashed = upto[end] - upto[start]
    hashed *= powers(len(data), _BACK)[start]
    hashed = mix(hashed)
    text = np.searchsorted(bounds, start, side="right") - 1
    return Piece(lo, hi, data, bounds, text, start, end, hashed)


def shingles(p: Piece, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, number) of every run of ``width`` words, in order; a text with fewer words gives one
    shingle, its whole sequence, and a text without words none."""
    n = len(p.hash)
    count = np.bincount(p.text, minlength=p.hi - p.lo)
    full = max(n - width + 1, 0)
    number = np.full(full, 0, dtype=np.uint64) + ODD[1:2] * U(width)
    for k in range(width):
        number += p.hash[k : k + full] * ODD[2 + k % 60]
    whole = p.text[:full] == p.text[width - 1 : width - 1 + full]
    text, number = p.text[:full][whole], mix(number[whole])
    short = np.flatnonzero((count > 0) & (count < width))
    if len(short):
        begin = np.cumsum(count) - count
        own = np.zeros(len(short), dtype=np.uint64)
        for k in range(width - 1):
            has = count[short] > k
            own[has] += p.hash[begin[short[has]] + k] * ODD[2 + k % 60]
        own += ODD[1] * count[short].astype(np.uint64)
        text, number = np.r_[text, short], np.r_[number, mix(own)]
    return text, number


def sets(text: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, element) of the distinct numbers of each text, sorted by text and element. Elements
    keep 54 bits of their number."""
    key = number >> U(10)
    key |= text.astype(np.uint64) << U(54)
    key.sort()
    if len(key):
        key = key[np.r_[True, key[1:] != key[:-1]]]
    return (key >> U(54)).astype(np.int64), key & U((1 << 54) - 1)


def runs(number: np.ndarray, width: int) -> np.ndarray:
    """Number of each run of ``width`` consecutive numbers, by doubling; runs cross texts."""
    done, found, block, size, level = 0, None, number, 1, 0
    while size <= width:
        if width & size:
            part = block[done:]
            found = part * ODD[3] if found is None else found[: len(part)] * ODD[4 + level] + part[: len(found)]
            done += size
        if 2 * size <= width:
            block = block[: max(len(block) - size, 0)] + block[size:] * ODD[20 + level]
        size, level = 2 * size, level + 1
    return mix(found[: max(len(number) - width + 1, 0)].copy())


def sliding(value: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (np.minimum or np.maximum) over each run of ``width`` consecutive values."""
    size = 1
    while 2 * size <= width:
        value = pick(value[: max(len(value) - size, 0)], value[size:])
        size *= 2
    rest = width - size
    return pick(value[: max(len(value) - rest, 0)], value[rest:]) if rest else value


def code_points(p: Piece) -> np.ndarray:
    """For each byte offset of a piece, the code points before it."""
    lead = np.zeros(len(p.data) + 1, dtype=np.int64)
    np.cumsum((p.data & 0xC0) != 0x80, out=lead[1:])
    return lead
