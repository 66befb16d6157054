"""Packing of token sequences: sum-of-squares online packing into windows of a fixed length.

Every document is tokenised and ended with one id. Whole windows are cut from its front; what is
left goes, as it arrives, to the fill level for which the sum of the squares of the numbers of open
windows at each level becomes least. The numbers are kept in one array, indexed by level.

Each Spark task packs the rows of its own partition, without a shuffle. Its state is the level array
and the ids of the open windows; there are at most ``max_open`` of these. When there are more, and at
the end of the partition, the open windows are joined and cut anew into whole windows, so a partition
leaves at most one window that is not full.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annospark.llm import words

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
)
#: Pre-tokens whose ids a task remembers; beyond, it starts anew.
REMEMBERED = 600_000
PIECE_CHARS = 1 << 19
#: Fixed value: the pattern of byte-level pre-tokenizers.
PRE_TOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Tokens:
    """Ids of texts, by a ``tokenizers`` file, as arrays of unsigned 32-bit numbers.

    A byte-level model without a normaliser merges each pre-token on its own. So the pre-tokens of a
    piece of texts are cut and hashed as arrays, and only those not met before are merged. Texts that
    hold an added token, and files of any other kind, are encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()
        with open(path, encoding="utf-8") as f:
            about = json.load(f)
        before = about.get("pre_tokenizer") or {}
        self.added = [x["content"] for x in about.get("added_tokens", [])]
        self.ranks = None
        if about.get("normalizer") is None and before.get("type") == "ByteLevel":
            if before.get("use_regex", True) and not before.get("add_prefix_space"):
                self.ranks = _ranks(about["model"])
        if self.ranks:
            import tiktoken

            self.merge = tiktoken.Encoding("merge", pat_str=PRE_TOKEN, mergeable_ranks=self.ranks, special_tokens={})
            self.kind = _kinds()
        self._forget()

    def _forget(self) -> None:
        self.known: dict[int, int] = {}
        self.flat = np.zeros(1 << 16, dtype=np.uint32)
        self.start = np.zeros(1 << 12, dtype=np.int64)
        self.length = np.zeros(1 << 12, dtype=np.int64)
        self.used = 0

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        found: list = [None] * len(texts)
        plain: list[int] = []
        for i, text in enumerate(texts):
            if self.ranks is None or any(x in text for x in self.added):
                found[i] = np.asarray(self.model.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
            else:
                plain.append(i)
        at = 0
        while at < len(plain):
            upto, chars = at, 0
            while upto < len(plain) and (upto == at or chars < PIECE_CHARS):
                chars += len(texts[plain[upto]])
                upto += 1
            for i, ids in zip(plain[at:upto], self._piece([texts[i] for i in plain[at:upto]]), strict=True):
                found[i] = ids
            at = upto
        return found

    def _piece(self, texts: list[str]) -> list[np.ndarray]:
        joined = "".join(texts)
        if not joined:
            return [np.zeros(0, dtype=np.uint32)] * len(texts)
        code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        bounds = np.r_[0, np.cumsum([len(t) for t in texts])]
        start = np.flatnonzero(_starts(code, self.kind[code], bounds))
        place = np.arange(len(code)) - np.repeat(start, np.diff(np.r_[start, len(code)]))
        value = code.astype(np.uint64) * words.ODD[0] + words.ODD[1]
        value *= words.powers(int(place.max()) + 1)[place]
        number, first, which = np.unique(words.mix(np.add.reduceat(value, start)), return_index=True, return_inverse=True)
        if len(self.known) + len(number) > REMEMBERED:
            self._forget()
        known, end = self.known, np.r_[start[1:], len(code)]
        slot = np.fromiter((known.get(x, -1) for x in number.tolist()), dtype=np.int64, count=len(number))
        for i in np.flatnonzero(slot < 0).tolist():
            k = first[i]
            slot[i] = known[int(number[i])] = self._learn(self.merge.encode_ordinary(joined[start[k] : end[k]]))
        slot = slot[which]
        length = self.length[slot]
        upto = np.cumsum(length)
        ids = self.flat[np.repeat(self.start[slot] - upto + length, length) + np.arange(upto[-1])]
        cut = np.r_[0, upto][np.searchsorted(start, bounds)]
        return [ids[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]

    def _learn(self, ids: list[int]) -> int:
        slot, upto = len(self.known), self.used + len(ids)
        if upto > len(self.flat):
            self.flat = np.resize(self.flat, 2 * upto)
        if slot >= len(self.start):
            self.start, self.length = np.resize(self.start, 2 * slot), np.resize(self.length, 2 * slot)
        self.flat[self.used : upto] = ids
        self.start[slot], self.length[slot] = self.used, len(ids)
        self.used = upto
        return slot


def _ranks(model: dict) -> dict[bytes, int] | None:
    """Ranks of the byte strings, if a model's ids are in the order of its merges; else None."""
    if model.get("type") != "BPE" or model.get("dropout") or model.get("ignore_merges"):
        return None
    # The printable stand-ins of bytes in byte-level vocabularies: themselves, the rest from 256 on.
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    order = [model["vocab"][a + b] for a, b in merges]
    if any(a >= b for a, b in zip(order, order[1:])) or not set(byte) <= model["vocab"].keys():
        return None
    names = [*byte, *(a + b for a, b in merges)]
    return {bytes(byte[c] for c in x): model["vocab"][x] for x in names}


def _kinds() -> np.ndarray:
    """For each code point 0 white space, 1 letter, 2 number, 3 other."""
    import regex

    every = "".join(map(chr, range(0x110000)))
    kind = np.full(0x110000, 3, dtype=np.uint8)
    for k, pattern in enumerate((r"\s+", r"\p{L}+", r"\p{N}+")):
        for m in regex.finditer(pattern, every):
            kind[m.start() : m.end()] = k
    return kind


def _starts(code: np.ndarray, kind: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where the pre-tokens of ``PRE_TOKEN`` begin in texts that lie one after another."""
    edge = np.zeros(len(code) + 1, dtype=bool)
    edge[bounds] = True
    text = edge.copy()  # where texts begin, and the end
    edge[1:-1] |= kind[1:] != kind[:-1]
    edge = edge[:-1]
    # The last of the white space before a word stands alone or, if it is a space, opens the word.
    word = np.flatnonzero(edge & (kind != 0) & ~text[:-1])
    word = word[kind[word - 1] == 0]
    edge[word - 1] = True
    edge[word[code[word - 1] == 32]] = False
    # An apostrophe that opens a pre-token takes s, t, m, d, re, ve or ll from the letters after it.
    mark = np.flatnonzero(edge & (code == 39))
    follow = np.r_[code, 0, 0]
    one = mark[~text[mark + 1] & np.isin(follow[mark + 1], [115, 116, 109, 100])]
    pair = follow[mark + 1].astype(np.int64) * 1000 + follow[mark + 2]
    two = mark[~text[mark + 1] & np.isin(pair, [114101, 118101, 108108])]
    two = two[~text[two + 2]]
    for at, n in ((one, 2), (two, 3)):
        edge[at + 1] = False
        edge[(at + n)[at + n < len(code)]] = True
    return edge


class SumOfSquares:
    """Open windows of ``size`` ids. ``place`` and ``finish`` yield closed windows, each a list of
    pieces (document, start, ids)."""

    def __init__(self, size: int, max_open: int):
        self.size, self.max_open = size, max_open
        self.count = np.zeros(size, dtype=np.int64)  # open windows at each level; none at level 0
        self.open: list[list[list]] = [[] for _ in range(size)]
        self.n = 0

    def place(self, piece: tuple) -> Iterator[list]:
        k = len(piece[2]) // 4
        # From level h to h + k the sum changes by 2 * (count[h + k] - count[h] + 1); a new window
        # takes nothing from a level, and a full one adds nothing to any.
        change = np.full(self.size - k + 1, 3 * self.n + 3, dtype=np.int64)
        change[:-1] = 2 * self.count[k:]
        change[-1] = 0
        change[1:] += np.where(self.count[1 : self.size - k + 1] > 0, 1 - 2 * self.count[1 : self.size - k + 1], 4 * self.n + 4)
        change[1:-1] += 1
        change[0] += 1
        level = int(change.argmin())
        window = self.open[level].pop() if level else []
        if level:
            self.count[level] -= 1
            self.n -= 1
        window.append(piece)
        if level + k == self.size:
            yield window
        else:
            self._keep(window, level + k)
            if self.n > self.max_open:
                yield from self.finish(False)

    def _keep(self, window: list, level: int) -> None:
        self.open[level].append(window)
        self.count[level] += 1
        self.n += 1

    def finish(self, last: bool = True) -> Iterator[list]:
        """Join what is open and cut it into whole windows; the rest is yielded if ``last``."""
        left, level = [], 0
        for windows in self.open:
            for window in windows:
                for doc, start, ids in window:
                    while ids:
                        part = ids[: 4 * (self.size - level)]
                        left.append((doc, start, part))
                        level += len(part) // 4
                        start += len(part) // 4
                        ids = ids[len(part) :]
                        if level == self.size:
                            yield left
                            left, level = [], 0
            windows.clear()
        self.count[:] = 0
        self.n = 0
        if left and last:
            yield left
        elif left:
            self._keep(left, level)


def pack(
    docs: DataFrame, tokenizer: str, size: int = 1024, end_id: int = 0, max_open: int = 2048, keep_ids: bool = True
) -> DataFrame:
    """Pieces of documents in packed sequences, columns of ``SCHEMA`` (``ids`` only if ``keep_ids``).

    ``docs`` needs doc_id and text. ``tokenizer`` is the path of a ``tokenizers`` file that every
    executor can read. A null or empty text has only the end id. Rows with the same doc_id, or a null
    one, are packed as documents of their own. Other columns of ``docs`` are not read. No document
    gives no row. A sequence has at most ``size`` ids; its pieces follow each other from offset 0.
    The number of a sequence is made of the partition's number and a count, so a task that runs again
    gives the same rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, packer = Tokens(tokenizer), SumOfSquares(size, max_open)
        end = np.asarray([end_id], dtype="<u4").tobytes()
        number = TaskContext.get().partitionId() << 33
        rows: list[tuple] = []

        def closed(windows) -> None:
            nonlocal number
            for window in windows:
                at = 0
                for (doc, total), start, ids in window:
                    n = len(ids) // 4
                    rows.append((doc, start, n, zlib.crc32(ids), total, number, at, ids if keep_ids else None))
                    at += n
                number += 1

        def table() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            rows.clear()
            types = [pa.int64()] * 7 + [pa.binary()]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
            kept = names if keep_ids else names[:7]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t, _ in zip(columns, types, kept)], names=kept)

        for batch in batches:
            texts = batch["text"].to_pylist()
            for doc, ids in zip(batch["doc_id"].to_pylist(), tokens.encode(texts), strict=True):
                ids = ids.tobytes() + end
                total = len(ids) // 4
                whole = total - total % size
                for start in range(0, whole, size):
                    closed([[((doc, total), start, ids[4 * start : 4 * (start + size)])]])
                if whole < total:
                    closed(packer.place(((doc, total), whole, ids[4 * whole :])))
                if len(rows) >= 4096:
                    yield table()
        closed(packer.finish())
        if rows:
            yield table()

    schema = SCHEMA if keep_ids else SCHEMA.removesuffix(", ids binary")
    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, schema)
