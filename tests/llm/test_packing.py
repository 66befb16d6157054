import random
import zlib
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

from annospark.llm import entries, packing


def _check(rows, texts, size, end_id, path):
    model = Tokenizer.from_file(path)
    ids = {k: model.encode(t or "", add_special_tokens=False).ids + [end_id] for k, t in texts.items()}
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        windows[r.sequence_id].append(r)
    assert pieces.keys() == ids.keys()
    for k, found in pieces.items():
        at = 0
        for r in sorted(found, key=lambda r: r.start):
            own = np.asarray(ids[k][at : at + r.length], dtype="<u4").tobytes()
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids[k]), zlib.crc32(own))
            at += r.length
        assert at == len(ids[k])
    for found in windows.values():
        at = 0
        for r in sorted(found, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= size
    return len(windows), sum(map(len, ids.values()))


def test_round_trip(spark, sf):
    path = entries.tokenizer_path()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = entries.op8_packing(spark, sf).collect()
    n, total = _check(rows, texts, 1024, 0, path)
    assert (n - 1) * 1024 <= total  # one partition: all windows but one are full


def test_small_windows_and_odd_rows(spark):
    path = entries.tokenizer_path()
    rng = random.Random(3)
    texts = {i: " ".join(rng.choices(["a", "it's", "\n\n", "<|endoftext|>", "é", "12"], k=rng.randint(0, 60))) for i in range(300)}
    texts |= {1000: None, 1001: "", 1002: "x" * 50_000}
    docs = spark.createDataFrame([(k, t, k, "s") for k, t in texts.items()], "doc_id long, text string, length long, start string")
    for max_open in (0, 3, 64):
        out = packing.pack(docs.repartition(3), path, size=16, max_open=max_open)
        assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 for r in out.collect())
        n, total = _check(out.collect(), texts, 16, 0, path)
        assert n * 16 - total < 3 * 16
    assert packing.pack(docs.limit(0), path).count() == 0


def test_level_choice():
    packer = packing.SumOfSquares(10, 100)
    for doc, k in enumerate((4, 4, 3)):
        assert not list(packer.place((doc, 0, b"1234" * k)))
    # The second 4 joins the first: two windows at level 4 would give the larger sum.
    assert list(np.flatnonzero(packer.count)) == [3, 8] and packer.n == 2
    assert [[d for d, _, _ in w] for w in packer.place((9, 0, b"1234" * 2))] == [[0, 1, 9]]
    assert list(np.flatnonzero(packer.count)) == [3] and packer.n == 1


def test_same_ids_as_the_tokenizer():
    path = entries.tokenizer_path()
    model, tokens, rng = Tokenizer.from_file(path), packing.Tokens(path), random.Random(1)
    letters = list("ab1 '  \n\t stmdrevl.,é 　٣Ⅷ😀\x1c\x85<|") + ["'ll", "'re", " 's", "<|endoftext|>"]
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 30))) for _ in range(3000)]
    for text, ids in zip(texts, tokens.encode(texts), strict=True):
        assert ids.tolist() == model.encode(text, add_special_tokens=False).ids
