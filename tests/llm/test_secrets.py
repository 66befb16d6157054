import hashlib
import random
import re
import string
import time

from annospark.llm import entries, secrets

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]+")


def base(text):
    spans = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text or "") if len(m[2]) >= 8]
    spans += [(m.start(), 1, m.end(), "access") for m in ACCESS.finditer(text or "") if len(m[0]) >= 16]
    spans += [(m.start(), 2, m.end(), "hex") for m in HEX.finditer(text or "") if len(m[0]) >= 32]
    return [f"{k}:{s}:{e}" for s, _, e, k in sorted(spans)]


def test_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = 0
    for r in entries.op5_secrets(spark, sf).collect():
        want = base(docs[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(x.startswith(k) for x in want) for k in ("assign", "access", "hex")]
        assert [x for x in r.spans.split(",") if x and not x.startswith("markov")] == want
        assert r.spans.count("markov") == r.n_markov
        found += len(want)
    assert found > 3


RUN = re.compile(r"[A-Za-z0-9+/_=-]+")


def markov(text, model):
    """The runs that are random by ``model`` and overlap no span of ``base``."""
    taken = [tuple(map(int, x.split(":")[1:])) for x in base(text)]
    found = []
    for m in RUN.finditer(text or ""):
        pairs = [secrets.ALPHABET.index(a) * len(secrets.ALPHABET) + secrets.ALPHABET.index(b) for a, b in zip(m[0], m[0][1:])]
        if len(m[0]) >= 16 and not any(s < m.end() and e > m.start() for s, e in taken):
            if sum(model.ratios[k] for k in pairs) / len(pairs) >= model.cut:
                found.append(m.span())
    return found


def planted(n):
    """Random strings of the kinds that keys have, and identifiers as programs have them."""
    rng = random.Random(8)
    base64 = string.ascii_letters + string.digits + "+/"
    kinds = [(base64, 40), (string.ascii_letters + string.digits, 24), ("0123456789ABCDEF", 32), (string.ascii_uppercase + string.digits, 20), ("0123456789abcdef", 30)]
    words = "get set value index user name request handler parse config table column row string buffer stream".split()
    keys, names = [], []
    for i in range(n):
        letters, size = kinds[i % len(kinds)]
        keys.append("".join(rng.choices(letters, k=size)))
        parts = rng.choices(words, k=5)
        names.append("_".join(parts) if i % 2 else "".join(x.capitalize() for x in parts))
    return keys, names


def test_models_find_planted_strings(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    keys, names = planted(400)
    rows = [(10**6 + i, f"the {k} of {n} and so on") for i, (k, n) in enumerate(zip(keys, names))]
    code = [(2 * 10**6 + i, " ".join(planted(60)[1])) for i in range(4)]
    every = docs.select("doc_id", "text").union(spark.createDataFrame(rows + code, "doc_id long, text string"))
    model = secrets.train(docs.select("doc_id", "text").union(spark.createDataFrame(code, "doc_id long, text string")), max_documents=5000)
    texts = {r.doc_id: r.text for r in every.collect()}
    hit = false = 0
    for r in secrets.scan(every, model).collect():
        found = [tuple(x) for x in r.markov]
        assert found == markov(texts[r.doc_id], model)
        if 10**6 <= r.doc_id < 2 * 10**6:
            text, key = texts[r.doc_id], keys[r.doc_id - 10**6]
            hit += any(text[a:b] == key for a, b in found)
            false += any(text[a:b] != key for a, b in found)
    assert hit >= 0.95 * len(keys) and false <= 0.02 * len(names)


def test_long_dense_text_in_time(spark, sf):
    """Time grows about as the matches do."""
    model = secrets.Model([0.0] * len(secrets.ALPHABET) ** 2, 0.5)
    unit = "password: longenough1 " + "z" * 17 + " " + "0123456789abcdef" * 2 + "\n"
    seconds = []
    for n in (2_000, 2_000, 16_000):
        began = time.time()
        r = secrets.scan(spark.createDataFrame([(1, unit * n)], "doc_id long, text string"), model).selectExpr("size(assign) a", "size(hex) h", "assign[size(assign) - 1].end e").first()
        seconds.append(time.time() - began)
        assert (r.a, r.h) == (n, n) and r.e == len(unit) * n - 52
    assert seconds[2] < 24 * max(seconds[1], 0.2)


def test_markov_and_odd_rows(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = secrets.train(docs)
    key, plain = "q7Zp0XvK2mWd9RtLs4Hy8BnC", "thisisjustalongwordoftheusualkind"
    texts = [None, "", f"é {key} x", plain, f"token = '{key}'", "token=ab: secret=abcdefgh1", "AKIA" * 9, "f" * 40 + "g" + "0" * 31,
             "password:x password: longenough1 " * 300, "a" * 100_000]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(2, "", 1), (None, "b", 1)], "doc_id long, text string, assign int")
    out = secrets.scan(df, model).select("doc_id", secrets.joined(secrets.KINDS).alias("s"), "markov", "n_random").collect()
    assert len(out) == 12
    for r in out[:10]:
        assert [x for x in r.s.split(",") if x and not x.startswith("markov")] == base(texts[r.doc_id])
    assert [tuple(x) for x in out[2].markov] == [(2, 2 + len(key))]
    assert not out[3].markov and not out[4].markov and out[0].s == out[1].s == ""
    assert secrets.scan(df.limit(0), model).count() == 0
    none = secrets.train(df.limit(0))
    assert none.cut == secrets.NO_CUT and len(none.ratios) == len(secrets.ALPHABET) ** 2
    assert out[5].n_random == 0 or out[5].n_random <= 1
