import random
import re

import pytest

from annospark.llm import entries, passages

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lines_and_paragraphs(text):
    """(kind, first word, words) of the lines, and of the paragraphs of several lines."""
    count, open_, found = 0, [], []
    for line in [*text.split("\n"), ""]:
        n = len(WORD.findall(line))
        if n:
            found.append(("line", count, n))
            open_.append(n)
            count += n
        elif open_:
            if len(open_) > 1:
                found.append(("paragraph", count - sum(open_), sum(open_)))
            open_ = []
    return found


def brute(docs, unit, least):
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    first, units, texts, blocks = {}, {}, {}, {}
    for doc, text in sorted(docs.items()):
        spans = [m.span() for m in WORD.finditer(text or "")]
        names = [text[a:b].translate(low) for a, b in spans]
        units[doc] = spans, names
        for i in range(len(names) - unit + 1):
            first.setdefault(tuple(names[i : i + unit]), (doc, i))
        for kind, i, n in sorted(lines_and_paragraphs(text or ""), key=lambda x: (x[1], x[0] == "line")):
            if n >= least:
                blocks.setdefault(tuple(names[i : i + n]), (doc, i))
    found = set()
    for doc, (spans, names) in units.items():
        same = texts.setdefault(docs[doc], doc)
        if same != doc and len(names) >= least:
            found.add((doc, spans[0][0], spans[-1][1], len(spans), same, "text"))
        if same != doc:
            continue
        whole, gone = [], set()
        for kind, i, n in sorted(lines_and_paragraphs(docs[doc] or ""), key=lambda x: -len(x[0])):
            key = tuple(names[i : i + n])
            if n >= least and blocks[key] != (doc, i) and not any(a <= i and i + n <= b for a, b in whole):
                whole += [(i, i + n)] if kind == "paragraph" else []
                gone |= set(range(i, i + n))
                found.add((doc, spans[i][0], spans[i + n - 1][1], n, blocks[key][0], kind))
        own = [tuple(names[i : i + unit]) for i in range(len(names) - unit + 1)]
        at = [i for i, u in enumerate(own) if first[u][0] != doc or i >= first[u][1] + unit]
        while at:
            k = 1
            while k < len(at) and at[k] - at[k - 1] <= unit:
                k += 1
            run, at = at[:k], at[k:]
            if not set(range(run[0], run[-1] + unit)) <= gone:
                found.add((doc, spans[run[0]][0], spans[run[-1] + unit - 1][1], run[-1] - run[0] + unit, first[own[run[0]]][0], "passage"))
    return found


def test_against_brute_force(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = entries.op3_passages(spark, sf).collect()
    assert {tuple(r) for r in rows} == brute(docs, passages.UNIT, passages.LEAST)
    assert {r.unit for r in rows} >= {"line", "passage", "text"}


@pytest.mark.parametrize("least", [2, 8])
def test_small_units(spark, least):
    rng = random.Random(5)
    docs = {i: " ".join(rng.choices("aBcdé", k=rng.randint(0, 40))) for i in range(120)}
    for i in range(200, 300):  # lines and paragraphs, some of them in other documents
        docs[i] = "".join(rng.choice([" ".join(rng.choices("xyz", k=rng.randint(1, 3))), *(f"Line {k} of nine words or more that repeats" for k in range(9))]) + rng.choice(["\n", "\n", "\n \n"]) for _ in range(8))
    docs |= {500: None, 501: "", 502: "x " * 300, 503: "\t".join("x" * 9), 504: docs[200], 505: docs[200], 506: "q " * 100_000}
    df = spark.createDataFrame([(k, t, "clash") for k, t in docs.items()], "doc_id long, text string, digest string")
    spans = passages.repeated(df, unit=8, least=least)
    rows = spans.drop("part").collect()
    assert {tuple(r) for r in rows} == brute(docs, 8, least) and len(rows) == len(set(rows))
    assert {r.unit for r in rows} == set(passages.KINDS)
    removed = {r.doc_id: r for r in passages.remove(df, spans).collect()}
    assert removed.keys() == docs.keys() and removed[500].text is None and removed[501].text == "" and removed[1].digest == "clash"
    for doc, r in removed.items():
        gone = set().union(*(range(s, e) for s, e in r.removed))
        assert r.text == (None if docs[doc] is None else "".join(c for i, c in enumerate(docs[doc]) if i not in gone))
    assert passages.repeated(df.limit(0), unit=8).count() == 0


def test_repeated_and_null_ids(spark):
    line = "one two three four five six seven eight"
    rows = [(1, f"{line}\nown a b"), (1, "other text of this id"), (1, f"x\n{line} nine"), (1, f"{line}\nown a b"), (None, line), (2, line)]
    spans = passages.repeated(spark.createDataFrame(rows, "doc_id long, text string"), unit=8, least=8)
    found = sorted((r.doc_id, r.start, r.end, r.kept_doc_id) for r in spans.collect())
    # Of the texts of doc_id 1 that have the line, one is first; equal rows are one place.
    assert found[-1] == (2, 0, len(line), 1) and len(found) == 2 and found[0][0] == 1
    texts = [r.text for r in passages.remove(spark.createDataFrame(rows, "doc_id long, text string"), spans).collect()]
    assert len(texts) == 6 and "other text of this id" in texts and "" in texts and line in texts
