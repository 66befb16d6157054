import datetime
import json

import pytest
from pyspark.sql import functions as F

from annospark.functions import json_text, judgement
from annospark.operators import paths
from annospark.plans import fixtures
from annospark.sources import io, listing
from annospark.streaming import incremental

TEXTS = [
    '{"a":1}', ' {"a" : 1}\t', '{"a":1} done', '{"a":1}]', '{"a":1}}', '{"a":1},{"a":2}', '{"a":1}{"a":2}', "", "  ", "[1,2]", "3", '"x"', "null", "true",
    '{"a":"\t"}', "{'a':1}", '{"a":1,}', "﻿{}", "01", "1.", "1]", '{"x":1},"y":2', '1,"y":1}', '1,"y":1', "[1", "tru", '{"a":"\\u00e9\\ud83d\\ude00"}', '{"a":[{}]}', "[]]", "nan", '{"a":NaN}', "-Infinity",
]


def test_strict_json(spark):
    """The same texts as the standard library takes for JSON."""

    def strict(text):
        try:
            json.loads(text.strip())
            return True
        except ValueError:
            return False

    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    told = {r.t: r.p for r in df.select("t", json_text.problem(F.col("t")).alias("p")).collect()}
    assert {t: p != "not_json" for t, p in told.items()} == {t: strict(t) for t in TEXTS}
    assert [t for t, p in told.items() if p == "not_a_number"] == ['{"a":NaN}', "-Infinity"]
    twice = spark.createDataFrame([('{"a":1,"a":2}',), ('{"a":[{"b":1,"b":1}]}',), ('{"a":1,"b":{"a":1}}',), (None,)], "t string")
    assert [r[0] for r in twice.select(json_text.problem(F.col("t"))).collect()] == ["repeated_key", "repeated_key", None, "not_json"]


def test_native_judgements(spark):
    """The native description gives the strict parse's errors, but for repeated keys."""
    raw = spark.createDataFrame([(i, json.dumps(x) if not isinstance(x, str) else x) for i, x in enumerate(_judgements())], "i int, raw string")
    labels = spark.createDataFrame([("REAL",), ("AI-GENERATED",), ("other",)], "label string")
    both = raw.join(labels, how="cross").withColumns({"s": judgement.describe(F.col("raw")), "n": judgement.describe_native(F.col("raw"))})
    coded = lambda c: F.transform(judgement.errors(c, F.col("label")), lambda e: F.split_part(e, F.lit(":"), F.lit(1)))
    rows = both.select("i", "label", "raw", coded("s").alias("s"), coded("n").alias("n")).collect()
    assert [(r.raw, r.s, r.n) for r in rows if r.s != r.n and '"evidence": "e", "evidence"' not in r.raw] == []
    differ = [r for r in rows if r.s != r.n]
    assert differ and all(r.n == ["json_parse_error"] for r in differ)
    assert len({tuple(r.s) for r in rows}) > 20


def _judgements():
    good = {"per_criterion": [{"criterion": c, "evidence": "e", "aigc score": i % 2} for i, c in enumerate(judgement.CRITERIA)], "overall_likelihood": "AI-Generated"}

    def changed(**item):
        own = json.loads(json.dumps(good))
        own["per_criterion"][2] |= item
        return own

    yield good
    yield good | {"overall_likelihood": "Real"}
    yield {k: good[k] for k in reversed(good)}
    for score in (True, 1.0, 2, -1, "1", None, [], {"x": 1}, 10**25, 1e300, 0.5):
        yield changed(**{"aigc score": score})
    for evidence in ("", "  ", None, 5, ["x"], "é\U0001f600"):
        yield changed(evidence=evidence)
    yield changed(extra=1)
    yield changed(criterion="Wrong")
    for items in ([], [1, None, "x", [], True, 1.5, {}, {"a": {"b": []}}], None, "x", {}, good["per_criterion"][:7], good["per_criterion"] * 2):
        yield good | {"per_criterion": items}
    for overall in ("Uncertain", "", None, 3, {}, ["Real"]):
        yield good | {"overall_likelihood": overall}
    yield from ({}, [], 3, "plain", '"text"', {"other": 1}, "", "null")
    text = json.dumps(good)
    yield from (text + " done", "so: " + text, "\n" + text + "\r\n", text[:-1], text.replace('"aigc score": 0', '"aigc score": 1.0', 1), text.replace('"aigc score": 0', '"aigc score": 1e0', 1))
    yield text.replace('"evidence": "e"', '"evidence": "e", "evidence": "f"', 1)


def test_jsonl_strict(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"a": 1}\n\n{"a": 2} x\n  {"a": 3, "b": 1}\n{"a": 4,\n{"a": 5, "a": 6}\n')
    read = lambda **k: io.read_jsonl_strict(spark, f"{tmp_path}/a.jsonl", "a int", **k)
    with pytest.raises(ValueError, match=r"not_json in file:.*a\.jsonl:3"):
        read()
    assert sorted(r.a for r in read(quarantine=f"{tmp_path}/bad").collect()) == [1, 3, 6]
    bad = spark.read.json(f"{tmp_path}/bad").orderBy("line").collect()
    assert [(r.line, r.problem, r.raw) for r in bad] == [(3, "not_json", '{"a": 2} x'), (5, "not_json", '{"a": 4,')]
    assert sorted(r.a for r in read(quarantine=f"{tmp_path}/bad2", unique_keys=True).collect()) == [1, 3]
    assert io.read_jsonl_strict(spark, f"{tmp_path}/none", "a int").count() == 0


def test_line_numbers_of_split_files(spark, tmp_path):
    """Files that many tasks read, and many small files in one task."""
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "large").write_text("".join(f"large {i}\n" for i in range(1, 120_001)))
    for k in range(40):
        (tmp_path / "t" / f"f{k}").write_text("".join(f"f{k} {i}\n" for i in range(1, k + 1)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        for rows in (io.text_lines(spark, f"{tmp_path}/t"), io.text_lines(spark, f"{tmp_path}/t", max_dim_rows=3)):
            assert rows.where(F.concat_ws(" ", F.element_at(F.split("file", "/"), -1), "line") != F.col("value")).count() == 0
            assert rows.count() == 120_000 + 40 * 39 // 2
        assert io.text_lines(spark, f"{tmp_path}/t").rdd.getNumPartitions() > 8
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_offsets_of_many_files(spark, tmp_path):
    """The plan is the same for few and for many files; so are the indices, broadcast or not."""
    spark.range(2000).repartition(2).write.parquet(f"{tmp_path}/few")
    spark.range(3000).repartition(600).write.parquet(f"{tmp_path}/many")
    sizes = []
    for name in ("few", "many"):
        rows = io.read_splits(spark, {name: f"{tmp_path}/{name}"})
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        sizes.append(len(plan.replace(str(tmp_path), "")))
        for found in (rows, io.read_splits(spark, {name: f"{tmp_path}/{name}"}, max_dim_rows=1)):
            numbers = sorted(r.global_index for r in found.select("global_index").collect())
            assert numbers == list(range(len(numbers))) and len(numbers) == {"few": 2000, "many": 3000}[name]
    assert abs(sizes[0] - sizes[1]) < 400
    both = io.read_splits(spark, {"x": f"{tmp_path}/many", "y": f"{tmp_path}/few"}, ["id"])
    edges = both.groupBy("split").agg(F.min("global_index"), F.max("global_index"), F.max("split_index")).orderBy("split").collect()
    assert [tuple(r) for r in edges] == [("x", 0, 2999, 2999), ("y", 3000, 4999, 1999)]
    order = {r.global_index: r.id for r in both.where("split = 'x'").collect()}
    by_file = spark.read.parquet(f"{tmp_path}/many").select("id", "_metadata.file_path", "_metadata.row_index").orderBy("file_path", "row_index").collect()
    assert [order[i] for i in range(3000)] == [r.id for r in by_file]


@pytest.mark.parametrize("levels", [1, 3])
def test_directories_without_files(spark, tmp_path, levels):
    for d in ("Real/deep/er", "fake-", "empty/inner", "Real/none"):
        (tmp_path / d).mkdir(parents=True)
    for f in ("top.png", "Real/a.JPG", "Real/deep/er/b.webp", "Real/deep/er/c.txt", "fake-/d.bmp"):
        (tmp_path / f).write_bytes(b"12")
    seen = listing.tree(spark, str(tmp_path), levels)
    assert seen.where("not is_directory").agg(F.sum("length")).first()[0] == 10 and seen.count() == 12
    counted = paths.every_directory(listing.directories(seen), listing.images(seen))
    found = {r.directory: (r.normal, r.n_direct, r.n_recursive) for r in counted.collect()}
    assert found == {
        "": ("", 1, 4), "Real": ("real", 1, 2), "Real/deep": ("deep", 0, 1), "Real/deep/er": ("er", 1, 1), "Real/none": ("none", 0, 0),
        "fake-": ("fake", 1, 1), "empty": ("empty", 0, 0), "empty/inner": ("inner", 0, 0),
    }
    assert seen.rdd.getNumPartitions() >= 4
    with pytest.raises(Exception, match="(?i)not found|no such|does not exist|FileNotFound"):
        listing.tree(spark, f"{tmp_path}/missing").count()


def test_ingest_resumes_and_keeps_bad_lines(spark, tmp_path):
    (tmp_path / "log").mkdir()
    run = lambda: incremental.ingest(incremental.line_stream(spark, f"{tmp_path}/log"), "id string, a int", f"{tmp_path}/rows", f"{tmp_path}/bad", f"{tmp_path}/state")
    (tmp_path / "log" / "1.jsonl").write_text('{"id":"x","a":1}\n{"id":"y","a":2} x\n\n')
    run()
    (tmp_path / "log" / "2.jsonl").write_text('{"id":"z","a":3}\n{"id":\n')
    run()
    run()  # nothing new
    assert sorted((r.id, r.a) for r in spark.read.parquet(f"{tmp_path}/rows").collect()) == [("x", 1), ("z", 3)]
    bad = spark.read.parquet(f"{tmp_path}/bad").collect()
    assert sorted((r.raw, r.problem, r.file.rsplit("/", 1)[1]) for r in bad) == [('{"id":', "not_json", "2.jsonl"), ('{"id":"y","a":2} x', "not_json", "1.jsonl")]
    # The second batch is run again, as after a loss before its commit: the same rows.
    (tmp_path / "state" / "commits" / "1").unlink()
    (tmp_path / "state" / "commits" / ".1.crc").unlink(missing_ok=True)
    run()
    assert spark.read.parquet(f"{tmp_path}/rows").count() == 2 and spark.read.parquet(f"{tmp_path}/bad").count() == 2


def test_first_valid_with_bounded_state(spark, tmp_path):
    """Ids once over a resume; a late row of a known id is dropped while the watermark keeps it, and one that is
    later than the watermark whatever its id; state of ids that passed it is let go."""
    good = spark.createDataFrame([(1,)], "doc_id long").createOrReplaceTempView("one")
    assert good is None
    doc = [{"criterion": c, "evidence": "e", "aigc score": 0} for c in judgement.CRITERIA]
    valid = json.dumps({"per_criterion": doc, "overall_likelihood": "Real"})
    day = lambda d, h=0: datetime.datetime(2026, 1, d, h)
    schema = "id string, attempt int, raw_text string, label string, at timestamp"
    runs = [
        [("a", 0, "no", "REAL", day(1)), ("b", 0, valid, "REAL", day(1))],
        [("a", 1, valid, "REAL", day(1, 1)), ("b", 1, valid, "REAL", day(1, 2)), ("c", 0, valid, "REAL", day(10))],
        [("b", 2, valid, "REAL", day(1, 3)), ("d", 0, valid, "REAL", day(2)), ("c", 1, valid, "REAL", day(10, 1)), ("e", 0, valid, "REAL", day(10, 2))],
    ]
    want = [{("b", 0)}, {("b", 0), ("a", 1), ("c", 0)}, {("b", 0), ("a", 1), ("c", 0), ("e", 0)}]
    for k, rows in enumerate(runs):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(f"{tmp_path}/log")
        stream = incremental.first_valid(incremental.log_stream(spark, f"{tmp_path}/log", schema), "at", "1 day")
        query = incremental.run_available(stream.select("id", "attempt"), f"{tmp_path}/out", f"{tmp_path}/state")
        assert {tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").collect()} == want[k]
    kept = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
    assert kept[-1] <= 2


def test_validated_texts_and_report(spark, tmp_path):
    schema = "id string, raw_text string, finish_reason string, output_tokens int, error string"
    spark.createDataFrame([("a", "The shadows of the scene are consistent here.", None, 5, None), ("b", "real", None, 1, None)], schema).write.json(f"{tmp_path}/log")
    stream = incremental.validated_texts(incremental.log_stream(spark, f"{tmp_path}/log", schema))
    incremental.run_available(stream.select("id", "prompt_valid"), f"{tmp_path}/out", f"{tmp_path}/state")
    assert sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [("a", True), ("b", False)]
    io.write_report(spark.sql("select 3 as total, cast(null as int) as missing"), f"{tmp_path}/report")
    files = list((tmp_path / "report").glob("part-*"))
    assert len(files) == 1 and json.loads(files[0].read_text()) == {"total": 3, "missing": None}
    assert fixtures.LINES
