"""Draws, work lists and streams: properties that hold whatever the partitions."""

import json

import pytest
from pyspark.sql import functions as F

from annospark.operators import annotate, judge, paths, profile, sampling
from annospark.plans import queries
from annospark.sources import io
from annospark.streaming import incremental


def test_draws(spark):
    rows = spark.range(500).select(F.col("id"), (F.col("id") % 7 == 0).cast("string").alias("class"))
    ids = lambda df: sorted(r.id for r in df.collect())
    one = ids(sampling.draw(rows, "class", "id", 100))
    assert one == ids(sampling.draw(rows.repartition(13), "class", "id", 100)) and len(set(one)) == len(one) == 100 + 72
    assert one != ids(sampling.draw(rows, "class", "id", 100, seed=1))
    pool = rows.withColumns({"ok": F.col("id") % 3 != 0, "pref": F.lit(0)})
    good, bad = sampling.fill(pool, "class", "id", 20, "ok", "pref"), sampling.fill_errors(pool, "class", "id", 20, "ok", "pref")
    assert good.count() == 40 and not bad.where("ok").count() and bad.count() < 60
    assert sampling.pool_size(10) == 110 and sampling.pool_size(1000) == 3000
    assert [r.id for r in sampling.shuffled(rows, 3).collect()] == [r.id for r in sampling.shuffled(rows.repartition(5), 3).collect()]
    with pytest.raises(ValueError):
        sampling.strict(sampling.gate_violations(rows.selectExpr("cast(id as string) raw", "cast(null as string) kind", "'REAL' label"), "raw", "kind", "label", 1000))


def test_annotation_resumes(spark):
    manifest = spark.createDataFrame([(f"s{i}", "REAL") for i in range(4)], "id string, label string")
    prompts = annotate.prompt_dim(spark, queries.TEMPLATES)
    schema = "id string, prompt_id string, prompt string, attempt int, raw_text string, finish_reason string, output_tokens int, error string"
    log = annotate.validated(spark.createDataFrame([], schema))

    def call(batch):
        bad = (batch["id"] == "s1") & (batch["attempt"] < 2) | (batch["id"] == "s2")
        said = "The shadows of the scene are consistent here."
        return batch[["id", "prompt_id", "prompt", "attempt"]].assign(raw_text=bad.map({True: "real", False: said}), finish_reason=None, output_tokens=5, error=None)

    for round_ in range(4):
        work = annotate.work_list(manifest, prompts, log, round_)
        rows = [tuple(r) for r in annotate.annotate(work.select("id", "prompt_id", "prompt", "attempt"), call, schema, 2).collect()]
        assert len(rows) == [12, 6, 6, 0][round_]
        log = annotate.validated(spark.createDataFrame([tuple(r)[:8] for r in log.select(*[x.split(" ")[0] for x in schema.split(", ")]).collect()] + rows, schema))
    assert {r.id: r.attempt for r in annotate.assembled(log).collect()} == {"s0": 0, "s1": 2, "s3": 0}
    failed = annotate.failures(manifest, log).collect()
    assert [r.id for r in failed] == ["s2"] and failed[0].errors[0] == "prompt1: too_short_lt_30_chars"
    assert annotate.retries(log).where("id = 's2'").count() == 6
    with pytest.raises(ValueError):
        annotate.prompt_dim(spark, {"prompt1": "x"})


def test_streams_resume(spark, tmp_path):
    good = json.dumps({"per_criterion": [{"criterion": c, "evidence": "e", "aigc score": 0} for c in judge.judgement.CRITERIA], "overall_likelihood": "Real"})
    schema = "id string, attempt int, label string, raw_text string"
    rows = [("a", 0, "REAL", "x"), ("b", 0, "REAL", good), ("a", 1, "REAL", good), ("b", 1, "REAL", good), ("c", 0, "REAL", "")]
    for k, part in enumerate((rows[:2], rows[2:])):
        io.write_jsonl(spark.createDataFrame(part, schema).coalesce(1), f"{tmp_path}/log", append=True)
        stream = incremental.first_valid(incremental.log_stream(spark, f"{tmp_path}/log", schema))
        incremental.run_available(stream.select("id", "attempt"), f"{tmp_path}/out", f"{tmp_path}/state")
        found = sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").collect())
        assert found == [[("b", 0)], [("a", 1), ("b", 0)]][k]


def test_sources(spark, tmp_path):
    assert io.read_jsonl(spark, f"{tmp_path}/none", "a int").count() == 0
    (tmp_path / "x.jsonl").write_text('{"a": 1}\n\n{"a": 2}\n')
    assert io.read_jsonl(spark, f"{tmp_path}/x.jsonl", "a int").count() == 2
    (tmp_path / "y.jsonl").write_text('{"a": 1}\n{"a": \n')
    with pytest.raises(Exception, match="(?i)malformed|corrupt"):
        io.read_jsonl(spark, f"{tmp_path}/y.jsonl", "a int").collect()
    rows = io.read_jsonl(spark, f"{tmp_path}/y.jsonl", "a int, bad string", "bad").collect()
    assert sorted((r.a or 0, r.bad) for r in rows) == [(0, '{"a": '), (1, None)]
    for name, n in (("p", 7), ("q", 5)):
        spark.range(n).coalesce(1).write.parquet(f"{tmp_path}/{name}")
    rows = io.read_splits(spark, {"p": f"{tmp_path}/p", "q": f"{tmp_path}/q"})
    assert sorted((r.global_index, r.split, r.split_index, r.id) for r in rows.collect()) == [(i, "p" if i < 7 else "q", i % 7, i % 7) for i in range(12)]
    assert io.quick_scan(rows, 3).count() == 6
    io.empty_outputs(spark, f"{tmp_path}/e", {"raw": "a int"})
    (tmp_path / "img" / "Real").mkdir(parents=True)
    (tmp_path / "img" / "Real" / "a.JPG").write_bytes(b"1")
    (tmp_path / "img" / "b.txt").write_bytes(b"1")
    assert io.list_images(spark, f"{tmp_path}/img").count() == 1


def test_roles(spark):
    df = spark.createDataFrame([(b"1", "real", "x.jpg", 1), (b"2", "fake synthetic", "y.png", 0)], "image binary, label string, url string, n int")
    assert profile.image_column(df) == "image" and profile.label_column(df, ("url",)) == "label"
    assert profile.image_column(df.drop("image")) == "url"
    with pytest.raises(ValueError):
        profile.image_column(df.select("label"))


def test_stage1_long_conversations(spark, tmp_path):
    from annospark.plans import queries

    rows = [(c, t, "user", f"text {t} of {c}") for c in (1, 2) for t in range(15)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    for name in ("documents", "labels", "pages", "events", "lineitem"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").limit(1).write.parquet(f"{tmp_path}/{name}.parquet")
    found = queries.QUERIES["stage1_validate"](spark, str(tmp_path))
    assert sorted((r.id, r.attempt) for r in found.collect()) == [(f"c{c}", k) for c in (1, 2) for k in range(5) for _ in range(3)]
    assert queries.QUERIES["truncation_flags"](spark, str(tmp_path)).count() == 30
    assert all(r.next_attempt < 3 for r in queries.QUERIES["stage1_retries"](spark, str(tmp_path)).collect())


def test_missing_images_and_rewritten_prompts(spark):
    manifest = spark.createDataFrame([("a", "/x/1.jpg"), ("b", "/x/2.jpg"), ("c", None)], "id string, image_path string")
    gone = annotate.missing_images(manifest, spark.createDataFrame([("/x/1.jpg",), ("/x/1.jpg",)], "path string")).collect()
    assert {r.id for r in gone} == {"b", "c"} and all(r.validation_errors == ["image_not_found"] for r in gone)
    prompts = annotate.rewritten(annotate.prompt_dim(spark, queries.TEMPLATES), "Look closely. ", {"Ground truth": "Given", "Part": "Section"})
    assert prompts.where("prompt_id = 'prompt2'").first().template == "Look closely. Given: {LABEL}. Section 2."


def test_first_and_last_valid(spark):
    rows = [("a", "prompt1", 0, "x", False), ("a", "prompt1", 1, "y", True), ("a", "prompt1", 2, "z", True), ("b", "prompt1", 0, "q", False)]
    log = spark.createDataFrame(rows, "id string, prompt_id string, attempt int, raw_text string, prompt_valid boolean")
    assert [r.raw_text for r in annotate.chosen(log).collect()] == ["y"]
    assert [r.raw_text for r in annotate.chosen(log, "last").collect()] == ["z"]


def test_failures_without_an_error(spark):
    manifest = spark.createDataFrame([("a", "REAL")], "id string, label string")
    rows = [("a", f"prompt{k}", 2, [], False) for k in (1, 2, 3)]
    log = spark.createDataFrame(rows, "id string, prompt_id string, attempt int, validation_errors array<string>, prompt_valid boolean")
    assert annotate.failures(manifest, log).first().errors == ["stage1_not_valid_after_retries"]
    assert annotate.failures(manifest, log.limit(0)).first().errors == [f"prompt{k}: missing_output" for k in (1, 2, 3)]


JUDGED = {"per_criterion": [{"criterion": c, "evidence": "e", "aigc score": 0} for c in judge.judgement.CRITERIA], "overall_likelihood": "Real"}
STRUCT = "struct<per_criterion:array<struct<criterion:string,evidence:string,`aigc score`:int>>,overall_likelihood:string>"


def test_judgements_as_structs(spark):
    """Without a log, what was valid before is read again: the string, else the struct, else the raw answer."""
    text = json.dumps(JUDGED)
    rows = [("a", text, None, None), ("b", None, text, None), ("c", None, None, "raw"), ("d", None, None, None)]
    valid = spark.createDataFrame(rows, "id string, stage2_json_string string, s string, raw_text string")
    valid = valid.withColumn("stage2_json", F.from_json("s", STRUCT)).drop("s")
    log = spark.createDataFrame([], "id string, raw_text string")
    again = {r.id: r.raw_text for r in judge.source_of_attempts(log, valid).collect()}
    assert json.loads(again["a"]) == json.loads(again["b"]) == JUDGED and (again["c"], again["d"]) == ("raw", "")
    given = spark.createDataFrame([("q", "w")], "id string, raw_text string")
    assert judge.source_of_attempts(given, valid).first().raw_text == "w"
    said = F.struct(*[F.struct(F.lit("o").alias("output")).alias(f"prompt{k}") for k in (1, 2, 3)])
    stage1 = valid.select("id", said.alias("stage1"))
    stage2 = valid.where("id in ('a', 'b')").select("id", F.lit("REAL").alias("label"), F.lit("/i.jpg").alias("image_path"), "stage2_json_string", "stage2_json")
    out = judge.sft_rows(stage2, stage1, stage2.select("id", "label", "image_path").limit(0), "g").collect()
    assert all(r.skip is None and json.loads(r.messages[1].content) == JUDGED for r in out) and len(out) == 2


def test_message_shapes(spark):
    message = "struct<role:string,content:string>"
    rows = [([("user", "q"), ("assistant", "a")],), ([("assistant", "a"), ("user", "q")],), ([("user", "q")],), ([("user", "q"), ("assistant", None)],), (None,)]
    df = spark.createDataFrame(rows, f"m array<{message}>")
    assert [r.ok for r in df.select(judge.well_formed(F.col("m")).alias("ok")).collect()] == [True, False, False, False, False]


def test_ranks_payloads_and_files(spark):
    rows = spark.range(3000).select((F.col("id") % 3).cast("string").alias("c"), F.pmod(F.hash("id"), F.lit(500)).cast("long").alias("o"), "id")
    rows = rows.withColumn("c", F.when(F.col("c") != "2", F.col("c"))).withColumn("o", F.when(F.col("id") % 50 != 0, F.col("o")))
    found = {}
    for r in sampling.ranked(rows, "c", "o", "id").collect():
        found.setdefault(r.c, []).append((r["rank"], r.o, r.id))
    for c, own in found.items():
        own.sort()
        assert [i for _, _, i in own] == [i for _, i in sorted(((o is not None, o or 0), i) for _, o, i in own)]
        own = [(k, o) for k, o, _ in own]
        assert [k for k, _ in own] == list(range(1, 1001)) and [o for _, o in own] == sorted((o for _, o in own), key=lambda o: (o is not None, o))
    # One value and one class for all rows: still many ranges, and each place once.
    hot = spark.range(5000).repartition(7).select(F.lit(1).alias("o"), F.lit("c").alias("c"))
    assert sorted(r["rank"] for r in sampling.ranked(hot, "c", "o").collect()) == list(range(1, 5001))
    source = rows.withColumn("text", F.repeat(F.lit("x"), 50))
    chosen = spark.createDataFrame([(5, 1), (7, 2)], "id long, rank int")
    for most in (10, 1):
        assert sorted((r.id, r["rank"], len(r.text)) for r in sampling.payload(source, chosen, "id", most).collect()) == [(5, 1, 50), (7, 2, 50)]
    files = spark.createDataFrame([("real", "b.jpg", "/2/b.jpg"), ("real", "a.jpg", "/9/a.jpg"), ("fake", "c.jpg", "/1"), ("fake", "c.jpg", "/0"), ("fake", "d.jpg", "/5")], "class string, name string, path string")
    ranks = {(r["class"], r.path): r["rank"] for r in sampling.file_sample(files, "class", "name", "path", 2).collect()}
    assert ranks["real", "/9/a.jpg"] == 1 and ranks["real", "/2/b.jpg"] == 2 and len(ranks) == 4
    with pytest.raises(ValueError, match="real has 2 files of 3"):
        sampling.file_sample(files, "class", "name", "path", 3)


def test_path_gates(spark):
    files = spark.createDataFrame([("real/Fake/1.jpg",), ("real/2.png",), ("x/3.txt",)], "path string")
    assert [tuple(r) for r in paths.gate_violations(files).collect()] == [("class_overlap", "both", 1)]
    none = paths.gate_violations(files.limit(0)).collect()
    assert {(r.gate, r.value) for r in none} == {("missing_class_folder", "real"), ("missing_class_folder", "fake")}
    with pytest.raises(ValueError):
        sampling.strict(paths.gate_violations(files))


def test_resolved_paths(spark):
    given = ["a/./b//c.jpg", "/x/../y/a.png", "../../a", "s3://bucket/k/../a.jpg", "file:///t/a", "/", "", None]
    rows = spark.createDataFrame([(g,) for g in given], "p string")
    assert [r[0] for r in rows.select(paths.resolved(F.col("p"), "/root/in")).collect()] == ["/root/in/a/b/c.jpg", "/y/a.png", "/a", "s3://bucket/a.jpg", "file:/t/a", "/", "/root/in", None]
    manifest = spark.createDataFrame([("/i/1.jpg", "own"), ("/i/2.jpg", "own"), (None, "own")], "image_path string, source string")
    metadata = spark.createDataFrame([("x/../1.jpg", "first", 1), ("/i/1.jpg", None, 2), ("2.jpg", "new", 1), ("", "none", 3), (None, "none", 4)], "image_path string, source string, n int")
    found = sampling.with_metadata(manifest, metadata, "n", "/i").orderBy("image_path").collect()
    assert [tuple(r) for r in found] == [(None, "own"), ("/i/1.jpg", "own"), ("/i/2.jpg", "new")]
