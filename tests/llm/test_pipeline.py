import corpus_pipeline
from annospark.llm import decontaminate, entries, quality
from tests.llm import test_decontaminate, test_lines, test_minhash, test_packing


def test_stages_against_brute_force(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = quality.train(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    rejected = {r.doc_id for r in quality.scored(docs, model).collect() if r.predicted == 0}
    want = {r.doc_id: r.text for r in docs.collect()}
    assert rejected and len(rejected) < len(want) / 3
    items = {r.item_id: r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf)
        if k == 4:
            test_packing._check(out.collect(), want, 1024, 0, entries.tokenizer_path())
            continue
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        if k == 0:
            want = {d: t for d, t in want.items() if d not in rejected}
        elif k == 1:
            gone = test_lines.brute(want)
            want = {d: "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone.get(d, ())) for d, t in want.items()}
        elif k == 2:
            want = {r[0]: want[r[0]] for r in test_minhash.brute(want, 5) if r[3]}
        else:
            hit = {d for d, *_ in test_decontaminate.brute(want, items)}
            assert hit
            want = {d: t for d, t in want.items() if d not in hit}
        rows = docs.collect()
        assert {r.doc_id: r.text for r in rows} == want and all(r.n_chars == len(r.text) for r in rows)
    assert corpus_pipeline.run(spark, sf).count() > 0
    assert decontaminate.RADIUS == 20


def test_odd_tables(spark, sf, tmp_path):
    """Empty tables, nulls in every column, repeated rows and extra columns that clash with those of operators."""
    rows = [(1, "good text " * 30, "en", "s", 300), (1, "good text " * 30, "en", "s", 300), (1, "another text", None, None, None)]
    rows += [(None, "no id " * 20, "en", "s", 120), (2, None, None, None, None), (3, "", "en", "s", 0), (4, "long " * 60_000, "en", "s", 0)]
    extra = [f"'{c}' {c}" for c in ("score", "predicted", "line", "part", "size", "key", "id", "kept", "component", "length", "start")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", *extra)
    labels = spark.createDataFrame([(1, 1, 0), (None, 0, 0), (2, None, None)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, None), (None, "no id no id no id no id no id")], "item_id long, text string")
    for name, part in (("full", 100), ("empty", 0)):
        for table, df in (("documents", docs), ("labels", labels), ("benchmark", bench)):
            df.limit(part).write.parquet(f"{tmp_path}/{name}/{table}.parquet")
    out = corpus_pipeline.run(spark, f"{tmp_path}/full").collect()
    assert {r.doc_id for r in out} == {None, 1, 2, 3, 4}
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty").count() == 0
