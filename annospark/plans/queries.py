"""Registered queries over the operators of this library, and the same in DuckDB's SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annospark.functions import judgement, labels, responses, text
from annospark.operators import annotate, judge, paths, payloads, profile, sampling
from annospark.plans import fixtures as fx
from annospark.plans.fixtures import frame
from annospark.sources import io, work

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SEED, QUOTA = 42, 40
TEMPLATES = {p: f"Ground truth: {{LABEL}}. Part {i}." for i, p in enumerate(annotate.PROMPTS, 1)}
JUDGE_TEMPLATE = "Label {LABEL}\n1 {STAGE1_OUTPUT_1}\n2 {STAGE1_OUTPUT_2}\n3 {STAGE1_OUTPUT_3}"


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _in(values) -> str:
    return "(" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in values) + ")"


# What the SQL expects, written out once more so that a wrong value in the library shows.
_TERMS = {
    "real": "authentic genuine real",
    "tampered": "edited manipulated tampered",
    "synthetic": "ai-generated ai_generated aigenerated full-synthetic full_synthetic fully-synthetic fully_synthetic generated synthetic",
}
_NUMBER_NAMES = {0: "0 real real_image", 1: "1 full_synthetic fullsynthetic synthetic ai_generated", 2: "2 tampered manipulated"}
_LABEL_ANSWERS = [
    "real", "fake", "ai-generated", "ai generated", "this image is real", "this image is fake", "this image is ai-generated",
    "this image is ai generated", "the image is real", "the image is fake", "the image is ai-generated", "the image is ai generated",
]
_ANSWER_WORDS = "real fake ai-generated ai generated image this is the".split()
_OPEN_ENDS = "and or but because with without while although however therefore to of for from in on by as at into".split()
_OPEN_GROUPS = ["due to", "such as", "including", "based on"]
_CUTS = ["length", "max_tokens", "max_output_tokens", "token_limit"]


# Labels ---------------------------------------------------------------------------------------------

_NORM = "trim(regexp_replace(lower(raw_label), '[^a-z0-9]+', '_', 'g'), '_')"
_TOKENS = f"list_filter(list_concat(string_split({_NORM}, '_'), [{_NORM}, replace({_NORM}, '_', '-')]), lambda x: x <> '')"
_KIND = "CASE " + " ".join(f"WHEN list_has_any(tokens, [{_in(t)[1:-1]}]) THEN '{k}'" for k, t in ((k, t.split()) for k, t in _TERMS.items())) + " END"
_LABELLED = f"labelled AS (SELECT *, {_KIND} AS category FROM (SELECT *, {_NORM} AS normal, {_TOKENS} AS tokens FROM src))"
_BINARY = "CASE category WHEN 'real' THEN 'REAL' WHEN 'synthetic' THEN 'AI-GENERATED' END"
_SRC = f"WITH src AS ({fx.SRC}), {_LABELLED}"


def _src(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frame(spark, sf_dir, fx.SRC).withColumn("category", labels.category(F.col("raw_label")))
    return rows.withColumn("label", labels.binary(F.col("category")))


@query(f"{_SRC} SELECT global_index, normal, replace(normal, '_', '-') AS dir_normal, array_to_string(list_sort(list_distinct(tokens)), ',') AS tokens FROM labelled WHERE raw_label IS NOT NULL")
def label_normalize(spark, sf_dir):
    c = F.col("raw_label")
    return _src(spark, sf_dir).where(c.isNotNull()).select(
        "global_index", labels.normalize(c).alias("normal"), labels.normalize(c, "-").alias("dir_normal"), F.array_join(F.array_sort(labels.tokens(c)), ",").alias("tokens")
    )


@query(f"""{_SRC} SELECT global_index, category, {_BINARY} AS label,
    CASE category WHEN 'real' THEN CASE WHEN list_contains(tokens, 'authentic') THEN 'authentic' ELSE 'real' END
        WHEN 'tampered' THEN CASE WHEN list_contains(tokens, 'manipulated') THEN 'manipulated' ELSE 'tampered' END
        WHEN 'synthetic' THEN CASE WHEN list_contains(tokens, 'fully_synthetic') THEN 'fully_synthetic' WHEN list_contains(tokens, 'ai_generated') THEN 'ai_generated' END END AS name
    FROM labelled""")
def label_classify(spark, sf_dir):
    return _src(spark, sf_dir).select("global_index", "category", "label", labels.representative(F.col("raw_label")).alias("name"))


_NUMBER = "CASE {c} " + " ".join(f"WHEN '{x}' THEN {v}" for v, names in _NUMBER_NAMES.items() for x in names.split()) + " END"
_BARE = "replace(replace(lower(trim({c})), '-', '_'), ' ', '_')"


@query(f"WITH src AS ({fx.SRC}) SELECT global_index, {_NUMBER.format(c=_BARE.format(c='raw_label'))} AS number, coalesce({_NUMBER.format(c=_BARE.format(c='raw_label'))}, {_NUMBER.format(c='cast(global_index % 4 AS varchar)')}) AS either FROM src")
def label_to_int(spark, sf_dir):
    rows = frame(spark, sf_dir, fx.SRC).withColumn("labels", F.col("raw_label")).withColumn("target", F.col("global_index") % 4)
    return rows.select("global_index", labels.number(F.col("raw_label")).alias("number"), labels.first_number(rows.columns).alias("either"))


#: What ids of the two classes begin with.
PREFIXES = ("sidset_real_", "sidset_fake_")
_SAMPLE = "CASE {label} WHEN 'REAL' THEN 'sidset_real_' ELSE 'sidset_fake_' END || printf('%06d', {rank})"


@query(f"""{_SRC}, ranked AS (SELECT *, {_BINARY} AS label, row_number() OVER (PARTITION BY {_BINARY} ORDER BY global_index) AS r FROM labelled WHERE {_BINARY} IS NOT NULL)
    SELECT global_index, {_SAMPLE.format(label='label', rank='r')} AS id, {_SAMPLE.format(label='label', rank='r * 100000')} AS long_id,
    CASE WHEN global_index % 2 = 0 AND label = 'REAL' THEN 'sidset_real_' || printf('%06d', global_index) ELSE {_SAMPLE.format(label='label', rank='r')} END AS kept_id FROM ranked""")
def make_ids(spark, sf_dir):
    rows = sampling.ranked(_src(spark, sf_dir).where("label is not null"), "label", "global_index")
    stem = F.when(F.col("global_index") % 2 == 0, F.concat(F.lit("sidset_real_"), F.format_string("%06d", "global_index"), F.lit(".jpg"))).otherwise("x.jpg")
    label, rank = F.col("label"), F.col("rank")
    return rows.select("global_index", labels.sample_id(label, rank, PREFIXES).alias("id"), labels.sample_id(label, rank * 100000, PREFIXES).alias("long_id"), labels.kept_or_ranked_id(stem, label, rank, PREFIXES).alias("kept_id"))


# Draws and counts -----------------------------------------------------------------------------------

_PRIORITY = "md5('42:' || cast({c} AS varchar))"


@query(f"""SELECT l_returnflag, l_orderkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY md5('42:' || l_orderkey || '-' || l_linenumber) DESC, l_orderkey || '-' || l_linenumber) AS r FROM lineitem) WHERE r <= {QUOTA}""")
def balanced_sample(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_returnflag", "l_orderkey", "l_linenumber")
    rows = rows.withColumn("key", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    return sampling.draw(rows, "l_returnflag", "key", QUOTA, SEED).drop("key")


@query(f"""{_SRC} SELECT label, global_index, r AS rank FROM (SELECT *, {_BINARY} AS label, row_number() OVER (PARTITION BY {_BINARY} ORDER BY global_index) AS r FROM labelled WHERE {_BINARY} IS NOT NULL) WHERE r <= {QUOTA}""")
def first_n_per_class(spark, sf_dir):
    return sampling.first_of_class(_src(spark, sf_dir).where("label is not null"), "label", "global_index", QUOTA).select("label", "global_index", F.col("rank").cast("long").alias("rank"))


@query(f"""{_SRC}, r AS (SELECT global_index, {_BINARY} AS label, row_number() OVER (PARTITION BY {_BINARY} ORDER BY global_index) AS r FROM labelled WHERE {_BINARY} IS NOT NULL),
    cut AS (SELECT CASE WHEN count(*) = 2 THEN max(global_index) END AS cutoff FROM r WHERE r = {QUOTA})
    SELECT coalesce(category, 'unknown') AS category, count(*) AS n FROM labelled, cut WHERE cutoff IS NULL OR global_index <= cutoff GROUP BY 1""")
def until_complete_counts(spark, sf_dir):
    rows = sampling.until_complete(_src(spark, sf_dir), "label", "global_index", QUOTA, ["REAL", "AI-GENERATED"])
    return rows.groupBy(F.coalesce("category", F.lit("unknown")).alias("category")).agg(F.count("*").alias("n"))


@query(f"""{_SRC}, x AS (SELECT split, coalesce(raw_label, 'null') AS r, coalesce(category, 'unknown') AS k FROM labelled)
    SELECT 'split' AS dimension, split AS value, count(*) AS n FROM x GROUP BY split UNION ALL SELECT 'raw_label', r, count(*) FROM x GROUP BY r
    UNION ALL SELECT 'category', k, count(*) FROM x GROUP BY k UNION ALL SELECT 'total', 'all', count(*) FROM x""")
def scan_report(spark, sf_dir):
    return sampling.scan_report(_src(spark, sf_dir), "split", "raw_label", "category")


@query(f"""{_SRC} SELECT raw_label, arg_max(normal, global_index) AS label_name, min(category) AS category, min(global_index) AS example, count(*) AS n, count(DISTINCT category) > 1 AS conflict FROM labelled WHERE raw_label IS NOT NULL GROUP BY 1""")
def label_map(spark, sf_dir):
    rows = _src(spark, sf_dir).withColumn("normal", labels.normalize(F.col("raw_label")))
    return sampling.label_map(rows, "raw_label", "normal", "category", "global_index")


@query(f"""{_SRC} SELECT 'unknown_label' AS gate, coalesce(raw_label, 'null') AS value, count(*) AS n FROM labelled WHERE category IS NULL GROUP BY 2
    UNION ALL SELECT 'quota_not_reached', v, n FROM (SELECT v, (SELECT count(*) FROM labelled WHERE {_BINARY} = v) AS n FROM (VALUES ('REAL'), ('AI-GENERATED')) t(v)) WHERE n < 200""")
def gate_violations(spark, sf_dir):
    return sampling.gate_violations(_src(spark, sf_dir), "raw_label", "category", "label", 200)


@query(f"""{_SRC}, k AS (SELECT raw_label, CASE WHEN raw_label = 'REAL' AND global_index % 2 = 0 THEN 'synthetic' ELSE category END AS kind, CASE WHEN {_BINARY} = 'REAL' THEN 'REAL' ELSE 'AI-GENERATED' END AS label FROM labelled)
    SELECT 'two_categories' AS gate, raw_label AS value, count(DISTINCT kind) AS n FROM k GROUP BY 2 HAVING count(DISTINCT kind) > 1
    UNION ALL SELECT 'unknown_label', coalesce(raw_label, 'null'), count(*) FROM k WHERE kind IS NULL GROUP BY 2""")
def gate_two_categories(spark, sf_dir):
    mixed = F.when((F.col("raw_label") == "REAL") & (F.col("global_index") % 2 == 0), "synthetic").otherwise(F.col("category"))
    rows = _src(spark, sf_dir).withColumn("kind", mixed).withColumn("label", F.when(F.col("label") == "REAL", "REAL").otherwise("AI-GENERATED"))
    return sampling.gate_violations(rows, "raw_label", "kind", "label", 0)


@query(f"""{_SRC} SELECT label, global_index FROM (SELECT global_index, {_BINARY} AS label, row_number() OVER (PARTITION BY {_BINARY} ORDER BY {_PRIORITY.format(c='global_index')} DESC, global_index) AS p FROM labelled WHERE {_BINARY} IS NOT NULL) WHERE p <= 110""")
def pool_draw(spark, sf_dir):
    """A pool that leaves room for unreadable rows: for a quota of 10."""
    return sampling.draw(_src(spark, sf_dir).where("label is not null"), "label", "global_index", sampling.pool_size(10), SEED).select("label", "global_index")


_DRAWN = f"drawn AS (SELECT * FROM (SELECT *, {_BINARY} AS label, row_number() OVER (PARTITION BY {_BINARY} ORDER BY {_PRIORITY.format(c='global_index')} DESC, global_index) AS p FROM labelled WHERE {_BINARY} IS NOT NULL) WHERE p <= {QUOTA})"


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = sampling.draw(_src(spark, sf_dir).where("label is not null"), "label", "global_index", QUOTA, SEED)
    path = F.concat(F.lit("/images/"), F.col("global_index").cast("string"), F.lit(".jpg"))
    return sampling.manifest(drawn, "label", "global_index", path, F.col("source"), PREFIXES)


@query(f"""{_SRC}, {_DRAWN}, m AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY global_index) AS r FROM drawn)
    SELECT {_SAMPLE.format(label='label', rank='r')} AS id, '/images/' || global_index || '.jpg' AS image_path, label, CASE label WHEN 'REAL' THEN 0 ELSE 1 END AS label_id,
    CASE WHEN global_index % 3 = 0 THEN 'extra-' || split ELSE source END AS source_dataset, global_index AS source_original_index FROM m""")
def manifest(spark, sf_dir):
    path = F.concat(F.lit("/images/"), F.col("global_index").cast("string"), F.lit(".jpg"))
    rows = _manifest(spark, sf_dir)
    # Metadata names the same files by other spellings.
    other = F.concat(F.lit("up/.././"), F.col("global_index").cast("string"), F.lit(".jpg"))
    extra = _src(spark, sf_dir).where("global_index % 3 = 0").select(F.when(F.col("global_index") % 2 == 0, other).otherwise(path).alias("image_path"), F.concat(F.lit("extra-"), "split").alias("source_dataset"), "global_index")
    return sampling.with_metadata(rows, extra, "global_index", "/images")


@query(f"""{_SRC}, pool AS (SELECT *, category <> 'real' AND category IS NOT NULL AS use_it, n_chars % 4 <> 0 AS ok, CASE category WHEN 'synthetic' THEN 0 ELSE 1 END AS pref, {_PRIORITY.format(c='global_index')} AS p FROM labelled WHERE category IN ('synthetic', 'tampered'))
    SELECT global_index, row_number() OVER (ORDER BY pref, p DESC, global_index) AS rank FROM pool WHERE ok QUALIFY rank <= {QUOTA}""")
def verified_fill(spark, sf_dir):
    pool = _src(spark, sf_dir).where("category in ('synthetic', 'tampered')").withColumns(
        {"ok": F.col("n_chars") % 4 != 0, "preference": F.when(F.col("category") == "synthetic", 0).otherwise(1), "class": F.lit("AI-GENERATED")}
    )
    return sampling.fill(pool, "class", "global_index", QUOTA, "ok", "preference", SEED).select("global_index", F.col("rank").cast("long").alias("rank"))


@query(f"""{_SRC}, pool AS (SELECT *, n_chars % 4 <> 0 AS ok, CASE category WHEN 'synthetic' THEN 0 ELSE 1 END AS pref, {_PRIORITY.format(c='global_index')} AS p FROM labelled WHERE category IN ('synthetic', 'tampered')),
    seen AS (SELECT *, coalesce(sum(CASE WHEN ok THEN 1 ELSE 0 END) OVER (ORDER BY pref, p DESC, global_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS good FROM pool)
    SELECT global_index, n_chars FROM seen WHERE NOT ok AND good < {QUOTA}""")
def verified_fill_errors(spark, sf_dir):
    pool = _src(spark, sf_dir).where("category in ('synthetic', 'tampered')").withColumns(
        {"ok": F.col("n_chars") % 4 != 0, "preference": F.when(F.col("category") == "synthetic", 0).otherwise(1), "class": F.lit("AI-GENERATED")}
    )
    return sampling.fill_errors(pool, "class", "global_index", QUOTA, "ok", "preference", SEED).select("global_index", "n_chars")


@query(f"""{_SRC}, pool AS (SELECT *, n_chars % 4 <> 0 AS ok, CASE category WHEN 'synthetic' THEN 0 ELSE 1 END AS pref, {_PRIORITY.format(c='global_index')} AS p FROM labelled WHERE {_BINARY} IS NOT NULL OR category = 'tampered'),
    seen AS (SELECT *, CASE category WHEN 'real' THEN 'REAL' ELSE 'AI-GENERATED' END AS class, sum(CASE WHEN ok THEN 1 ELSE 0 END) OVER (PARTITION BY category = 'real' ORDER BY pref, p DESC, global_index) AS good FROM pool)
    SELECT class, global_index, CASE WHEN ok THEN good::INT END AS rank, ok AS filled FROM seen WHERE good <= {QUOTA} AND (ok OR good < {QUOTA})""")
def verified_fill_lazy(spark, sf_dir):
    pool = _src(spark, sf_dir).where("category is not null").withColumns(
        {"preference": F.when(F.col("category") == "synthetic", 0).otherwise(1), "class": F.when(F.col("category") == "real", "REAL").otherwise("AI-GENERATED")}
    )
    chosen, failed = sampling.fill_lazily(pool, "class", "global_index", QUOTA, lambda rows: rows.withColumn("ok", F.col("n_chars") % 4 != 0), "preference", SEED)
    return chosen.select("class", "global_index", "rank", F.lit(True).alias("filled")).unionByName(failed.select("class", "global_index", F.lit(None).cast("int").alias("rank"), F.lit(False).alias("filled")))


@query(f"""{_SRC}, {_DRAWN} SELECT drawn.label, drawn.global_index, md5(d.text) AS payload, length(d.text) AS n FROM drawn JOIN documents d ON d.doc_id = drawn.global_index""")
def selected_payload(spark, sf_dir):
    keys = _src(spark, sf_dir).where("label is not null").select("label", "global_index")
    chosen = sampling.draw(keys, "label", "global_index", QUOTA, SEED)
    source = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumnRenamed("doc_id", "global_index")
    rows = sampling.payload(source, chosen, "global_index")
    return rows.select("label", "global_index", F.md5("text").alias("payload"), F.length("text").cast("long").alias("n"))


@query(f"""{_SRC}, {_DRAWN}, m AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY global_index) AS r FROM drawn)
    SELECT row_number() OVER (ORDER BY label <> 'REAL', global_index) - 1 AS place, {_SAMPLE.format(label='label', rank='r')} AS id FROM m""")
def output_order(spark, sf_dir):
    rows = _manifest(spark, sf_dir).select("id", F.struct(*sampling.ORDER).alias("order"), F.lit("all").alias("all"))
    return sampling.ranked(rows, "all", "order", "id").select((F.col("rank") - 1).alias("place"), "id")


@query(f"""{_SRC}, {_DRAWN} SELECT count(*) AS n, count(*) FILTER (label = 'REAL') AS n_real, count(*) FILTER (label <> 'REAL') AS n_fake, count(DISTINCT source) AS n_sources,
    min(global_index) AS first_index, max(global_index) AS last_index FROM drawn""")
def draw_summary(spark, sf_dir):
    return sampling.draw_summary(_manifest(spark, sf_dir))


@query(f"""WITH p AS ({fx.PATHS}), f AS (SELECT CASE WHEN contains(path, '/Fake/') THEN 'fake' ELSE 'real' END AS class, path, string_split(path, '/')[-1] AS name FROM p WHERE regexp_matches(lower(path), '\\.(jpg|jpeg|png|webp|bmp)$')),
    d AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY class ORDER BY md5('42:' || path) DESC, path) <= 10)
    SELECT class, path, row_number() OVER (PARTITION BY class ORDER BY name, path) AS rank FROM d""")
def file_sample(spark, sf_dir):
    files = paths.images(frame(spark, sf_dir, f"SELECT DISTINCT path FROM ({fx.PATHS})"))
    files = files.withColumn("class", F.when(F.contains("path", F.lit("/Fake/")), "fake").otherwise("real")).withColumn("name", F.element_at(F.split("path", "/"), -1))
    return sampling.file_sample(files, "class", "name", "path", 10, SEED).select("class", "path", F.col("rank").cast("long").alias("rank"))


_CARD_MAP = f"""WITH c AS ({fx.CARD}), p AS (SELECT event_id, regexp_extract(line, '^- ([0-9]+) : (.*)$', 1) AS raw_value, regexp_extract(line, '^- ([0-9]+) : (.*)$', 2) AS label_text FROM c),
    k AS (SELECT *, CASE label_text WHEN 'real photo' THEN 'real' WHEN 'fully synthetic' THEN 'synthetic' WHEN 'edited' THEN 'tampered' END AS category FROM p),
    card AS (SELECT raw_value, CASE arg_max(category, event_id) WHEN 'real' THEN 'real' WHEN 'synthetic' THEN 'fully_synthetic' ELSE 'edited' END AS label_name FROM k WHERE category IS NOT NULL GROUP BY 1)"""


_HINT = "CASE lang WHEN 'en' THEN 'Authentic / photo' WHEN 'de' THEN 'Fully-Synthetic' ELSE lang END"


@query(f"""{_CARD_MAP}, d AS (SELECT *, CASE WHEN doc_id % 7 <> 0 THEN doc_id % 60 END AS raw, CASE lang WHEN 'en' THEN 'authentic' WHEN 'de' THEN 'fully_synthetic' END AS hint FROM documents)
    SELECT doc_id, coalesce(card.label_name, n_name) AS label_name, coalesce(card.label_name, n_name, hint) AS explicit_name,
    coalesce(card.label_name, n_name, cast(raw AS varchar), hint) AS text_name, cast(cast(trunc(n_chars / 4.0) AS bigint) AS varchar) AS original_number, lang AS original_text
    FROM d LEFT JOIN card ON card.raw_value = cast(raw AS varchar) LEFT JOIN (SELECT n_nationkey AS k, n_name FROM nation) ON k = raw""")
def label_names(spark, sf_dir):
    card = io.card_labels(frame(spark, sf_dir, fx.CARD), "line", "event_id")
    classes = spark.read.parquet(f"{sf_dir}/nation.parquet").selectExpr("n_nationkey class_id", "n_name class_name")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id", "lang", "n_chars / 4.0D quarter", "case when doc_id % 7 <> 0 then doc_id % 60 end raw", f"{_HINT} hint")
    rows = sampling.label_names(docs, "raw", card, classes)
    rows = sampling.label_names(rows.withColumnRenamed("label_name", "first_name"), "raw", card, classes, ["hint"]).withColumnRenamed("label_name", "explicit_name")
    rows = rows.withColumn("raw", F.col("raw").cast("string"))
    rows = sampling.label_names(rows, "raw", card, classes, ["hint"]).withColumnRenamed("label_name", "text_name")
    originals = labels.original(F.col("quarter"), False).alias("original_number"), labels.original(F.col("lang"), True).alias("original_text")
    return rows.select("doc_id", F.col("first_name").alias("label_name"), "explicit_name", "text_name", *originals)


# Free-text annotations ------------------------------------------------------------------------------

_WS = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _strip(c: str) -> str:
    return f"regexp_replace({c}, '^{_WS}+|{_WS}+$', '', 'g')"


_END = r"[.!?\"'')\]}]"
_TEXT = rf"""WITH raw AS ({fx.STAGE1_RAW}), a AS (SELECT *, {_strip('raw_text')} AS t FROM raw),
    b AS (SELECT *, regexp_replace(regexp_replace(lower(t), '{_WS}+', ' ', 'g'), '[ .!?"'')\]}}]+$', '') AS low,
        regexp_replace(regexp_replace(lower(t), '{_WS}+', ' ', 'g'), '^[ .!?"'']+|[ .!?"'']+$', '', 'g') AS bare,
        coalesce(list_filter(list_transform(string_split_regex(t, '\r\n|[\n\r\x{{0b}}\x{{0c}}\x{{1c}}-\x{{1e}}\x{{85}}\x{{2028}}\x{{2029}}]'), lambda x: {_strip('x')}), lambda x: x <> '')[-1], '') AS line FROM a),
    c AS (SELECT *, line = '' OR regexp_matches(line, '^(?:[-*]|\p{{Nd}}+[.)])$') OR (regexp_matches(line, '^(?:[-*]|\p{{Nd}}+[.)]){_WS}+[^ \t-\r]') AND NOT regexp_matches(line, '{_END}$')) AS bullet,
        bare IN {_in(_LABEL_ANSWERS)} OR (bare <> '' AND len(string_split(bare, ' ')) <= 6 AND len(list_filter(string_split(bare, ' '), lambda w: w NOT IN {_in(_ANSWER_WORDS)})) = 0) AS is_label FROM b),
    d AS (SELECT *, coalesce(finish_reason IN {_in(_CUTS)}, false) OR t = '' OR regexp_matches(t, '(?:\.\.\.|[,:])$')
        OR regexp_matches(low, '(?:{'|'.join(_OPEN_GROUPS)})$') OR coalesce(regexp_extract_all(low, '[a-z]+(?:-[a-z]+)?')[-1] IN {_in(_OPEN_ENDS)}, false)
        OR bullet OR (output_tokens >= 475 AND NOT regexp_matches(t, '{_END}$')) AS cut FROM c),
    e AS (SELECT *, CASE WHEN coalesce(error, '') <> '' THEN ['api_error'] ELSE list_filter([CASE WHEN t = '' THEN 'empty_output' END, CASE WHEN length(t) < 30 THEN 'too_short_lt_30_chars' END,
        CASE WHEN is_label THEN 'label_only_or_short_answer' END, CASE WHEN t[1] IN ('{{', '[') THEN 'json_like_output_not_allowed' END,
        CASE WHEN contains(t, '```') THEN 'markdown_code_fence_not_allowed' END, CASE WHEN cut THEN 'suspected_truncation_or_incomplete_sentence' END], lambda x: x IS NOT NULL) END AS errors FROM d)"""


def _stage1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotate.validated(frame(spark, sf_dir, fx.STAGE1_RAW))


@query(f"{_TEXT} SELECT id, prompt_id, attempt, raw_text, array_to_string(errors, ';') AS errors, len(errors) = 0 AS prompt_valid FROM e")
def stage1_validate(spark, sf_dir):
    return _stage1(spark, sf_dir).select("id", "prompt_id", "attempt", "raw_text", F.array_join("validation_errors", ";").alias("errors"), "prompt_valid")


@query(f"{_TEXT} SELECT id, prompt_id, attempt, raw_text, cut, bullet, is_label AS label_only FROM e")
def truncation_flags(spark, sf_dir):
    c = F.col("raw_text")
    cut = text.truncated(c, F.col("finish_reason"), F.col("output_tokens"))
    return frame(spark, sf_dir, fx.STAGE1_RAW).select("id", "prompt_id", "attempt", "raw_text", cut.alias("cut"), text.incomplete_bullet(c).alias("bullet"), text.label_only(c).alias("label_only"))


@query(f"{_TEXT} SELECT reason, count(*) AS n FROM (SELECT unnest(errors) AS reason FROM e) GROUP BY 1")
def stage1_reason_counts(spark, sf_dir):
    return annotate.reason_counts(_stage1(spark, sf_dir))


_CHOSEN = "good AS (SELECT * FROM e WHERE len(errors) = 0 QUALIFY row_number() OVER (PARTITION BY id, prompt_id ORDER BY attempt, md5(raw_text)) = 1)"


@query(f"""{_TEXT}, {_CHOSEN} SELECT id, max(attempt) AS attempt, max(t) FILTER (prompt_id = 'prompt1') AS o1, max(t) FILTER (prompt_id = 'prompt2') AS o2, max(t) FILTER (prompt_id = 'prompt3') AS o3
    FROM good GROUP BY id HAVING count(*) = 3""")
def stage1_assemble(spark, sf_dir):
    done = annotate.assembled(_stage1(spark, sf_dir))
    return done.select("id", "attempt", *[F.col(f"stage1.prompt{k}.output").alias(f"o{k}") for k in (1, 2, 3)])


@query(f"""{_TEXT} SELECT id, prompt_id, attempt, raw_text FROM e WHERE len(errors) = 0 QUALIFY row_number() OVER (PARTITION BY id, prompt_id ORDER BY attempt DESC, md5(raw_text) DESC) = 1""")
def stage1_last_valid(spark, sf_dir):
    return annotate.chosen(_stage1(spark, sf_dir), "last").select("id", "prompt_id", "attempt", "raw_text")


@query(f"""WITH m AS ({fx.STAGE1_MANIFEST}) SELECT id, 'prompt' || k AS prompt_id, 'Look closely. Given label: ' || label || '. Section ' || k || '.' AS prompt FROM m, (VALUES (1), (2), (3)) t(k)""")
def rewritten_prompts(spark, sf_dir):
    prompts = annotate.rewritten(annotate.prompt_dim(spark, TEMPLATES), "Look closely. ", {"Ground truth": "Given label", "Part": "Section"})
    return annotate.fan_out(frame(spark, sf_dir, fx.STAGE1_MANIFEST), prompts).select("id", "prompt_id", "prompt")


_LISTED = "SELECT concat('/images/', cast(cast(floor(doc_id / 3) AS bigint) AS varchar(20)), '.jpg') AS path FROM documents WHERE doc_id % 5 <> 0 AND doc_id % 3 = 1"


@query(f"""WITH m AS ({fx.MANIFEST}), f AS ({_LISTED}) SELECT id, 'image_not_found' AS errors FROM m WHERE image_path NOT IN (SELECT path FROM f)""")
def missing_images(spark, sf_dir):
    gone = annotate.missing_images(frame(spark, sf_dir, fx.MANIFEST), frame(spark, sf_dir, _LISTED))
    return gone.select("id", F.array_join("validation_errors", ";").alias("errors"))


_PLAN = """, m AS ({m}), pairs AS (SELECT id, label, 'prompt' || k AS prompt_id, k FROM m, (VALUES (1), (2), (3)) t(k))"""


@query(f"""{_TEXT}{_PLAN.format(m=fx.STAGE1_MANIFEST)}, open AS (SELECT * FROM pairs ANTI JOIN (SELECT DISTINCT id, prompt_id FROM e WHERE len(errors) = 0) v USING (id, prompt_id)),
    nxt AS (SELECT id, prompt_id, max(attempt) + 1 AS a FROM e GROUP BY 1, 2)
    SELECT id, label, prompt_id, 'Ground truth: ' || label || '. Part ' || k || '.' AS prompt, coalesce(a, 0) AS attempt FROM open LEFT JOIN nxt USING (id, prompt_id) WHERE coalesce(a, 0) < 3""")
def stage1_plan(spark, sf_dir):
    prompts = annotate.prompt_dim(spark, TEMPLATES)
    return annotate.work_list(frame(spark, sf_dir, fx.STAGE1_MANIFEST), prompts, _stage1(spark, sf_dir)).select("id", "label", "prompt_id", "prompt", "attempt")


@query(f"""{_TEXT}{_PLAN.format(m=fx.STAGE1_MANIFEST)}, open AS (SELECT * FROM pairs ANTI JOIN (SELECT DISTINCT id, prompt_id FROM e WHERE len(errors) = 0) v USING (id, prompt_id)),
    last AS (SELECT id, prompt_id, arg_max(errors, attempt) AS errors FROM e GROUP BY 1, 2),
    each AS (SELECT id, prompt_id, list_transform(coalesce(errors, ['missing_output']), lambda x: prompt_id || ': ' || x) AS l FROM open LEFT JOIN last USING (id, prompt_id))
    SELECT id, array_to_string(flatten(list(l ORDER BY prompt_id)), ';') AS errors FROM each GROUP BY id""")
def stage1_failures(spark, sf_dir):
    rows = annotate.failures(frame(spark, sf_dir, fx.STAGE1_MANIFEST), _stage1(spark, sf_dir))
    return rows.select("id", F.array_join("errors", ";").alias("errors"))


@query(f"""{_TEXT} SELECT id, prompt_id, attempt, attempt + 1 AS next_attempt, array_to_string(errors, ';') AS errors FROM e WHERE len(errors) > 0 AND attempt + 1 < 3""")
def stage1_retries(spark, sf_dir):
    rows = annotate.retries(_stage1(spark, sf_dir))
    return rows.select("id", "prompt_id", "attempt", "next_attempt", F.array_join("validation_errors", ";").alias("errors"))


@query(f"""WITH m AS ({fx.STAGE1_MANIFEST}) SELECT id, 'prompt' || k AS prompt_id, 'echo ' || length('Ground truth: ' || label || '. Part ' || k || '.') AS output_text FROM m, (VALUES (1), (2), (3)) t(k)""")
def annotate_stub(spark, sf_dir):
    work = annotate.fan_out(frame(spark, sf_dir, fx.STAGE1_MANIFEST), annotate.prompt_dim(spark, TEMPLATES)).select("id", "prompt_id", "prompt")

    def call(batch):
        return batch[["id", "prompt_id"]].assign(output_text="echo " + batch["prompt"].str.len().astype(str))

    return annotate.annotate(work, call, "id string, prompt_id string, output_text string")


# Judgements -----------------------------------------------------------------------------------------


# Fixed values once more: what the SQL expects to be asked, and the keys and criteria.
_QUESTION = "<image>\nIs this image real or generated by AI? Please analyze visual forensic evidence and output the structured JSON judgment."
_RETRY_SUFFIX = "\n\nReturn only the JSON object, complete and with the exact keys and order."
_TOP_KEYS = ["per_criterion", "overall_likelihood"]
_CRITERIA = [
    "Lighting & Shadows Consistency",
    "Edges & Boundaries",
    "Texture & Resolution",
    "Perspective & Spatial Relationships",
    "Physical & Common Sense Logic",
    "Text & Symbols",
    "Human & Biological Structure Integrity",
    "Material & Object Details",
]


def _judged(raw: str, label: str) -> str:
    """DuckDB expression of the error list; json_valid has been checked where the paths are read."""
    j = f"CASE WHEN json_valid({raw}) THEN {raw} ELSE '{{}}' END"
    n = f"json_array_length({j}, '$.per_criterion')"
    rules = [f"CASE WHEN json_keys({j}) <> {_in(_TOP_KEYS).replace('(', '[').replace(')', ']')} THEN 'top_level_keys_or_order_invalid' END"]
    for i, name in enumerate(_CRITERIA):
        at, p = f"$.per_criterion[{i}]", f"per_criterion[{i}]_"
        score = f"json_type({j}, '{at}.\"aigc score\"')"
        rules += [
            f"CASE WHEN json_extract_string({j}, '{at}.criterion') <> '{name}' THEN '{p}criterion_mismatch' END",
            f"CASE WHEN trim(json_extract_string({j}, '{at}.evidence')) = '' THEN '{p}evidence_empty' END",
            f"CASE WHEN {score} NOT IN ('UBIGINT', 'BIGINT') THEN '{p}aigc_score_not_int' WHEN json_extract_string({j}, '{at}.\"aigc score\"') NOT IN ('0', '1') THEN '{p}aigc_score_not_0_or_1' END",
        ]
    overall = f"json_extract_string({j}, '$.overall_likelihood')"
    any_one = " OR ".join(f"coalesce(json_type({j}, '$.per_criterion[{i}].\"aigc score\"') IN ('UBIGINT', 'BIGINT') AND json_extract_string({j}, '$.per_criterion[{i}].\"aigc score\"') = '1', false)" for i in range(8))
    rules += [
        f"CASE WHEN {label} = 'REAL' AND {overall} <> 'Real' THEN 'label_REAL_requires_overall_Real' END",
        f"CASE WHEN {label} = 'AI-GENERATED' AND {overall} <> 'AI-Generated' THEN 'label_AI_GENERATED_requires_overall_AI_Generated' END",
        f"CASE WHEN {label} = 'AI-GENERATED' AND NOT ({any_one}) THEN 'label_AI_GENERATED_requires_at_least_one_aigc_score_1' END",
    ]
    assert n
    return f"CASE WHEN NOT json_valid({raw}) THEN ['json_parse_error'] WHEN json_type({j}) <> 'OBJECT' THEN ['top_level_not_object'] ELSE list_filter([{', '.join(rules)}], lambda x: x IS NOT NULL) END"


_JUDGED = f"WITH raw AS ({fx.STAGE2_RAW}), v AS (SELECT *, {_judged('raw_text', 'label')} AS errors, raw_text AS compact FROM raw)"
_BEST = "ORDER BY len(errors) = 0 DESC, CASE WHEN len(errors) = 0 THEN attempt END ASC NULLS LAST, attempt DESC"


def _codes(errors: str):
    """Errors as one text, the parser's own words left out."""
    return F.array_join(F.transform(errors, lambda e: F.split_part(e, F.lit(":"), F.lit(1))), ";").alias("errors")


def _stage2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge.validated(frame(spark, sf_dir, fx.STAGE2_RAW))


@query(f"{_JUDGED} SELECT id, attempt, array_to_string(errors, ';') AS errors, len(errors) = 0 AS valid FROM v")
def stage2_validate(spark, sf_dir):
    return _stage2(spark, sf_dir).select("id", "attempt", _codes("validation_errors"), "valid")


@query(f"{_JUDGED} SELECT id, attempt, array_to_string(errors, ';') AS errors, len(errors) = 0 AS valid FROM v")
def stage2_validate_native(spark, sf_dir):
    raw = frame(spark, sf_dir, fx.STAGE2_RAW).withColumn("shape", judgement.describe_native(F.col("raw_text")))
    told = raw.withColumn("e", judgement.errors("shape", F.col("label")))
    return told.select("id", "attempt", _codes("e"), (F.size("e") == 0).alias("valid"))


@query(f"{_JUDGED} SELECT 0 AS n_differ, count(*) AS n FROM v")
def stage2_opinions(spark, sf_dir):
    """How often the strict parse and the native one tell other errors."""
    raw = frame(spark, sf_dir, fx.STAGE2_RAW)
    both = raw.withColumn("strict", judgement.describe(F.col("raw_text"))).withColumn("native", judgement.describe_native(F.col("raw_text")))
    told = both.select(*[_codes(judgement.errors(c, F.col("label"))).alias(c) for c in ("strict", "native")])
    return told.agg(F.count_if(F.col("strict") != F.col("native")).cast("int").alias("n_differ"), F.count("*").alias("n"))


@query(f"{_JUDGED} SELECT id, attempt, len(errors) = 0 AS valid, array_to_string(errors, ';') AS errors FROM v QUALIFY row_number() OVER (PARTITION BY id {_BEST}) = 1")
def stage2_best_attempt(spark, sf_dir):
    return judge.best_attempts(_stage2(spark, sf_dir)).select("id", "attempt", "valid", _codes("validation_errors"))


_REVALIDATED = f"""WITH raw AS ({fx.STAGE2_RAW}), m AS ({fx.MANIFEST}), j AS (SELECT r.id, r.attempt, r.raw_text, coalesce(m.label, r.label) AS label, m.id IS NOT NULL AS known FROM raw r LEFT JOIN m USING (id)),
    v AS (SELECT *, {_judged('raw_text', 'label')} AS found FROM j), w AS (SELECT *, CASE WHEN known THEN found ELSE list_append(found, 'sample_missing_from_manifest') END AS errors FROM v),
    result AS (SELECT id, label, attempt, len(errors) = 0 AS valid, errors, CASE WHEN len(errors) = 0 THEN raw_text END AS compact FROM w QUALIFY row_number() OVER (PARTITION BY id {_BEST}) = 1
    UNION ALL SELECT id, label, NULL, false, ['missing_stage2_output'], NULL FROM m ANTI JOIN raw USING (id))"""


@query(f"{_REVALIDATED} SELECT id, label, attempt, valid, array_to_string(errors, ';') AS errors, compact FROM result")
def stage2_revalidate(spark, sf_dir):
    rows = judge.revalidated(frame(spark, sf_dir, fx.STAGE2_RAW), frame(spark, sf_dir, fx.MANIFEST))
    return rows.select("id", "label", "attempt", "valid", _codes("errors"), "compact")


@query(f"""{_REVALIDATED} SELECT (SELECT count(*) FROM m) AS total_manifest, (SELECT count(*) FROM raw) AS total_stage2_raw, count(*) FILTER (valid) AS total_valid, count(*) FILTER (NOT valid) AS total_invalid,
    count(*) FILTER (list_contains(errors, 'missing_stage2_output')) AS missing, count(*) FILTER (valid AND label = 'REAL') AS real_valid, count(*) FILTER (valid AND label = 'AI-GENERATED') AS fake_valid FROM result""")
def validation_report(spark, sf_dir):
    log, known = frame(spark, sf_dir, fx.STAGE2_RAW), frame(spark, sf_dir, fx.MANIFEST)
    return judge.validation_report(judge.revalidated(log, known), log, known)


@query(f"""{_JUDGED} SELECT reason, count(*) AS n FROM (SELECT regexp_replace(unnest(errors), '\\[[0-9]+\\]', '[]') AS reason FROM v) GROUP BY 1""")
def stage2_reason_counts(spark, sf_dir):
    return annotate.reason_counts(_stage2(spark, sf_dir))


@query(f"""{_JUDGED} SELECT id, attempt, i AS position, json_extract_string(raw_text, '$.per_criterion[' || i || '].criterion') AS criterion, json_extract_string(raw_text, '$.per_criterion[' || i || '].evidence') AS evidence,
    cast(json_extract_string(raw_text, '$.per_criterion[' || i || ']."aigc score"') AS bigint) AS score FROM v, range(8) t(i) WHERE len(errors) = 0""")
def criteria_flat(spark, sf_dir):
    return judge.criteria(_stage2(spark, sf_dir)).withColumn("position", F.col("position").cast("long"))


_STAGE1_DONE = f"done AS ({fx.STAGE1_DONE})"


def _stage1_done(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.struct(*[F.struct(F.col(f"o{k}").alias("output")).alias(f"prompt{k}") for k in (1, 2, 3)])
    return frame(spark, sf_dir, fx.STAGE1_DONE).select("id", "label", said.alias("stage1"))


_RENDER = "'Label ' || label || chr(10) || '1 ' || o1 || chr(10) || '2 ' || replace(o2, '{STAGE1_OUTPUT_3}', coalesce(o3, '')) || chr(10) || '3 ' || coalesce(o3, '')"


@query(f"WITH {_STAGE1_DONE} SELECT id, {_RENDER} AS prompt FROM done")
def render_stage2_prompt(spark, sf_dir):
    rows = _stage1_done(spark, sf_dir)
    return rows.select("id", judge.rendered(JUDGE_TEMPLATE, F.col("label"), [F.col(f"stage1.prompt{k}.output") for k in (1, 2, 3)]).alias("prompt"))


_LEFT = f"{_JUDGED}, {_STAGE1_DONE}, good AS (SELECT DISTINCT id FROM v WHERE len(errors) = 0 AND coalesce(error, '') = ''), nxt AS (SELECT id, max(attempt) + 1 AS a FROM raw WHERE id <> 'x' GROUP BY id)"


@query(f"""{_LEFT} SELECT id, label, coalesce(a, 0) AS attempt, {_RENDER} || CASE WHEN coalesce(a, 0) > 0 THEN '{_RETRY_SUFFIX}' ELSE '' END AS prompt FROM done ANTI JOIN good USING (id) LEFT JOIN nxt USING (id) WHERE coalesce(a, 0) < 3""")
def stage2_plan(spark, sf_dir):
    return judge.work_list(_stage1_done(spark, sf_dir), frame(spark, sf_dir, fx.STAGE2_RAW), JUDGE_TEMPLATE)


@query(f"""{_LEFT} SELECT id, 'stage2_not_valid_after_retries' AS errors FROM done ANTI JOIN good USING (id) JOIN nxt USING (id) WHERE a >= 3""")
def stage2_exhausted(spark, sf_dir):
    return judge.exhausted(_stage1_done(spark, sf_dir), frame(spark, sf_dir, fx.STAGE2_RAW)).select("id", F.array_join("errors", ";").alias("errors"))


_SFT = f"""{_JUDGED}, {_STAGE1_DONE}, m AS ({fx.MANIFEST}), best AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY id {_BEST}) = 1),
    s AS (SELECT best.id, '/raw/' || best.id AS image_path, raw_text, CASE WHEN m.id IS NULL THEN best.label ELSE m.label END AS label, coalesce(m.image_path, '/raw/' || best.id) AS image, errors, attempt, o1, o2, o3 FROM best LEFT JOIN done ON done.id = best.id LEFT JOIN m ON m.id = best.id),
    t AS (SELECT *, CASE WHEN o1 IS NULL OR o2 IS NULL OR o3 IS NULL THEN ['missing_stage1_prompt_outputs'] WHEN len(errors) > 0 THEN errors END AS skip FROM s)"""


def _sft(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = judge.best_attempts(_stage2(spark, sf_dir))
    model = F.when(F.col("attempt") == 0, F.lit("")).otherwise(F.concat(F.lit("m"), F.col("attempt").cast("string")))
    stage2 = best.select("id", "label", F.concat(F.lit("/raw/"), "id").alias("image_path"), F.col("raw_text").alias("stage2_json_string"), model.alias("model"))
    return judge.sft_rows(stage2, _stage1_done(spark, sf_dir), frame(spark, sf_dir, fx.MANIFEST), "generator")


@query(f"""{_SFT} SELECT id, image, label, '{_QUESTION}' AS user_content, raw_text AS assistant_content, o1, o2, o3, CASE WHEN attempt = 0 THEN 'generator' ELSE 'm' || attempt END AS generator_model, 'xhigh' AS reasoning_effort FROM t WHERE skip IS NULL""")
def sft_build(spark, sf_dir):
    rows = _sft(spark, sf_dir).where("skip is null")
    outputs = [F.col(f"stage1_outputs.prompt{k}").alias(f"o{k}") for k in (1, 2, 3)]
    return rows.select("id", "image", "label", F.col("messages")[0]["content"].alias("user_content"), F.col("messages")[1]["content"].alias("assistant_content"), *outputs, "generator_model", "reasoning_effort")


@query(f"""{_SFT} SELECT id, raw_text AS assistant_content FROM t WHERE skip IS NULL""")
def sft_from_structs(spark, sf_dir):
    """Records whose judgements are given as structs, not as texts."""
    best = judge.best_attempts(_stage2(spark, sf_dir)).where("valid")
    shape = "struct<per_criterion:array<struct<criterion:string,evidence:string,`aigc score`:int>>,overall_likelihood:string>"
    stage2 = best.select("id", "label", F.lit("/raw").alias("image_path"), F.from_json("raw_text", shape).alias("stage2_json"))
    rows = judge.sft_rows(stage2, _stage1_done(spark, sf_dir), frame(spark, sf_dir, fx.MANIFEST), "generator").where("skip is null")
    return rows.select("id", F.col("messages")[1]["content"].alias("assistant_content"))


@query(f"""WITH raw AS ({fx.STAGE2_RAW}) SELECT id, attempt, raw_text FROM raw WHERE attempt <> 1 UNION ALL SELECT id, attempt, '{{"per_criterion":null,"overall_likelihood":"Real"}}' FROM raw WHERE attempt = 1""")
def attempts_fallback(spark, sf_dir):
    """Without a log, what was found valid before is taken: texts, structs, or the raw answers."""
    raw = frame(spark, sf_dir, fx.STAGE2_RAW)
    shape = "struct<per_criterion:array<string>,overall_likelihood:string>"
    struct = F.from_json(F.when(F.col("attempt") == 1, '{"overall_likelihood":"Real"}'), shape)
    valid = raw.select("id", "attempt", F.when(F.col("attempt") == 0, F.col("raw_text")).alias("stage2_json_string"), struct.alias("stage2_json"), "raw_text")
    return judge.source_of_attempts(raw.limit(0), valid).select("id", "attempt", "raw_text")


@query(f"{_SFT} SELECT id, array_to_string(skip, ';') AS errors FROM t WHERE skip IS NOT NULL")
def sft_skips(spark, sf_dir):
    return _sft(spark, sf_dir).where("skip is not null").select("id", _codes("skip"))


@query(f"""{_SFT} SELECT count(*) AS total, count(*) FILTER (skip IS NULL) AS written, count(*) FILTER (coalesce(list_contains(skip, 'missing_stage1_prompt_outputs'), false)) AS skipped_missing_stage1,
    count(*) FILTER (skip IS NOT NULL AND NOT list_contains(skip, 'missing_stage1_prompt_outputs')) AS skipped_invalid, count(*) FILTER (skip IS NULL AND label = 'REAL') AS real_written, count(*) FILTER (skip IS NULL AND label = 'AI-GENERATED') AS fake_written FROM t""")
def sft_report(spark, sf_dir):
    return judge.sft_report(_sft(spark, sf_dir))


# Paths, columns, logs -------------------------------------------------------------------------------

_PATHS = f"WITH p AS ({fx.PATHS})"
_UP = f"{_PATHS}, up AS (SELECT path, array_to_string(string_split(path, '/')[1:k], '/') AS directory, k = len(string_split(path, '/')) - 1 AS own FROM p, range(100) t(k) WHERE k < len(string_split(path, '/')))"


@query(f"{_UP} SELECT directory, count(*) FILTER (own) AS n_direct, count(*) AS n_recursive FROM up GROUP BY 1")
def dir_rollup(spark, sf_dir):
    return paths.directory_counts(frame(spark, sf_dir, fx.PATHS))


@query(f"{_UP} SELECT lower(string_split(directory, '/')[-1]) AS class, directory, count(*) AS n_images FROM up WHERE regexp_matches(lower(path), '\\.(jpg|jpeg|png|webp|bmp)$') AND lower(string_split(directory, '/')[-1]) IN ('real', 'fake') GROUP BY 1, 2")
def class_dirs(spark, sf_dir):
    return paths.class_directories(paths.images(frame(spark, sf_dir, fx.PATHS)))


@query(f"{_PATHS} SELECT DISTINCT path FROM p WHERE regexp_matches('/' || path, '/real/') AND regexp_matches('/' || path, '/Fake/')")
def overlap(spark, sf_dir):
    return paths.overlap(frame(spark, sf_dir, fx.PATHS))


_REPORT = f"""{_UP}, i AS (SELECT path, regexp_matches('/' || path, '/real/') AS is_real, regexp_matches('/' || path, '/Fake/') AS is_fake FROM p WHERE regexp_matches(lower(path), '\\.(jpg|jpeg|png|webp|bmp)$')),
    r AS (SELECT (SELECT count(DISTINCT directory) FROM up) AS n_directories, count(*) AS n_images, count(*) FILTER (is_real) AS found_real, count(*) FILTER (is_fake) AS found_fake, count(*) FILTER (is_real AND is_fake) AS overlap_count FROM i)"""


@query(f"{_REPORT} SELECT * FROM r")
def prepare_report(spark, sf_dir):
    return paths.prepare_report(frame(spark, sf_dir, fx.PATHS))


@query(f"""{_REPORT} SELECT 'class_overlap' AS gate, 'both' AS value, overlap_count AS n FROM r WHERE overlap_count > 0 UNION ALL SELECT 'missing_class_folder', 'real', found_real FROM r WHERE found_real = 0
    UNION ALL SELECT 'missing_class_folder', 'fake', found_fake FROM r WHERE found_fake = 0""")
def path_gates(spark, sf_dir):
    return paths.gate_violations(frame(spark, sf_dir, fx.PATHS))


@query(f"{_PATHS} SELECT page_id, regexp_matches(string_split(lower(path), '?')[1], '\\.(jpg|jpeg|png|webp|bmp)$') AS by_path, regexp_matches(string_split(lower(link), '?')[1], '\\.(jpg|jpeg|png|webp|bmp)$') AS by_link FROM p")
def image_like(spark, sf_dir):
    return frame(spark, sf_dir, fx.PATHS).select("page_id", labels.image_like(F.col("path")).alias("by_path"), labels.image_like(F.col("link")).alias("by_link"))


@query(f"""WITH src AS ({fx.SRC}), x AS (SELECT split, coalesce(raw_label, 'none') AS raw_label, cast(global_index % 4 AS bigint) AS target FROM src),
    k AS (SELECT *, CASE WHEN raw_label IN ('real', 'Authentic / photo', 'REAL') THEN 'real' WHEN raw_label IN ('Tampered image', 'manipulated') THEN 'tampered' WHEN raw_label IN ('Fully-Synthetic', 'AI generated') THEN 'synthetic' END AS kind FROM x),
    s AS (SELECT 'split' AS "column", split AS v, count(DISTINCT kind) AS kinds, min(kind) AS kind FROM k GROUP BY 2 UNION ALL SELECT 'target', cast(target AS varchar), count(DISTINCT kind), min(kind) FROM k GROUP BY 2 UNION ALL SELECT 'raw_label', raw_label, 0, NULL FROM k GROUP BY 2),
    g AS (SELECT "column", count(*) AS n_distinct, coalesce(max(kinds) = 1, false) AS single, count(DISTINCT kind) AS categories FROM s GROUP BY 1)
    SELECT "column", n_distinct, cast(CASE "column" WHEN 'target' THEN 11 ELSE 0 END + CASE WHEN n_distinct <= 10 THEN 2 ELSE 0 END + CASE WHEN single THEN 3 ELSE 0 END + CASE WHEN categories > 1 THEN 3 ELSE 0 END AS int) AS score FROM g WHERE n_distinct BETWEEN 2 AND 20""")
def label_column_scores(spark, sf_dir):
    rows = frame(spark, sf_dir, fx.SRC).select("split", F.coalesce("raw_label", F.lit("none")).alias("raw_label"), (F.col("global_index") % 4).alias("target"))
    return profile.label_scores(rows)


@query(f"""WITH c AS ({fx.CARD}), p AS (SELECT event_id, regexp_extract(line, '^- ([0-9]+) : (.*)$', 1) AS raw_value, regexp_extract(line, '^- ([0-9]+) : (.*)$', 2) AS label_text FROM c),
    k AS (SELECT *, CASE label_text WHEN 'real photo' THEN 'real' WHEN 'fully synthetic' THEN 'synthetic' WHEN 'edited' THEN 'tampered' END AS category FROM p)
    SELECT raw_value, arg_max(label_text, event_id) AS label_text, arg_max(category, event_id) AS category, CASE arg_max(category, event_id) WHEN 'real' THEN 'real' WHEN 'synthetic' THEN 'fully_synthetic' ELSE 'edited' END AS label_name FROM k WHERE category IS NOT NULL GROUP BY 1""")
def card_label_map(spark, sf_dir):
    return io.card_labels(frame(spark, sf_dir, fx.CARD), "line", "event_id")


@query(f"""WITH r AS ({fx.RESPONSES}) SELECT conv_id, turn, json_extract_string(raw_response, '$.output[1].content[0].text') || json_extract_string(raw_response, '$.output[1].content[2].text') AS output_text,
    CASE turn % 4 WHEN 1 THEN 'max_output_tokens' WHEN 2 THEN 'incomplete' WHEN 3 THEN 'failed' END AS finish_reason, cast(json_extract_string(raw_response, '$.usage.output_tokens') AS bigint) AS output_tokens FROM r""")
def response_extract(spark, sf_dir):
    return responses.extract(frame(spark, sf_dir, fx.RESPONSES)).drop("raw_response")


@query("""SELECT doc_id, 'data:image/' || CASE doc_id % 3 WHEN 0 THEN 'jpeg' WHEN 1 THEN 'webp' ELSE 'png' END || ';base64,' || to_base64(encode(text)) AS url FROM documents""")
def data_url(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    name = F.when(F.col("doc_id") % 3 == 0, "a.JPG").when(F.col("doc_id") % 3 == 1, "b.webp").otherwise("c.gif")
    return rows.select("doc_id", labels.data_url(name, F.encode("text", "UTF-8")).alias("url"))


# Sources and payloads -------------------------------------------------------------------------------


@query(f"""WITH l AS ({fx.LINES}) SELECT doc_id, CASE WHEN form IN (1, 4, 6) THEN 'not_json' WHEN form IN (2, 5) THEN 'repeated_key' END AS problem,
    CASE WHEN form = 0 THEN cast(regexp_extract(value, '"a":([0-9]+)', 1) AS int) END AS a, CASE WHEN form = 0 THEN regexp_extract(value, '"b":"([a-z]+)"', 1) END AS b FROM l WHERE form <> 3""")
def jsonl_quarantine(spark, sf_dir):
    rows, bad = io.parsed(frame(spark, sf_dir, fx.LINES), "a int, b string", unique_keys=True)
    none = F.lit(None)
    return rows.select("doc_id", none.cast("string").alias("problem"), "a", "b").unionByName(bad.select("doc_id", "problem", none.cast("int").alias("a"), none.cast("string").alias("b")))


@query("""WITH l AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM labels), d AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM documents)
    SELECT 'labels' AS split, doc_id, i AS split_index, i AS global_index FROM l UNION ALL SELECT 'documents', doc_id, i, i + (SELECT count(*) FROM l) FROM d""")
def split_index(spark, sf_dir):
    found = io.read_splits(spark, {t: f"{sf_dir}/{t}.parquet" for t in ("labels", "documents")}, ["doc_id"])
    return found.select("split", "doc_id", "split_index", "global_index")


@query(f"""WITH p AS ({fx.PATHS}), f AS (SELECT DISTINCT path FROM p), up AS (SELECT path, unnest(list_transform(range(len(string_split(path, '/'))), lambda k: array_to_string(string_split(path, '/')[1 : k], '/'))) AS directory FROM f),
    i AS (SELECT directory, path, regexp_replace(path, '/?[^/]*$', '') = directory AS own FROM up WHERE regexp_matches(lower(path), '\\.(jpg|jpeg|png|webp|bmp)$'))
    SELECT directory, count(path) FILTER (own) AS n_direct, count(path) AS n_recursive FROM (SELECT DISTINCT directory FROM up) LEFT JOIN i USING (directory) GROUP BY 1""")
def dir_rollup_all(spark, sf_dir):
    """Counts of images for every directory, of those without any too."""
    files = frame(spark, sf_dir, f"SELECT DISTINCT path FROM ({fx.PATHS})")
    every = files.select(F.explode(paths.parents(F.col("path"))).alias("directory")).distinct()
    return paths.every_directory(every, paths.images(files))


@query("""SELECT doc_id, CASE doc_id % 4 WHEN 1 THEN 'remote_path' WHEN 2 THEN 'image_missing_bytes_or_path' WHEN 3 THEN 'unsupported_image_value' END AS problem,
    CASE WHEN doc_id % 4 = 0 THEN octet_length(encode(text)) END AS n_bytes FROM documents""")
def payload_forms(spark, sf_dir):
    image = "CASE doc_id % 4 WHEN 0 THEN struct(encode(text, 'UTF-8') AS bytes, 'ignored.png' AS path) WHEN 1 THEN struct(cast(null AS binary) AS bytes, concat('https://host/', doc_id) AS path) WHEN 2 THEN struct(cast(null AS binary) AS bytes, '' AS path) END"
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id", f"{image} AS image")
    found = payloads.resolved(rows, "image", sf_dir)
    return found.select("doc_id", "problem", F.octet_length("content").cast("long").alias("n_bytes"))


@query("""WITH p AS (SELECT page_id, 1 + page_id % 40 AS w, 1 + length(url) % 30 AS h FROM pages)
    SELECT page_id, CASE page_id % 5 WHEN 2 THEN NULL WHEN 4 THEN NULL ELSE 'bmp' END AS format, CASE page_id % 5 WHEN 0 THEN w WHEN 3 THEN 0 END::INT AS width, CASE WHEN page_id % 5 IN (0, 3) THEN h END::INT AS height,
    CASE WHEN page_id % 5 IN (0, 3) THEN 'RGB' END AS mode, CASE page_id % 5 WHEN 1 THEN 'truncated' WHEN 2 THEN 'empty' WHEN 3 THEN 'non_positive_dimensions' WHEN 4 THEN 'unknown_format' END AS reason FROM p""")
def payload_verify(spark, sf_dir):
    rows = frame(spark, sf_dir, fx.PAYLOADS).select("page_id", F.unhex("content").alias("content"))
    return payloads.verified(rows).select("page_id", "format", "width", "height", "mode", "reason")


@query("""SELECT split, doc_id FROM (SELECT 'labels' AS split, doc_id, row_number() OVER (ORDER BY doc_id) AS i FROM labels UNION ALL SELECT 'documents', doc_id, row_number() OVER (ORDER BY doc_id) FROM documents) WHERE i <= 100""")
def quick_scan(spark, sf_dir):
    """The first 100 rows of each split, which is what a quick scan is."""
    rows = io.read_splits(spark, {t: f"{sf_dir}/{t}.parquet" for t in ("labels", "documents")}, ["doc_id"])
    return io.quick_scan(rows, 100).select("split", "doc_id")


@query("""SELECT '{"doc_id":' || doc_id || ',"lang":"' || lang || '","quality":' || coalesce(cast(quality AS varchar), 'null') || '}' AS value FROM documents LEFT JOIN labels USING (doc_id)""")
def jsonl_written(spark, sf_dir):
    """Lines as they are written, keys that are null kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    rows = docs.join(spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality"), "doc_id", "left")
    path = f"{work.folder(spark)}/lines-{uuid.uuid4().hex}"
    io.write_jsonl(rows, path)
    return spark.read.text(path)
