"""Inputs of the registered queries, derived from the given tables by SQL that Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from annospark.functions.judgement import CRITERIA

SRC = """
    SELECT d.doc_id AS global_index, d.lang AS split, d.source AS source, d.n_chars AS n_chars,
        CASE WHEN l.doc_id IS NULL THEN NULL
            WHEN l.toxic = 1 AND d.doc_id % 2 = 0 THEN 'Tampered image'
            WHEN l.toxic = 1 THEN 'manipulated'
            WHEN l.quality = 1 AND d.doc_id % 3 = 0 THEN 'real'
            WHEN l.quality = 1 AND d.doc_id % 3 = 1 THEN 'Authentic / photo'
            WHEN l.quality = 1 THEN 'REAL'
            WHEN d.doc_id % 2 = 0 THEN 'Fully-Synthetic'
            ELSE 'AI generated' END AS raw_label
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""

STAGE1_RAW = """
    SELECT concat('c', cast(conv_id AS varchar(20))) AS id,
        CASE WHEN conv_id % 2 = 0 THEN 'REAL' ELSE 'AI-GENERATED' END AS label,
        concat('prompt', cast(turn % 3 + 1 AS varchar(20))) AS prompt_id,
        concat('P', cast(turn % 3 + 1 AS varchar(20))) AS prompt,
        cast(floor(turn / 3) AS int) AS attempt,
        CASE WHEN turn % 5 = 4 THEN 'max_output_tokens' END AS finish_reason,
        cast(length(text) % 500 AS int) AS output_tokens,
        CASE WHEN (conv_id + turn) % 11 = 5 THEN 'timeout' END AS error,
        CASE turn % 7 WHEN 0 THEN concat(text, ' due to')
            WHEN 1 THEN concat('- ', text)
            WHEN 2 THEN text
            WHEN 3 THEN 'This image is real.'
            WHEN 4 THEN concat(text, '...')
            ELSE concat(text, ' The shadows are consistent.') END AS raw_text
    FROM conversations
"""


def _escaped(text: str) -> str:
    """A text as it stands inside of a JSON string; the given texts have no other control characters."""
    for code, letter in ((92, "chr(92)"), (34, "chr(34)"), (10, "'n'"), (9, "'t'"), (13, "'r'")):
        text = f"replace({text}, chr({code}), concat(chr(92), {letter}))"
    return text


def _stage2_raw() -> str:
    d, id_ = "doc_id % 13", "cast(floor(doc_id / 3) AS bigint)"
    fake = f"{id_} % 2 = 1"
    items = []
    for i, name in enumerate(CRITERIA):
        shown = f"CASE WHEN {d} = 3 THEN 'Wrong' ELSE '{name}' END" if i == 2 else f"'{name}'"
        # The first criterion's evidence holds the document's whole text.
        said = _escaped("text") if i == 0 else "lang"
        evidence = f"concat('Region ', cast(n_chars AS varchar(20)), ' shows ', {said}, ' cues')"
        evidence = f"CASE WHEN {d} = 8 THEN ' ' ELSE {evidence} END" if i == 4 else evidence
        score = f"CASE WHEN {fake} AND {d} <> 7 AND (doc_id + {i}) % 5 = 0 THEN '1' ELSE '0' END"
        if i == 1:
            score = f"CASE {d} WHEN 4 THEN 'true' WHEN 5 THEN '1.0' WHEN 6 THEN '2' ELSE {score} END"
        items.append(f"""concat('{{"criterion":"', {shown}, '","evidence":"', {evidence}, '","aigc score":', {score}, '}}')""")
    overall = f"CASE WHEN {d} = 1 THEN 'Uncertain' WHEN {fake} THEN 'AI-Generated' ELSE 'Real' END"
    body = f"""concat('{{"per_criterion":[', {", ',', ".join(items)}, '],"overall_likelihood":"', {overall}, '"}}')"""
    raw = f"CASE {d} WHEN 9 THEN concat('Answer: ', {body}) WHEN 10 THEN concat({body}, ' done') WHEN 11 THEN '[]' WHEN 12 THEN '' ELSE {body} END"
    return f"""
    SELECT concat('d', cast({id_} AS varchar(20))) AS id, cast(doc_id % 3 AS int) AS attempt,
        CASE WHEN {fake} THEN 'AI-GENERATED' ELSE 'REAL' END AS label, {raw} AS raw_text,
        CASE WHEN doc_id % 29 = 3 THEN 'timeout' END AS error
    FROM documents
"""


STAGE2_RAW = _stage2_raw()

MANIFEST = """
    SELECT DISTINCT concat('d', cast(cast(floor(doc_id / 3) AS bigint) AS varchar(20))) AS id,
        CASE WHEN cast(floor(doc_id / 3) AS bigint) % 2 = 1 THEN 'AI-GENERATED' ELSE 'REAL' END AS label,
        concat('/images/', cast(cast(floor(doc_id / 3) AS bigint) AS varchar(20)), '.jpg') AS image_path
    FROM documents WHERE cast(floor(doc_id / 3) AS bigint) % 17 <> 0
    UNION ALL
    SELECT concat('d', cast(1000000000 + doc_id AS varchar(20))), 'REAL', '/images/none.jpg' FROM documents WHERE doc_id % 97 = 1
"""

STAGE1_MANIFEST = """
    SELECT DISTINCT concat('c', cast(conv_id AS varchar(20))) AS id,
        CASE WHEN conv_id % 2 = 0 THEN 'REAL' ELSE 'AI-GENERATED' END AS label
    FROM conversations
"""

#: Stage 1 of the stage-2 samples: three outputs, but for every eleventh sample.
STAGE1_DONE = """
    SELECT id, label, concat(id, ' one') AS o1, concat(id, ' two {STAGE1_OUTPUT_3}') AS o2,
        CASE WHEN length(id) % 11 <> 4 THEN concat(id, ' three') END AS o3 FROM ({manifest}) m
""".replace("{manifest}", MANIFEST)

PATHS = """
    SELECT page_id, concat(CASE WHEN page_id % 50 = 0 THEN 'real/Fake/' WHEN page_id % 2 = 0 THEN 'real/' ELSE 'a/Fake/' END,
        regexp_replace(regexp_replace(url, '^[a-z]+:..', ''), '[?#].*$', ''),
        CASE page_id % 4 WHEN 0 THEN '.jpg' WHEN 1 THEN '.PNG' WHEN 2 THEN '.webp' ELSE '.txt' END) AS path,
        CASE WHEN page_id % 3 = 0 THEN concat(url, '.jpg?x') ELSE url END AS link
    FROM pages
"""

RESPONSES = """
    SELECT conv_id, turn, concat('{"status":"', CASE turn % 4 WHEN 0 THEN 'completed' WHEN 3 THEN 'failed' ELSE 'incomplete' END, '"',
        CASE WHEN turn % 4 = 1 THEN ',"incomplete_details":{"reason":"max_output_tokens"}' ELSE '' END,
        ',"usage":{"output_tokens":', CASE WHEN turn % 6 = 5 THEN 'null' ELSE cast(length(text) AS varchar(20)) END, '}',
        ',"output":[{"type":"reasoning"},{"type":"message","content":[{"type":"output_text","text":"', role,
        '"},{"type":"refusal","text":"no"},{"type":"output_text","text":"-', cast(turn AS varchar(20)), '"}]}]}') AS raw_response
    FROM conversations
"""

#: JSON lines: good ones, with text after the object, with a key twice, blank, cut off, with a key twice further in, and not an object.
LINES = """
    SELECT doc_id, doc_id % 7 AS form, CASE doc_id % 7
        WHEN 0 THEN concat('{"a":', cast(n_chars AS varchar(20)), ',"b":"', lang, '"}')
        WHEN 1 THEN concat('  {"b":"', lang, '", "a" : ', cast(n_chars AS varchar(20)), '} done')
        WHEN 2 THEN concat('{"a":1,"b":"x","a":', cast(n_chars AS varchar(20)), '}')
        WHEN 3 THEN '   '
        WHEN 4 THEN concat('{"a":', cast(n_chars AS varchar(20)), ',"b":"', lang)
        WHEN 5 THEN concat('{"a":', cast(n_chars AS varchar(20)), ',"c":[{"d":1,"d":2}]}')
        ELSE concat('{"a":', cast(n_chars AS varchar(20)), '}]') END AS value
    FROM documents
"""


def _byte(x: str) -> str:
    digits = "0123456789abcdef"
    return f"concat(substring('{digits}', cast(floor(({x}) / 16) AS int) + 1, 1), substring('{digits}', cast(({x}) % 16 AS int) + 1, 1))"


#: Images written in hex: BMP of 24 bits, whole, cut off or without width; nothing; text.
PAYLOADS = f"""
    SELECT page_id, CASE page_id % 5 WHEN 2 THEN NULL WHEN 4 THEN '3c68746d6c3e'
        ELSE concat('424d', '00000000', '00000000', '36000000', '28000000', {_byte("w")}, '000000', {_byte("h")}, '000000', '0100', '1800',
            repeat('00', 24), repeat('ff', cast(CASE WHEN page_id % 5 = 1 THEN 1 ELSE 4 * floor((w * 24 + 31) / 32) * h END AS int))) END AS content
    FROM (SELECT page_id, CASE WHEN page_id % 5 = 3 THEN 0 ELSE 1 + page_id % 40 END AS w, 1 + length(url) % 30 AS h FROM pages) p
"""

CARD = """
    SELECT event_id, concat('- ', cast(event_id % 40 AS varchar(20)), ' : ',
        CASE event_id % 5 WHEN 0 THEN 'real photo' WHEN 1 THEN 'fully synthetic' WHEN 2 THEN 'edited' WHEN 3 THEN 'unreal thing' ELSE event_type END) AS line
    FROM events
"""


def views(spark: SparkSession, sf_dir: str) -> None:
    for name in ("documents", "labels", "conversations", "pages", "events", "lineitem"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)


def frame(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """The rows of ``sql`` over the tables of ``sf_dir``."""
    views(spark, sf_dir)
    return spark.sql(sql)
