"""Queries of this subpackage for __spark_entry__.py: production parameters over whole tables."""

from __future__ import annotations

import importlib.util
import os
import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annospark.llm import chat, decontaminate, html, jaccard, lines, merkle, minhash, packing, passages, periodic, quality, rules, secrets
from annospark.llm.scratch import keep, scope, stored


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """A file of the installed public tokenizers; it lies at the same place on every executor."""
    return os.path.join(os.path.dirname(importlib.util.find_spec("public_tokenizers").origin), name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lines.removed_lines(table(spark, sf_dir, "documents"))
    return rows.withColumn("removed", F.array_join("removed", ","))


def op3_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated(table(spark, sf_dir, "documents")).drop("part")


def repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What lines, paragraphs and whole texts alone give, without passages."""
    return passages.repeated(table(spark, sf_dir, "documents"), unit=None).drop("part")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.scored(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secrets.scan(docs, secrets.train(docs))
    return found.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(secrets.joined(["assign", "access", "hex"]), 256).alias("base_sha256"),
        secrets.joined(secrets.KINDS).alias("spans"),
        F.size("markov").cast("long").alias("n_markov"),
        "n_random",
    )


def secret_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What ``op5_secrets`` finds by the fixed patterns."""
    return op5_secrets(spark, sf_dir).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = F.array(*[F.struct(F.lit(i).cast("long").alias("turn"), F.lit(role).alias("role")) for i, role in enumerate(("user", "assistant"))])
    own = spark.range(1).select(F.lit(-1).cast("long").alias("conv_id"), F.explode(turns).alias("t"))
    own = own.select("conv_id", "t.turn", "t.role", F.lit("</s>[INST] ok [/INST]").alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    canon = chat.canonical(chat.records(rows))
    # Records made of rows are valid and of known layouts: none may come without turns.
    unread = F.raise_error(F.concat(F.lit("op6_chat: record not read, conv_id "), F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))))
    canon = canon.withColumn("turns", F.when(F.col("turns").isNull(), unread).otherwise(F.col("turns")))
    return chat.digests(chat.read_back(chat.formatted(canon)))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=2)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), keep_ids=False)


def op9_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.check(table(spark, sf_dir, "documents"))


def rules_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts and fixed limits of ``op9_rules``."""
    return op9_rules(spark, sf_dir).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def _crc(value: Column) -> Column:
    """Unsigned CRC-32 of a number written in decimal; null for null."""
    return F.crc32(value.cast("string").cast("binary"))


def op11_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    h = _crc(F.col("doc_id"))
    # Only the digests are written; texts reach Python in small batches.
    with scope(spark):
        found = periodic.find(docs, planted=F.when(h % 10 == 0, F.floor(h / 10)))
        best = periodic.longest(F.col("runs"))
        line = F.transform("runs", lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]))
        digests = found.withColumn("best", best).select(
            "doc_id",
            F.size("runs").cast("long").alias("n_runs"),
            *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
            F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
            F.sha2(F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
            F.sha2("collapsed", 256).alias("collapsed_sha256"),
        )
        return keep(stored(digests, "periodic"))


def op12_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # What a reader of a copy whose capitals were lost claims for a fifth of the rows.
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    claimed = F.when(_crc(F.col("doc_id")) % 5 == 0, merkle.leaf(text=lowered))
    with scope(spark):
        rows = merkle.manifest(docs, claimed.alias("claimed"))
        folded = merkle.folded(F.coalesce("claimed", "leaf"), F.col("path"))
        digests = rows.select("doc_id", "leaf", "subroot", "root", merkle.proof(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"))
        return keep(stored(digests.withColumn("verified", F.col("folded_root") == F.col("root")), "manifest"))


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_lines": op2_lines,
    "op3_passages": op3_passages,
    "repeated_lines": repeated_lines,
    "op4_quality": op4_quality,
    "op5_secrets": op5_secrets,
    "secret_base": secret_base,
    "op6_chat": op6_chat,
    "op7_minhash": op7_minhash,
    "op8_packing": op8_packing,
    "op9_rules": op9_rules,
    "rules_base": rules_base,
    "op10_html": op10_html,
    "op11_periodic": op11_periodic,
    "op12_jaccard": op12_jaccard,
    "op13_manifest": op13_manifest,
}

#: CRC-32 of a number written in decimal, bit by bit.
CRC = """(SELECT doc_id AS of, xor(list_reduce(list_concat([4294967295], flatten(list_transform(range(1, len(doc_id::VARCHAR) + 1),
            lambda i: [ord((doc_id::VARCHAR)[i])::BIGINT, 0, 0, 0, 0, 0, 0, 0]))), lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1))), 4294967295) AS h
            FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL))"""

ORACLES: dict[str, str] = {
    "op6_chat": """
        WITH rows AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
        ), escaped AS (
            SELECT *, regexp_replace(text, '([<\\[])(\\\\*(?:/?s>|/?INST\\]|<SYS>>|</SYS>>|\\|im_start\\|>|\\|im_end\\|>|\\|endoftext\\|>))', '\\1\\\\\\2', 'g') AS inner_text
            FROM rows
        )
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
            coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
            sum(length('<|im_start|>' || role || chr(10) || inner_text || '<|im_end|>' || chr(10)))::BIGINT AS formatted_chars
        FROM escaped GROUP BY conv_id
    """,
    "op7_minhash": """
        WITH RECURSIVE split AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
            FROM documents
        ), shingle AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 1 THEN w ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM split
        ), size AS (
            SELECT doc_id, count(s)::BIGINT AS n_shingles FROM split LEFT JOIN shingle USING (doc_id) GROUP BY doc_id
        ), ranked AS (
            SELECT doc_id, s, n_shingles, row_number() OVER (PARTITION BY doc_id ORDER BY k, s) AS place
            FROM shingle JOIN (SELECT s, count(*) AS k FROM shingle GROUP BY s) USING (s) JOIN size USING (doc_id)
        ), pair AS (
            SELECT DISTINCT a.doc_id AS x, b.doc_id AS y FROM ranked a JOIN ranked b USING (s)
            WHERE a.doc_id <> b.doc_id AND 100 * a.place <= 20 * a.n_shingles + 100 AND 100 * b.place <= 20 * b.n_shingles + 100
        ), link AS (
            SELECT x, y FROM pair JOIN shingle a ON a.doc_id = x JOIN shingle b ON b.doc_id = y AND b.s = a.s
            JOIN size m ON m.doc_id = x JOIN size n ON n.doc_id = y
            GROUP BY x, y, m.n_shingles, n.n_shingles HAVING 100 * count(*) >= 80 * (m.n_shingles + n.n_shingles - count(*))
        ), reach AS (
            SELECT doc_id, doc_id AS other FROM size UNION SELECT doc_id, y FROM reach JOIN link ON x = other
        )
        SELECT doc_id, n_shingles, min(other) AS component_id, doc_id = min(other) AS kept FROM reach JOIN size USING (doc_id) GROUP BY doc_id, n_shingles
    """,
    "op2_lines": """
        WITH text AS (
            SELECT doc_id, string_split(text, chr(10)) AS l FROM documents
        ), line AS (
            SELECT doc_id, i - 1 AS line, list_distinct(regexp_extract_all(translate(l[i], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+')) AS w
            FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM text)
        ), class AS (
            SELECT list_sort(w) AS w, min((doc_id, line)) AS first FROM line WHERE len(w) > 0 GROUP BY list_sort(w)
        ), word AS (
            SELECT first, len(w) AS n, unnest(w) AS s FROM class
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY first ORDER BY k, s) AS place FROM word JOIN (SELECT s, count(*) AS k FROM word GROUP BY s) USING (s)
        ), pair AS (
            SELECT DISTINCT a.first AS p, b.first AS q FROM ranked a JOIN ranked b USING (s)
            WHERE b.first < a.first AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n) AND 5 * a.place <= a.n + 5 AND 5 * b.place <= b.n + 5
        ), like_earlier AS (
            SELECT DISTINCT p FROM pair JOIN class a ON a.first = p JOIN class b ON b.first = q
            WHERE 9 * len(list_intersect(a.w, b.w)) >= 4 * (len(a.w) + len(b.w))
        ), gone AS (
            SELECT doc_id, line FROM line x JOIN class c ON list_sort(x.w) = c.w
            WHERE (x.doc_id, x.line) <> c.first OR c.first IN (SELECT p FROM like_earlier)
        )
        SELECT doc_id, coalesce(len(l), 0)::BIGINT AS n_lines, count(line)::BIGINT AS n_removed, coalesce(string_agg(line::VARCHAR, ',' ORDER BY line), '') AS removed
        FROM text LEFT JOIN gone USING (doc_id) GROUP BY doc_id, l
    """,
    "repeated_lines": """
        WITH text AS (
            SELECT doc_id, coalesce(text, '') AS t FROM documents WHERE doc_id IS NOT NULL
        ), copy AS (
            SELECT doc_id, t, min(doc_id) OVER (PARTITION BY t) AS kept FROM text
        ), cut AS (
            SELECT doc_id, unnest(string_split(t, chr(10))) AS l, generate_subscripts(string_split(t, chr(10)), 1) AS i FROM text
        ), line AS (
            SELECT doc_id, i, l, coalesce(sum(length(l) + 1) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pre,
                regexp_extract_all(translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM cut
        ), own AS (
            SELECT doc_id, 'line' AS unit, pre + length(l) - length(ltrim(l, SPACE)) AS s, pre + length(rtrim(l, SPACE)) AS e, len(w)::BIGINT AS n,
                array_to_string(w, ' ') AS k, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS block FROM line WHERE len(w) > 0
        ), unit AS (
            SELECT doc_id, unit, s, e, n, k FROM own
            UNION ALL
            SELECT doc_id, 'paragraph', min(s), max(e), sum(n)::BIGINT, string_agg(k, ' ' ORDER BY s) FROM own GROUP BY doc_id, block HAVING count(*) > 1
        ), later AS (
            SELECT u.*, first FROM unit u JOIN (SELECT k, min({'d': doc_id, 's': s}) AS first FROM unit WHERE n >= 5 GROUP BY k HAVING count(*) > 1) USING (k)
            WHERE n >= 5 AND {'d': doc_id, 's': s} <> first AND doc_id IN (SELECT doc_id FROM copy WHERE kept = doc_id)
        )
        SELECT doc_id, s AS start, e AS "end", n AS n_words, first.d AS kept_doc_id, unit FROM later a
        WHERE unit = 'paragraph' OR NOT EXISTS (SELECT 1 FROM later b WHERE b.doc_id = a.doc_id AND b.unit = 'paragraph' AND b.s <= a.s AND a.e <= b.e)
        UNION ALL
        SELECT doc_id, length(t) - length(ltrim(t, SPACE)), length(rtrim(t, SPACE)), len(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+'))::BIGINT AS n, kept, 'text'
        FROM copy WHERE kept < doc_id AND n >= 5
    """.replace("SPACE", "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"),
    "secret_base": """
        WITH pattern AS (
            SELECT '(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\\x20*[:=]\\x20*["'']?' AS h
        ), text AS (
            SELECT doc_id, coalesce(text, '') AS t FROM documents
        ), cut AS (
            SELECT doc_id, 0 AS i, 'assign' AS kind, regexp_extract_all(t, h || '[A-Za-z0-9+/_.=-]+') AS m, string_split_regex(t, h || '[A-Za-z0-9+/_.=-]+') AS b, h
            FROM text, pattern
            UNION ALL
            SELECT doc_id, 1, 'access', regexp_extract_all(t, 'AKIA[A-Z0-9]{12,}'), string_split_regex(t, 'AKIA[A-Z0-9]{12,}'), '' FROM text
            UNION ALL
            SELECT doc_id, 2, 'hex', regexp_extract_all(t, '[0-9a-f]{32,}'), string_split_regex(t, '[0-9a-f]{32,}'), '' FROM text
        ), part AS (
            SELECT doc_id, i, kind, h, unnest(m) AS m, unnest(b[:len(m)]) AS b, unnest(range(len(m))) AS k FROM cut
        ), span AS (
            SELECT *, sum(length(b) + length(m)) OVER (PARTITION BY doc_id, i ORDER BY k)::BIGINT AS stop FROM part
        ), kept AS (
            SELECT doc_id, i, kind, stop - length(m) AS start, stop FROM span WHERE i > 0 OR length(regexp_replace(m, '^' || h, '')) >= 8
        )
        SELECT doc_id, count(*) FILTER (i = 0) AS n_assign, count(*) FILTER (i = 1) AS n_access, count(*) FILTER (i = 2) AS n_hex,
            sha256(coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, i), '')) AS base_sha256
        FROM documents LEFT JOIN kept USING (doc_id) GROUP BY doc_id
    """,
    "rules_base": """
        WITH split AS (
            SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
                list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS l FROM documents
        ), three AS (
            SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS g FROM split
        ), often AS (
            SELECT doc_id, g FROM three GROUP BY doc_id, g HAVING count(*) > 1
        ), covered AS (
            SELECT doc_id, count(DISTINCT i + o) AS n FROM three JOIN often USING (doc_id, g), (VALUES (0), (1), (2)) v(o) GROUP BY doc_id
        ), counted AS (
            SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
                length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
                (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words FROM split LEFT JOIN covered USING (doc_id)
        )
        SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted
    """,
    "op11_periodic": """
        WITH split AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
        ), planted AS (
            SELECT doc_id, w, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a, h // 10 AS g
            FROM split LEFT JOIN CRC c ON of = doc_id
        ), words AS (
            SELECT doc_id, CASE WHEN a IS NULL THEN w
                ELSE list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END]) END AS w FROM planted
        ), word AS (
            SELECT doc_id, unnest(range(len(w))) AS i, unnest(w) AS w FROM words
        ), gram AS (
            SELECT doc_id, i, w || ' ' || lead(w, 1) OVER o || ' ' || lead(w, 2) OVER o || ' ' || lead(w, 3) OVER o || ' ' || lead(w, 4) OVER o AS s
            FROM word WINDOW o AS (PARTITION BY doc_id ORDER BY i)
        ), diagonal AS (
            SELECT a.doc_id, b.i - a.i AS q, a.i, a.i - row_number() OVER (PARTITION BY a.doc_id, b.i - a.i ORDER BY a.i) AS part
            FROM gram a JOIN gram b ON a.doc_id = b.doc_id AND a.s = b.s AND a.i < b.i
        ), stretch AS (
            SELECT doc_id, q, min(i) AS s, max(i) + 5 + q - min(i) AS l FROM diagonal GROUP BY doc_id, q, part HAVING l >= greatest(6, 4 * q)
        ), run AS (
            SELECT * FROM stretch x WHERE NOT EXISTS (
                SELECT 1 FROM stretch y WHERE y.doc_id = x.doc_id AND y.q < x.q AND x.q % y.q = 0 AND y.s <= x.s AND x.s + x.l <= y.s + y.l)
        ), found AS (
            SELECT doc_id, count(*) AS n_runs, min({'l': -l, 's': s, 'q': q}) AS b, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS r FROM run GROUP BY doc_id
        ), kept AS (
            SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS t FROM word x
            WHERE NOT EXISTS (SELECT 1 FROM run y WHERE y.doc_id = x.doc_id AND x.i >= y.s + y.q AND x.i < y.s + y.l) GROUP BY doc_id
        )
        SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, b.s::BIGINT AS start, (-b.l)::BIGINT AS length, b.q::BIGINT AS period,
            (-1000 * b.l // b.q)::BIGINT AS exponent_milli, sha256(coalesce(r, '')) AS runs_sha256, sha256(coalesce(t, '')) AS collapsed_sha256
        FROM documents LEFT JOIN found USING (doc_id) LEFT JOIN kept USING (doc_id)
    """.replace("CRC", CRC),
    "op12_jaccard": """
        WITH RECURSIVE split AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
            FROM documents
        ), shingle AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) BETWEEN 1 AND 4 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) END) AS s FROM split
        ), size AS (
            SELECT doc_id, count(s)::BIGINT AS n_shingles FROM split LEFT JOIN shingle USING (doc_id) GROUP BY doc_id
        ), ranked AS (
            SELECT doc_id, s, n_shingles, row_number() OVER (PARTITION BY doc_id ORDER BY k, s) AS place
            FROM shingle JOIN (SELECT s, count(*) AS k FROM shingle GROUP BY s) USING (s) JOIN size USING (doc_id)
        ), pair AS (
            SELECT DISTINCT a.doc_id AS x, b.doc_id AS y FROM ranked a JOIN ranked b USING (s)
            WHERE a.doc_id <> b.doc_id AND 100 * a.place <= 20 * a.n_shingles + 100 AND 100 * b.place <= 20 * b.n_shingles + 100
        ), link AS (
            SELECT x, y FROM pair JOIN shingle a ON a.doc_id = x JOIN shingle b ON b.doc_id = y AND b.s = a.s
            JOIN size m ON m.doc_id = x JOIN size n ON n.doc_id = y
            GROUP BY x, y, m.n_shingles, n.n_shingles HAVING 100 * count(*) >= 80 * (m.n_shingles + n.n_shingles - count(*))
        ), reach AS (
            SELECT doc_id, doc_id AS other FROM size UNION SELECT doc_id, y FROM reach JOIN link ON x = other
        )
        SELECT doc_id, n_shingles, min(other) AS component_id FROM reach JOIN size USING (doc_id) GROUP BY doc_id, n_shingles
    """,
    "op13_manifest": """
        WITH RECURSIVE fields AS (
            SELECT doc_id, source, coalesce(octet_length(encode(doc_id::VARCHAR)) || ':' || doc_id, '-') || coalesce(octet_length(encode(source)) || ':' || source, '-')
                || coalesce(octet_length(encode(lang)) || ':' || lang, '-') || coalesce(octet_length(encode(n_chars::VARCHAR)) || ':' || n_chars, '-') AS head,
                text, CASE WHEN h % 5 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS claimed
            FROM documents LEFT JOIN CRC c ON of = doc_id
        ), leaf AS (
            SELECT doc_id, coalesce('=' || source, '') AS src, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS h,
                sha256(head || coalesce(octet_length(encode(claimed)) || ':' || claimed, '-')) AS claimed FROM fields
        ), placed AS (
            SELECT *, row_number() OVER (PARTITION BY src ORDER BY doc_id NULLS FIRST, h) - 1 AS pos FROM leaf
        ), node AS (
            SELECT 0 AS level, src, pos, h FROM placed
            UNION ALL
            SELECT level + 1, src, pos // 16, sha256(string_agg(h, '' ORDER BY pos))
            FROM (SELECT *, count(*) OVER (PARTITION BY src) AS n FROM node) WHERE n > 1 GROUP BY level, src, pos // 16
        ), height AS (
            SELECT src, max(level) AS top FROM node GROUP BY src
        ), subroot AS (
            SELECT src, h, row_number() OVER (ORDER BY src) - 1 AS pos FROM node JOIN height USING (src) WHERE level = top
        ), above AS (
            SELECT 0 AS level, pos, h FROM subroot
            UNION ALL
            SELECT level + 1, pos // 16, sha256(string_agg(h, '' ORDER BY pos)) FROM (SELECT *, count(*) OVER () AS n FROM above) WHERE n > 1 GROUP BY level, pos // 16
        ), root AS (
            SELECT h AS root, level AS top FROM above WHERE level = (SELECT max(level) FROM above)
        ), step AS (
            SELECT p.src, p.pos, k.level, coalesce(string_agg(s.h, '' ORDER BY s.pos) FILTER (s.pos < p.pos // pow(16, k.level)::BIGINT), '') AS l,
                coalesce(string_agg(s.h, '' ORDER BY s.pos) FILTER (s.pos > p.pos // pow(16, k.level)::BIGINT), '') AS r
            FROM placed p JOIN height USING (src) JOIN (SELECT unnest(range(12)) AS level) k ON k.level < top
            JOIN node s ON s.src = p.src AND s.level = k.level AND s.pos // 16 = p.pos // pow(16, k.level + 1)::BIGINT
            GROUP BY p.src, p.pos, k.level
            UNION ALL
            SELECT q.src, q.pos, o.top + k.level, coalesce(string_agg(s.h, '' ORDER BY s.pos) FILTER (s.pos < p.pos // pow(16, k.level)::BIGINT), ''),
                coalesce(string_agg(s.h, '' ORDER BY s.pos) FILTER (s.pos > p.pos // pow(16, k.level)::BIGINT), '')
            FROM placed q JOIN height o USING (src) JOIN subroot p USING (src) JOIN (SELECT unnest(range(12)) AS level) k ON k.level < (SELECT top FROM root)
            JOIN above s ON s.level = k.level AND s.pos // 16 = p.pos // pow(16, k.level + 1)::BIGINT
            GROUP BY q.src, q.pos, o.top, k.level
        ), fold AS (
            SELECT src, pos, 0 AS level, claimed AS h, '' AS proof FROM placed
            UNION ALL
            SELECT src, pos, level + 1, sha256(l || h || r), proof || l || r FROM fold JOIN step USING (src, pos, level)
        ), last AS (
            SELECT src, pos, arg_max(h, level) AS folded_root, sha256(arg_max(proof, level)) AS proof_sha256 FROM fold GROUP BY src, pos
        )
        SELECT p.doc_id, p.h AS leaf, s.h AS subroot, root, proof_sha256, folded_root, folded_root = root AS verified
        FROM placed p JOIN subroot s USING (src) JOIN last f ON f.src = p.src AND f.pos = p.pos, root
    """.replace("CRC", CRC),
}
