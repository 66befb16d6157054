"""A corpus pipeline: documents through five operators of annospark.llm.

STAGES are (name, function) pairs. Each function takes (spark, docs, sf_dir) and returns a DataFrame,
which is written as Parquet and read again as the next one's docs. All but the last return the columns
of documents; other columns than these are left out. A document that two stages could take out is judged by the
first; rows keep their doc_id. Rows with a null doc_id pass all filters but the classifier's, null texts are empty
to it, and no documents give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annospark.llm import decontaminate, entries, lines, minhash, packing, quality
from annospark.llm.scratch import drop, keep, scope, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS[:-1], F.length("text").cast("long").alias("n_chars"))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject; a null doc_id stays."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.annotated(docs, model).where("predicted = 1").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that an earlier one is similar to; n_chars follows."""
    return _columns(lines.dedup(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least doc_id, of each group of near duplicates: five-word shingles,
    similarity 0.8 or more. Documents without words are near nothing and stay."""
    kept = minhash.near_duplicates(docs).where(F.col("doc_id").isNotNull() & ~F.col("kept")).select("doc_id")
    return docs.join(kept, "doc_id", "left_anti").select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an item of the benchmark."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' ids in sequences of at most 1024."""
    return packing.pack(docs, entries.tokenizer_path(), keep_ids=False)


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("packing", pack),
]

#: The classifier, the fingerprints and the tokenizer have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of the last stage. A stage's tables are removed when its result is written, and that when the
    next stage's is; the documents that are packed stay, as the result reads them."""
    docs = before = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        with scope(spark):
            docs = keep(stored(stage(spark, before, sf_dir), "stage"))
        if k:
            drop(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
