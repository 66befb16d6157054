"""Sources and sinks: JSON lines, reports, splits with a global index, image listings, dataset cards."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from annospark.functions import json_text, labels
from annospark.functions.text import strip


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str, quarantine: str | None = None) -> DataFrame:
    """Rows of JSON lines by Spark's own reader, which lets text after a value pass (``read_jsonl_strict`` does not); blank
    lines are skipped. A bad line stops the job, or, with ``quarantine``,
    goes to the column of that name, which the schema must have. A missing path is an empty table."""
    reader = spark.read.schema(schema).option("allowSingleQuotes", "false")
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", quarantine) if quarantine else reader.option("mode", "FAILFAST")
    try:
        return reader.json(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_jsonl(df: DataFrame, path: str, append: bool = False) -> None:
    """JSON lines with null keys kept."""
    df.write.mode("append" if append else "overwrite").option("ignoreNullFields", "false").json(path)


def write_report(report: DataFrame, path: str) -> None:
    """A report, a row or few, as one file."""
    report.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def empty_outputs(spark: SparkSession, root: str, schemas: dict[str, str]) -> None:
    """Write an empty table for each output that isn't there yet."""
    for name, schema in schemas.items():
        spark.createDataFrame([], schema).write.mode("ignore").json(f"{root}/{name}")


def text_lines(spark: SparkSession, path: str, max_dim_rows: int = 200_000) -> DataFrame:
    """value, file and line (from 1) of the lines of text files, large ones read by many tasks. A missing path is an
    empty table. Lines are numbered within the block of a file that a task reads; the lines of the blocks before are
    added, from a table with a row for each block, which is broadcast up to ``max_dim_rows``."""
    try:
        read = spark.read.text(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "value string, file string, line long")
    block = F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at")
    blocks = read.select(*block).groupBy("file", "_block").agg(F.min("_at").alias("_first"), F.count("*").alias("n"))
    starts = _before(blocks, ["file"], ["_block"]).select("file", "_block", (F.col("before") - F.col("_first")).alias("_move"))
    rows = read.select("value", *block).join(_dim(starts, max_dim_rows), ["file", "_block"])
    return rows.select("value", "file", (F.col("_at") + F.col("_move") + 1).alias("line"))


def parsed(lines: DataFrame, schema: StructType | str, unique_keys: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows, bad) of lines with a column value: rows by ``schema`` beside the other columns, and those with problem and
    raw. Blank lines are skipped. A line must be one JSON value and nothing else: text after it is a problem, which
    Spark's own reader lets pass, and so are single quotes. NaN is let pass. Of a repeated key the last value counts; with
    ``unique_keys`` it is a problem. Built-in expressions alone."""
    others = [c for c in lines.columns if c != "value"]
    told = lines.where(strip("value") != "").withColumn("problem", json_text.problem(F.col("value")))
    bad = F.col("problem").isin("not_json", "repeated_key") if unique_keys else F.col("problem") == "not_json"
    bad = F.coalesce(bad, F.lit(False))
    rows = told.where(~bad).select(*others, F.from_json(strip("value"), schema, {"allowSingleQuotes": "false"}).alias("_row"))
    return rows.select(*others, "_row.*"), told.where(bad).select(*others, "problem", F.col("value").alias("raw"))


def read_jsonl_strict(spark: SparkSession, path: str, schema: StructType | str, quarantine: str | None = None, unique_keys: bool = False) -> DataFrame:
    """Rows of JSON lines as ``parsed`` reads them. Bad lines are appended to ``quarantine``, as file, line, problem and raw;
    without it the first one, by file and line, is a ``ValueError``."""
    rows, bad = parsed(text_lines(spark, path), schema, unique_keys)
    if quarantine:
        bad.select("file", "line", "problem", "raw").write.mode("append").option("ignoreNullFields", "false").json(quarantine)
    elif first := bad.orderBy("file", "line").first():
        raise ValueError(f"{first['problem']} in {first['file']}:{first['line']}")
    return rows.drop("file", "line")


def _before(counts: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """``counts`` with before, the sum of n over the rows of the same ``by`` that come earlier by ``order``."""
    earlier = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))


def _dim(table: DataFrame, max_rows: int) -> DataFrame:
    """``table``, broadcast if it is known to have at most ``max_rows`` rows, else joined by a shuffle."""
    return F.broadcast(table) if table.limit(max_rows + 1).count() <= max_rows else table.hint("shuffle_hash")


def read_splits(spark: SparkSession, paths: dict[str, str], columns: list[str] | None = None, max_dim_rows: int = 200_000) -> DataFrame:
    """Labelled rows of several splits with split, split_index and global_index, in the order given.

    Indices come from the place of a row in its file and the rows of the files before it, by name. The latter are a
    table with a row for each file, which the footers give; it is broadcast up to ``max_dim_rows`` files. So the plan does
    not grow with the files, nothing of their number reaches the driver, and rows are not moved.
    """
    parts, counts = [], []
    for place, (split, path) in enumerate(paths.items()):
        df = spark.read.parquet(path)
        file = F.lit(place).alias("_split"), F.col("_metadata.file_path").alias("_file")
        counts.append(df.select(*file).groupBy("_split", "_file").agg(F.count("*").alias("n")))
        parts.append(df.select(*(columns or df.columns), F.lit(split).alias("split"), *file, F.col("_metadata.row_index").alias("_row")))
    files = reduce(DataFrame.unionByName, counts)
    within = _before(files, ["_split"], ["_file"]).withColumnRenamed("before", "_start")
    # A row for each split.
    splits = _before(files.groupBy("_split").agg(F.sum("n").alias("n")).withColumn("_all", F.lit(0)), ["_all"], ["_split"])
    starts = within.join(F.broadcast(splits.select("_split", F.col("before").alias("_base"))), "_split").select("_split", "_file", "_start", "_base")
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).join(_dim(starts, max_dim_rows), ["_split", "_file"])
    kept = [c for c in rows.columns if c not in ("_split", "_file", "_row", "_start", "_base")]
    return rows.select(*kept, (F.col("_row") + F.col("_start")).alias("split_index"), (F.col("_row") + F.col("_start") + F.col("_base")).alias("global_index"))


def quick_scan(rows: DataFrame, limit: int | None = 2000) -> DataFrame:
    """The first rows of each split; all, if ``limit`` is None."""
    return rows if limit is None else rows.where(F.col("split_index") < limit)


def list_images(spark: SparkSession, root: str) -> DataFrame:
    """path and length of the images beneath ``root``, their bytes not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "length")
    return files.where(labels.extension(F.col("path")).isin(labels.IMAGE_ENDS))


def card_labels(lines: DataFrame, line: str, order: str) -> DataFrame:
    """raw_value, label_text, category, label_name of lines ``- <number> : <text>``. Lines without a category are
    dropped; of several with one number the last counts."""
    pattern = r"^\s*-\s*([0-9]+)\s*:\s*([^\n]+)$"
    rows = lines.where(F.col(line).rlike(pattern)).select(
        F.regexp_extract(line, pattern, 1).alias("raw_value"), F.btrim(F.regexp_extract(line, pattern, 2)).alias("label_text"), F.col(order).alias("_o")
    )
    rows = rows.withColumn("category", labels.category(F.col("label_text"))).where("category is not null")
    last = rows.groupBy("raw_value").agg(F.max_by("label_text", "_o").alias("label_text"), F.max_by("category", "_o").alias("category"))
    return last.withColumn("label_name", labels.representative(F.col("label_text")))
