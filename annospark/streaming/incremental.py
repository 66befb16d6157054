"""Incremental validation of append-only logs. The checkpoint of the stream is the state of a resume."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from annospark.operators import annotate, judge
from annospark.sources import io


def log_stream(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Rows as they are appended to a folder of JSON lines."""
    return spark.readStream.schema(schema).json(path)


def line_stream(spark: SparkSession, path: str) -> DataFrame:
    """value and file of text lines as files are added to a folder, not parsed yet."""
    return spark.readStream.text(path).select("value", F.col("_metadata.file_path").alias("file"))


def ingest(lines: DataFrame, schema: StructType | str, path: str, quarantine: str, checkpoint: str, unique_keys: bool = False) -> StreamingQuery:
    """Append what is there now to ``path`` as rows, and the lines that aren't strict JSON to ``quarantine``, then stop; the
    next run goes on from there. A batch has a folder of its own in both, ``batch=<number>``, so one that is run again after
    a loss replaces what it had written before, and no line is lost or told twice."""

    def one(batch: DataFrame, number: int) -> None:
        rows, bad = io.parsed(batch, schema, unique_keys)
        rows.write.mode("overwrite").parquet(f"{path}/batch={number}")
        bad.write.mode("overwrite").parquet(f"{quarantine}/batch={number}")

    query = lines.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def validated_texts(log: DataFrame) -> DataFrame:
    """A stream of free-text attempts with their errors."""
    return annotate.validated(log)


def first_valid(log: DataFrame, time: str | None = None, delay: str = "1 day") -> DataFrame:
    """Each id once, when its first valid judgement arrives. With ``time``, a timestamp column, ids
    are forgotten after ``delay``, which bounds the state."""
    rows = judge.validated(log).where("valid")
    if time is None:
        return rows.dropDuplicates(["id"])
    return rows.withWatermark(time, delay).dropDuplicatesWithinWatermark(["id"])


def run_available(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write what is there now as Parquet and stop; the next run goes on from there."""
    query = rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
