"""What a model's response log says: text, finish reason, number of tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCHEMA = (
    "status string, incomplete_details struct<reason:string>, usage struct<output_tokens:string>, output_text string, "
    "output array<struct<type:string,content:array<struct<type:string,text:string>>>>"
)
#: States of a response that is not finished otherwise.
PLAIN_STATES = ["completed", "queued", "in_progress"]


def parsed(raw: Column) -> Column:
    return F.from_json(raw, SCHEMA)


def extract(responses: DataFrame, raw: str = "raw_response") -> DataFrame:
    """``responses`` with output_text, finish_reason and output_tokens of the JSON column ``raw``.

    The text is that of output_text, else of all text parts of messages, in order; a count that is
    not a whole number is null. What is not JSON gives an empty text and nulls.
    """
    rows = responses.withColumn("_r", parsed(F.col(raw)))
    messages = F.filter(F.coalesce("_r.output", F.array().cast("array<struct<type:string,content:array<struct<type:string,text:string>>>>")), lambda m: m["type"] == "message")
    none = F.array().cast("array<struct<type:string,text:string>>")
    parts = F.filter(F.flatten(F.transform(messages, lambda m: F.coalesce(m["content"], none))), lambda p: p["type"] == "output_text")
    text = F.coalesce("_r.output_text", F.array_join(F.transform(parts, lambda p: F.coalesce(p["text"], F.lit(""))), ""))
    status = F.col("_r.status")
    cut = F.coalesce(F.nullif(F.col("_r.incomplete_details.reason"), F.lit("")), F.lit("incomplete"))
    reason = F.when(status == "incomplete", cut).when((status != "") & ~status.isin(PLAIN_STATES), status)
    count = F.when(F.col("_r.usage.output_tokens").rlike("^-?[0-9]+$"), F.expr("try_cast(_r.usage.output_tokens as bigint)"))
    return rows.select(*responses.columns, text.alias("output_text"), reason.alias("finish_reason"), count.alias("output_tokens"))
