"""Stage-1 annotation: work lists, choice of attempts, assembly, failures. Attempts are rows of a log."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from annospark.functions import text

PROMPTS = ["prompt1", "prompt2", "prompt3"]
MAX_ATTEMPTS = 3
PLACEHOLDER = "{LABEL}"


def prompt_dim(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """prompt_id, template, ord, a row for each prompt; ``ValueError`` if they are not the three, in
    order, each with the label's placeholder."""
    if list(templates) != PROMPTS or any(PLACEHOLDER not in t for t in templates.values()):
        raise ValueError(f"prompts must be {PROMPTS}, each with {PLACEHOLDER}")
    return spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate(templates.items())], "prompt_id string, template string, ord int")


def rewritten(prompts: DataFrame, prefix: str, words: dict[str, str]) -> DataFrame:
    """``prompts`` for another annotator: a neutral prefix, and words replaced literally."""
    template = F.col("template")
    for old, new in words.items():
        template = F.replace(template, F.lit(old), F.lit(new))
    return prompts.withColumn("template", F.concat(F.lit(prefix), template))


def fan_out(manifest: DataFrame, prompts: DataFrame) -> DataFrame:
    """A row for each sample and prompt, the prompt rendered with the sample's label. ``prompts`` has
    three rows."""
    rows = sorted(prompts.collect(), key=lambda p: p["ord"])  # three
    every = F.array(*[F.struct(F.lit(p["prompt_id"]).alias("prompt_id"), F.lit(p["template"]).alias("template")) for p in rows])
    rows = manifest.select("*", F.explode(every).alias("_p"))
    return rows.select(*manifest.columns, "_p.prompt_id", F.replace("_p.template", F.lit(PLACEHOLDER), F.col("label")).alias("prompt"))


def attempted(log: DataFrame, *keys: str) -> DataFrame:
    """Next attempt of each key: one after the highest in the log."""
    return log.groupBy(*keys).agg((F.max(F.coalesce("attempt", F.lit(-1))) + 1).cast("int").alias("attempt"))


def work_list(manifest: DataFrame, prompts: DataFrame, log: DataFrame, round_: int | None = None, skip_seen: bool = False) -> DataFrame:
    """Pairs still to annotate: not valid yet, with attempts left; ``round_`` holds back pairs that are
    further on. ``skip_seen`` skips all pairs of the log, for annotators without retries."""
    done = log if skip_seen else log.where(F.coalesce("prompt_valid", F.lit(True)))
    rows = fan_out(manifest, prompts).join(done.select("id", "prompt_id").distinct(), ["id", "prompt_id"], "left_anti")
    rows = rows.join(attempted(log, "id", "prompt_id"), ["id", "prompt_id"], "left")
    rows = rows.withColumn("attempt", F.coalesce("attempt", F.lit(0))).where(F.col("attempt") < MAX_ATTEMPTS)
    return rows if round_ is None else rows.where(F.col("attempt") <= round_)


def annotate(work: DataFrame, call: Callable[[pd.DataFrame], pd.DataFrame], schema: str, tasks: int | None = None) -> DataFrame:
    """``work`` through an injected batch function, in ``tasks`` tasks at a time. The result should be
    written before further use: a task that runs again calls again."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield call(batch)

    return (work.repartition(tasks) if tasks else work).mapInPandas(run, schema)


def validated(log: DataFrame, call_error: str = "api_error") -> DataFrame:
    """``log`` with validation_errors and prompt_valid by the free-text rules."""
    rows = log.select("*", *text.parts(F.col("raw_text"))).select("*", *text.more_parts())
    found = text.with_call_errors(text.errors_of_parts(F.col("finish_reason"), F.col("output_tokens")), F.col("error"), call_error)
    rows = rows.select(*[F.col(f"`{c}`") for c in log.columns if c not in ("validation_errors", "prompt_valid")], found.alias("validation_errors"))
    return rows.withColumn("prompt_valid", F.size("validation_errors") == 0)


def missing_images(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """Samples whose image is not listed, with the error that says so."""
    gone = manifest.join(files.select(F.col("path").alias("image_path")).distinct(), "image_path", "left_anti")
    return gone.withColumn("validation_errors", F.array(F.lit("image_not_found")))


def chosen(log: DataFrame, keep: str = "first") -> DataFrame:
    """The first, or last, valid row of each sample and prompt; ties by time, then by content."""
    ends = [F.col("attempt"), F.col("created_at") if "created_at" in log.columns else F.lit(0), F.md5(F.coalesce("raw_text", F.lit("")))]
    order = Window.partitionBy("id", "prompt_id").orderBy(*[c.asc() if keep == "first" else c.desc() for c in ends])
    valid = log.where(F.coalesce("prompt_valid", F.lit(True)))
    return valid.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def assembled(log: DataFrame, keep: str = "first") -> DataFrame:
    """id, attempt and stage1 (a struct of the three prompts' prompt and output) of the samples that have
    all three, from ``validated`` rows."""
    rows = chosen(log, keep).select("id", "prompt_id", "attempt", F.struct(F.col("prompt"), text.strip(F.col("raw_text")).alias("output")).alias("said"))
    pick = [F.first(F.when(F.col("prompt_id") == p, F.col("said")), ignorenulls=True).alias(p) for p in PROMPTS]
    wide = rows.groupBy("id").agg(F.max("attempt").alias("attempt"), *pick)
    full = wide.where(F.col("prompt1").isNotNull() & F.col("prompt2").isNotNull() & F.col("prompt3").isNotNull())
    return full.select("id", "attempt", F.struct(*PROMPTS).alias("stage1"))


def failures(manifest: DataFrame, log: DataFrame) -> DataFrame:
    """id, errors of the samples without all three prompts: for each missing one, in order, the errors of
    its last attempt, or that there was none; where the attempts tell no error, that they were not valid."""
    good = log.where("prompt_valid").select("id", "prompt_id").distinct()
    prompts = F.explode(F.array(*map(F.lit, PROMPTS))).alias("prompt_id")
    open_ = manifest.select("id", prompts).join(good, ["id", "prompt_id"], "left_anti")
    last = log.groupBy("id", "prompt_id").agg(F.max_by("validation_errors", "attempt").alias("errors"), F.lit(True).alias("seen"))
    rows = open_.join(last, ["id", "prompt_id"], "left")
    missing = F.when(F.col("seen"), F.array().cast("array<string>")).otherwise(F.array(F.lit("missing_output")))
    said: Column = F.transform(F.coalesce("errors", missing), lambda e: F.concat_ws(": ", "prompt_id", e))
    listed = rows.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("prompt_id", said.alias("e")))).alias("all"))
    errors = F.flatten(F.transform("all", lambda x: x["e"]))
    return listed.select("id", F.when(F.size(errors) > 0, errors).otherwise(F.array(F.lit("stage1_not_valid_after_retries"))).alias("errors"))


def retries(log: DataFrame) -> DataFrame:
    """id, prompt_id, attempt, next_attempt, validation_errors of failed attempts that may be repeated."""
    rows = log.where(~F.col("prompt_valid") & (F.col("attempt") + 1 < MAX_ATTEMPTS))
    return rows.select("id", "prompt_id", "attempt", (F.col("attempt") + 1).alias("next_attempt"), "validation_errors")


def reason_counts(rows: DataFrame, errors: str = "validation_errors", whole: bool = False) -> DataFrame:
    """reason, n: how often each error code occurs; without positions, unless ``whole``."""
    e = F.explode(errors).alias("e")
    return rows.select(e).groupBy((F.col("e") if whole else text.reason(F.col("e"))).alias("reason")).agg(F.count("*").alias("n"))
