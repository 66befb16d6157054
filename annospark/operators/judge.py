"""Stage-2 judgements and the training records made of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annospark.functions import judgement
from annospark.operators.annotate import MAX_ATTEMPTS, PROMPTS, attempted

#: The question of a training record, and what counts where nothing is given.
QUESTION = "<image>\nIs this image real or generated by AI? Please analyze visual forensic evidence and output the structured JSON judgment."
NO_EFFORT = "xhigh"
RETRY_SUFFIX = "\n\nReturn only the JSON object, complete and with the exact keys and order."


def rendered(template: str, label: Column, outputs: list[Column]) -> Column:
    """The template with label and outputs set in, one after the other: a placeholder inside an output is
    replaced by a later step."""
    out = F.replace(F.lit(template), F.lit("{LABEL}"), label)
    for k, said in enumerate(outputs, 1):
        out = F.replace(out, F.lit(f"{{STAGE1_OUTPUT_{k}}}"), F.coalesce(said, F.lit("")))
    return out


def with_suffix(prompt: Column, attempt: Column) -> Column:
    return F.when(attempt > 0, F.concat(prompt, F.lit(RETRY_SUFFIX))).otherwise(prompt)


def validated(log: DataFrame, label: str = "label", call_error: str | None = None) -> DataFrame:
    """``log`` with shape, validation_errors, valid of raw_text against the label."""
    rows = log.withColumn("shape", judgement.describe(F.col("raw_text")))
    found = judgement.errors("shape", F.col(label))
    if call_error:
        found = F.when(F.coalesce("error", F.lit("")) != "", F.array(F.lit(call_error))).otherwise(found)
    return rows.withColumn("validation_errors", found).withColumn("valid", F.size("validation_errors") == 0)


def best_attempts(rows: DataFrame) -> DataFrame:
    """One row for each id of validated attempts: the lowest valid one, else the last."""
    order = [F.desc("valid"), F.when(F.col("valid"), F.col("attempt")).asc_nulls_last(), F.desc("attempt"), F.md5(F.coalesce("raw_text", F.lit("")))]
    ranked = rows.withColumn("_n", F.row_number().over(Window.partitionBy("id").orderBy(*order)))
    return ranked.where("_n = 1").drop("_n")


def judgement_text(columns: list[str]) -> Column:
    """The text of a judgement: the string as given, else the struct written as JSON, else the raw answer."""
    own = F.col("stage2_json_string") if "stage2_json_string" in columns else F.lit(None).cast("string")
    struct = F.to_json("stage2_json", {"ignoreNullFields": "false"}) if "stage2_json" in columns else F.lit(None).cast("string")
    raw = F.col("raw_text") if "raw_text" in columns else F.lit(None).cast("string")
    return F.coalesce(own, struct, raw, F.lit(""))


def source_of_attempts(log: DataFrame, valid: DataFrame) -> DataFrame:
    """The log, or, if it is empty, what was found valid before, as attempts to validate again."""
    if not log.isEmpty():
        return log
    return valid.withColumn("raw_text", judgement_text(valid.columns)).drop("stage2_json_string", "stage2_json")


def revalidated(log: DataFrame, manifest: DataFrame) -> DataFrame:
    """id, label, attempt, valid, errors, compact of every id of the log and the manifest.

    The manifest's label counts. An id that it doesn't have is never valid; one that the log doesn't
    have is missing. The manifest has each id once.
    """
    known = manifest.select("id", F.col("label").alias("_label"), F.lit(True).alias("_known"))
    rows = log.select("id", "attempt", "raw_text", "label").join(known, "id", "left")
    rows = validated(rows.withColumn("label", F.coalesce("_label", "label")))
    stranger = F.col("_known").isNull()
    more = F.concat("validation_errors", F.array(F.lit("sample_missing_from_manifest")))
    rows = rows.withColumn("validation_errors", F.when(stranger, more).otherwise(F.col("validation_errors")))
    rows = best_attempts(rows.withColumn("valid", F.col("valid") & ~stranger))
    compact = F.when(F.col("valid"), F.col("shape.compact"))
    rows = rows.select("id", "label", "attempt", "valid", F.col("validation_errors").alias("errors"), compact.alias("compact"))
    missing = manifest.join(log.select("id").distinct(), "id", "left_anti").select(
        "id", "label", F.lit(None).cast("int").alias("attempt"), F.lit(False).alias("valid"), F.array(F.lit("missing_stage2_output")).alias("errors"), F.lit(None).cast("string").alias("compact")
    )
    return rows.unionByName(missing)


def validation_report(result: DataFrame, log: DataFrame, manifest: DataFrame) -> DataFrame:
    """One row of counts."""
    one = result.agg(
        F.count_if("valid").alias("total_valid"),
        F.count_if(~F.col("valid")).alias("total_invalid"),
        F.count_if(F.array_contains("errors", "missing_stage2_output")).alias("missing"),
        F.count_if(F.col("valid") & (F.col("label") == "REAL")).alias("real_valid"),
        F.count_if(F.col("valid") & (F.col("label") == "AI-GENERATED")).alias("fake_valid"),
    )
    return manifest.agg(F.count("*").alias("total_manifest")).join(log.agg(F.count("*").alias("total_stage2_raw"))).join(one)


def criteria(rows: DataFrame) -> DataFrame:
    """id, attempt, position, criterion, evidence, score: a row for each criterion of valid judgements."""
    flat = rows.where("valid").select("id", "attempt", F.posexplode("shape.items").alias("position", "x"))
    return flat.select("id", "attempt", "position", "x.criterion", "x.evidence", F.col("x.score").alias("score"))


def recovered(log: DataFrame) -> DataFrame:
    """The best attempts among those whose call did not fail, as if nothing were called again."""
    return best_attempts(validated(log.where(F.coalesce("error", F.lit("")) == ""))).where("valid")


def _settled(log: DataFrame) -> DataFrame:
    """The ids of ``recovered``, once for each valid attempt: no attempt has to be chosen for that."""
    return validated(log.where(F.coalesce("error", F.lit("")) == "")).where("valid").select("id")


def work_list(stage1: DataFrame, log: DataFrame, template: str) -> DataFrame:
    """id, label, attempt, prompt of the samples to judge: with stage 1, not valid yet, attempts left."""
    rows = stage1.join(_settled(log), "id", "left_anti").join(attempted(log, "id"), "id", "left")
    rows = rows.withColumn("attempt", F.coalesce("attempt", F.lit(0))).where(F.col("attempt") < MAX_ATTEMPTS)
    prompt = rendered(template, F.col("label"), [F.col(f"stage1.{p}.output") for p in PROMPTS])
    return rows.select("id", "label", "attempt", with_suffix(prompt, F.col("attempt")).alias("prompt"))


def exhausted(stage1: DataFrame, log: DataFrame) -> DataFrame:
    """Samples that are not valid and have no attempts left."""
    rows = stage1.join(_settled(log), "id", "left_anti").join(attempted(log, "id"), "id")
    return rows.where(F.col("attempt") >= MAX_ATTEMPTS).select("id", F.array(F.lit("stage2_not_valid_after_retries")).alias("errors"))


def well_formed(messages: Column) -> Column:
    """Two messages, of a user and of an assistant, both with content."""
    first, second = F.get(messages, F.lit(0)), F.get(messages, F.lit(1))
    shape = (F.size(messages) == 2) & (first["role"] == "user") & (second["role"] == "assistant")
    return F.coalesce(shape & first["content"].isNotNull() & second["content"].isNotNull(), F.lit(False))


def sft_rows(stage2: DataFrame, stage1: DataFrame, manifest: DataFrame, generator: str) -> DataFrame:
    """Training records and what was skipped, with the reason in skip (null for a record).

    ``stage2`` has id, label, image_path, the judgement as stage2_json (struct) or stage2_json_string, and perhaps
    model and reasoning_effort, each id once; where the manifest has the id, its label and image count.
    The judgement is validated again, a struct before a string. Empty strings count as not given.
    """
    known = manifest.select("id", F.col("label").alias("_label"), F.col("image_path").alias("_image"), F.lit(True).alias("_known"))
    rows = stage2.join(stage1.select("id", "stage1"), "id", "left").join(known, "id", "left")
    rows = rows.withColumn("label", F.when(F.col("_known"), F.col("_label")).otherwise(F.col("label")))
    rows = rows.withColumn("image", F.coalesce("_image", "image_path"))
    struct = F.to_json("stage2_json", {"ignoreNullFields": "false"}) if "stage2_json" in stage2.columns else F.lit(None).cast("string")
    text = F.col("stage2_json_string") if "stage2_json_string" in stage2.columns else F.lit(None).cast("string")
    rows = validated(rows.withColumn("raw_text", F.coalesce(struct, text)))
    given = lambda c, default: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(default)) if c in stage2.columns else F.lit(default)
    full = F.coalesce(F.size(F.filter(F.array(*[F.col(f"stage1.{p}.output") for p in PROMPTS]), lambda x: x.isNotNull())) == 3, F.lit(False))
    skip = F.when(~full, F.array(F.lit("missing_stage1_prompt_outputs"))).when(~F.col("valid"), F.col("validation_errors"))
    message = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    said = F.array(message("user", F.lit(QUESTION)), message("assistant", F.col("shape.compact")))
    rows = rows.withColumn("messages", said)
    skip = F.coalesce(skip, F.when(~well_formed(F.col("messages")), F.array(F.lit("invalid_messages_shape"))))
    return rows.select(
        "id",
        "image",
        "label",
        "messages",
        F.struct(*[F.col(f"stage1.{p}.output").alias(p) for p in PROMPTS]).alias("stage1_outputs"),
        given("model", generator).alias("generator_model"),
        given("reasoning_effort", NO_EFFORT).alias("reasoning_effort"),
        skip.alias("skip"),
    )


def sft_report(rows: DataFrame) -> DataFrame:
    """One row of counts of ``sft_rows``."""
    lost = F.array_contains("skip", "missing_stage1_prompt_outputs")
    done = F.col("skip").isNull()
    return rows.agg(
        F.count("*").alias("total"),
        F.count_if(done).alias("written"),
        F.count_if(F.coalesce(lost, F.lit(False))).alias("skipped_missing_stage1"),
        F.count_if(~done & ~F.coalesce(lost, F.lit(False))).alias("skipped_invalid"),
        F.count_if(done & (F.col("label") == "REAL")).alias("real_written"),
        F.count_if(done & (F.col("label") == "AI-GENERATED")).alias("fake_written"),
    )
