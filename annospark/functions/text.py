"""String rules for free-text annotations. All are column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: white space in the sense of Unicode, as a character class.
WS = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
#: Fixed value: ends of lines.
EOL = r"(?:\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029])"
CLOSING = r"""[.!?"')\]}]"""

#: Answers that give a label and nothing else, and the words of such answers.
LABEL_PHRASES = [
    "real", "fake", "ai-generated", "ai generated",
    "this image is real", "this image is fake", "this image is ai-generated", "this image is ai generated",
    "the image is real", "the image is fake", "the image is ai-generated", "the image is ai generated",
]
LABEL_WORDS = ["real", "fake", "ai-generated", "ai", "generated", "image", "this", "is", "the"]
#: Words and phrases that a finished sentence does not end with.
OPEN_WORDS = [
    "and", "or", "but", "because", "with", "without", "while", "although", "however", "therefore",
    "to", "of", "for", "from", "in", "on", "by", "as", "at", "into",
]
OPEN_PHRASES = ["due to", "such as", "including", "based on"]
#: Finish reasons of cut answers.
CUT_REASONS = ["length", "max_tokens", "max_output_tokens", "token_limit"]

MIN_CHARS = 30
TOKEN_LIMIT = 500


def strip(c: Column) -> Column:
    """Without white space at both ends; Spark's trim takes U+0020 only."""
    return F.regexp_replace(c, f"^{WS}+|{WS}+$", "")


def collapse(c: Column) -> Column:
    return F.regexp_replace(c, f"{WS}+", " ")


def label_only(c: Column) -> Column:
    return _label_only(F.lower(strip(c)))


def _label_only(lower: Column) -> Column:
    bare = F.regexp_replace(collapse(lower), r"""^[ .!?"']+|[ .!?"']+$""", "")
    words = F.split(bare, " ")
    few = (bare != "") & (F.size(words) <= 6)
    return bare.isin(LABEL_PHRASES) | (few & F.forall(words, lambda w: w.isin(LABEL_WORDS)))


def last_line(c: Column) -> Column:
    """The last line that is not blank, stripped; empty if there is none."""
    return _last_line(strip(c))


def _last_line(text: Column) -> Column:
    # A stripped text ends in a line that is not blank; only white space within can be left before it.
    return F.coalesce(F.regexp_replace(F.regexp_extract(text, f"(?s)(?:^|{EOL})((?:(?!{EOL}).)*+)$", 1), f"^{WS}+", ""), F.lit(""))


def incomplete_bullet(c: Column) -> Column:
    """The last line is an empty bullet or number, or one whose text is not closed; so is no line."""
    return _incomplete_bullet(last_line(c))


def _incomplete_bullet(line: Column) -> Column:
    marker = r"(?:[-*]|\p{Nd}+[.)])"
    return (line == "") | line.rlike(f"^{marker}$") | (line.rlike(f"^{marker}{WS}+[^\\s]") & ~line.rlike(f"{CLOSING}$"))


def truncated(c: Column, finish_reason: Column, output_tokens: Column, limit: int = TOKEN_LIMIT) -> Column:
    """Whether an answer looks cut. ``limit`` is the most tokens it could have; 0 stands for none."""
    text = strip(c)
    return _truncated(text, F.lower(text), _last_line(text), finish_reason, output_tokens, limit)


def _truncated(text: Column, lower: Column, line: Column, finish_reason: Column, output_tokens: Column, limit: int) -> Column:
    bare = F.regexp_replace(collapse(lower), r"""[ .!?"')\]}]+$""", "")
    last_word = F.try_element_at(F.regexp_extract_all(bare, F.lit("[a-z]+(?:-[a-z]+)?"), 0), F.lit(-1))
    open_end = bare.rlike(f"(?:{'|'.join(OPEN_PHRASES)})$") | F.coalesce(last_word.isin(OPEN_WORDS), F.lit(False))
    near_limit = F.lit(limit > 0) & F.coalesce(output_tokens >= limit * 95 // 100, F.lit(False)) & ~text.rlike(f"{CLOSING}$")
    return (
        F.coalesce(finish_reason.isin(CUT_REASONS), F.lit(False))
        | (text == "")
        | text.rlike(r"(?:\.\.\.|[,:])$")
        | open_end
        | _incomplete_bullet(line)
        | near_limit
    )


def parts(c: Column) -> list[Column]:
    """What the rules look at, to be columns of their own so that each is found once: the stripped text."""
    return [strip(c).alias("_text")]


def more_parts() -> list[Column]:
    """From the stripped text: lower case and the last line."""
    return [F.lower("_text").alias("_lower"), _last_line(F.col("_text")).alias("_line")]


def errors_of_parts(finish_reason: Column, output_tokens: Column, limit: int = TOKEN_LIMIT) -> Column:
    """``free_text_errors`` from the columns of ``parts`` and ``more_parts``."""
    return _errors(F.col("_text"), F.col("_lower"), F.col("_line"), finish_reason, output_tokens, limit)


def free_text_errors(c: Column, finish_reason: Column, output_tokens: Column, limit: int = TOKEN_LIMIT) -> Column:
    """The ordered error codes of a free-text annotation; none if it is valid."""
    text = strip(c)
    return _errors(text, F.lower(text), _last_line(text), finish_reason, output_tokens, limit)


def _errors(text: Column, lower: Column, line: Column, finish_reason: Column, output_tokens: Column, limit: int) -> Column:
    rules = [
        ("empty_output", text == ""),
        ("too_short_lt_30_chars", F.length(text) < MIN_CHARS),
        ("label_only_or_short_answer", _label_only(lower)),
        ("json_like_output_not_allowed", text.rlike(r"^[{\[]")),
        ("markdown_code_fence_not_allowed", text.contains("```")),
        ("suspected_truncation_or_incomplete_sentence", _truncated(text, lower, line, finish_reason, output_tokens, limit)),
    ]
    found = F.array_compact(F.array(*[F.when(holds, F.lit(code)) for code, holds in rules]))
    return F.when(text.isNull(), F.array(F.lit("output_not_string"))).otherwise(found)


def with_call_errors(errors: Column, error: Column, code: str) -> Column:
    """A failed call has one error, ``code``, whatever its text."""
    return F.when(F.coalesce(error, F.lit("")) != "", F.array(F.lit(code))).otherwise(errors)


def reason(error: Column) -> Column:
    """An error code without the parts that differ from row to row."""
    return F.regexp_replace(F.split_part(error, F.lit(":"), F.lit(1)), r"\[[0-9]+\]", "[]")
