"""Chat formatting: records of many layouts become canonical turns, then one marked text.

The layout of a JSON record is told by a fingerprint, the hash of its nested field paths; what a field holds (text,
number, null) has no say in it. A fingerprint selects a declarative mapping, which names where the turns of such records are. The template
marks turns; control strings inside texts are escaped so that they can be restored exactly. Only
DataFrame functions are used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Strings that mark turns in common templates. A text never holds one unescaped.
CONTROLS = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>"]
START, END = "<|im_start|>", "<|im_end|>"
TURN = "struct<role:string,text:string>"
#: Records of more bytes get their fingerprint from a skeleton: a variant takes no text of over 20,000,000
#: characters and no more than 128 MiB in all.
WHOLE = 16_000_000
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'


#: Types of what is no object or array, as ``schema_of_variant`` names them.
SCALARS = "STRING VOID BOOLEAN TINYINT SMALLINT INT BIGINT FLOAT DOUBLE BINARY DATE TIMESTAMP TIMESTAMP_NTZ VARIANT UUID"


@dataclass(frozen=True)
class Mapping:
    """How the turns of one layout are read.

    ``paths`` are the layout's field paths; ``[]`` after a name stands for the elements of a list. A layout with a
    list of messages names the list and the fields of its elements, and may rename roles. One with fixed fields
    names, for each turn in order, its role and field; a field whose name ends in ``?`` gives no turn if it is empty.
    """

    paths: tuple[str, ...]
    messages: tuple[str, str, str] | None = None
    roles: tuple[tuple[str, str], ...] = ()
    fields: tuple[tuple[str, str], ...] = ()


#: Layouts that are known at first; others are added by passing more mappings.
MAPPINGS = (
    Mapping(("messages[].content", "messages[].role"), messages=("messages", "role", "content")),
    Mapping(
        ("conversations[].from", "conversations[].value"),
        messages=("conversations", "from", "value"),
        roles=(("human", "user"), ("gpt", "assistant")),
    ),
    Mapping(("completion", "prompt"), fields=(("user", "prompt"), ("assistant", "completion"))),
    Mapping(("instruction", "output"), fields=(("user", "instruction"), ("assistant", "output"))),
    Mapping(
        ("input", "instruction", "output"),
        fields=(("user", "instruction"), ("user", "input?"), ("assistant", "output")),
    ),
    Mapping(
        ("instruction", "output", "system"),
        fields=(("system", "system"), ("user", "instruction"), ("assistant", "output")),
    ),
)


def layout_of(paths: tuple[str, ...]) -> str:
    """The text that ``fingerprint`` hashes for records with these field paths."""
    tree: dict = {}
    for path in paths:
        at = tree
        for name in path.split("."):
            at = at.setdefault(name, {})

    def written(fields: dict) -> str:
        inner = []
        for name in sorted(fields, key=lambda x: x.removesuffix("[]").encode()):
            value = written(fields[name]) if fields[name] else "*"
            inner.append(f"{name.removesuffix('[]')}: " + (f"ARRAY<{value}>" if name.endswith("[]") else value))
        return f"OBJECT<{', '.join(inner)}>"

    return written(tree)


def skeleton(payload: Column) -> Column:
    """A JSON text with every text of a value empty, and of equal flat records that follow each other
    one; its field paths and types are the same."""
    # A key is kept, and what marks an empty text is taken away behind its colon.
    short = F.regexp_replace(payload, f"(?s)({_STRING}\\s*+:)|{_STRING}", '$1\x01""')
    short = F.replace(F.replace(short, F.lit(':\x01""'), F.lit(":")), F.lit("\x01"), F.lit(""))
    return F.regexp_replace(short, '(\\{"[^{}\\[\\]\\\\]*+\\},)\\1++', "$1")


def fingerprint(payload: Column, whole: int = WHOLE) -> Column:
    """Hash of the nested field paths of a JSON text; null if it is not JSON."""
    short = F.when(F.octet_length(payload) <= whole, payload).otherwise(skeleton(payload))
    typed = F.schema_of_variant(F.try_parse_json(short))
    scalar = f"(`(?:[^`]|``)*`)|\\b(?:{'|'.join(SCALARS.split())}|DECIMAL\\([0-9]+, ?[0-9]+\\))(?=[,>]|$)"
    return F.sha2(F.regexp_replace(typed, scalar, "$1*"), 256)


#: Texts may be as long as a string can be.
_ANY = {"maxStringLen": str(2**31 - 1)}


def _turns(payload: Column, mapping: Mapping) -> Column:
    if mapping.messages:
        name, role, text = mapping.messages
        rows = F.from_json(payload, f"struct<`{name}`:array<struct<`{role}`:string,`{text}`:string>>>", _ANY)[name]
        renamed = dict(mapping.roles)

        def turn(x: Column) -> Column:
            value = x[role]
            for old, new in renamed.items():
                value = F.when(x[role] == old, new).otherwise(value)
            return F.struct(F.coalesce(value, F.lit("")).alias("role"), F.coalesce(x[text], F.lit("")).alias("text"))

        return F.transform(rows, turn)
    fields = [(role, name.rstrip("?"), name.endswith("?")) for role, name in mapping.fields]
    record = F.from_json(payload, "struct<" + ",".join(f"`{n}`:string" for _, n, _ in fields) + ">", _ANY)
    given = [
        F.when(F.lit(not maybe) | (record[name] != ""), F.struct(F.lit(role).alias("role"), F.coalesce(record[name], F.lit("")).alias("text")))
        for role, name, maybe in fields
    ]
    return F.when(record.isNotNull(), F.array_compact(F.array(*given)))


def canonical(records: DataFrame, mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """``records`` (conv_id, payload; JSON texts) with layout (the fingerprint) and turns (array of
    role and text).

    A payload that is not JSON, or whose layout no mapping has, gets null turns, to be looked at. A null
    field counts as an empty text, a number or other value as its JSON text.
    A record without turns gets an empty array where its layout shows a list of no elements.
    """
    payload = F.col("payload")
    turns = F.lit(None).cast(f"array<{TURN}>")
    named = F.when(F.lit(False), turns)
    for m in mappings:
        named = named.when(F.col("layout") == F.sha2(F.lit(layout_of(m.paths)), 256), _turns(payload, m))
        if m.messages:
            none = layout_of((f"{m.messages[0]}[]",))
            named = named.when(F.col("layout") == F.sha2(F.lit(none), 256), F.array().cast(f"array<{TURN}>"))
    return records.select("*", fingerprint(payload).alias("layout")).select("*", named.alias("turns"))


def _pattern(filled: str) -> str:
    """One group before and one after the place of the backslashes of each control string."""
    quoted = ["".join("\\" + c if c in "[]|/<>" else c for c in x[1:]) for x in CONTROLS]
    return f"([<\\[]){filled}(\\\\*(?:{'|'.join(sorted(quoted, key=len, reverse=True))}))"


def escape(text: Column) -> Column:
    """A backslash more after the first character of each control string, escaped ones included."""
    return F.regexp_replace(text, _pattern(""), r"$1\\$2")


def unescape(text: Column) -> Column:
    """The inverse of ``escape``."""
    return F.regexp_replace(text, _pattern("\\\\"), "$1$2")


def _role_out(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")), F.lit("<"), F.lit("%3C"))


def _role_in(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("%3C"), F.lit("<")), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def formatted(canon: DataFrame) -> DataFrame:
    """conv_id, formatted (text) and segments (array of text and loss) of ``canonical``'s rows.

    The segments follow each other in formatted. Those with loss hold the escaped text of an
    assistant turn, alone; they are the loss mask. Null turns give nulls.
    """
    parts = F.transform(
        "turns",
        lambda t: F.array(
            F.struct(F.concat(F.lit(START), _role_out(F.coalesce(t["role"], F.lit(""))), F.lit("\n")).alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(F.coalesce(t["text"], F.lit(""))).alias("text"), F.coalesce(t["role"] == "assistant", F.lit(False)).alias("loss")),
            F.struct(F.lit(END + "\n").alias("text"), F.lit(False).alias("loss")),
        ),
    )
    rows = canon.select("conv_id", F.flatten(parts).alias("segments"))
    return rows.select("conv_id", F.when(F.col("segments").isNotNull(), F.array_join(F.transform("segments", lambda s: s["text"]), "")).alias("formatted"), "segments")


def read_back(out: DataFrame) -> DataFrame:
    """``formatted``'s rows with turns and loss_text, both read from its columns alone."""
    pieces = F.filter(F.split("formatted", START.replace("|", "\\|")), lambda x: x != "")
    turns = F.transform(
        pieces,
        lambda x: F.struct(
            _role_in(F.substring_index(x, "\n", 1)).alias("role"),
            unescape(F.regexp_extract(x, "(?s)^[^\n]*\n(.*)<\\|im_end\\|>\n$", 1)).alias("text"),
        ),
    )
    loss = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
    return out.select("*", turns.alias("turns"), F.when(F.col("segments").isNotNull(), loss).alias("loss_text"))


def records(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text), a row for each turn, as JSON records (conv_id, payload).

    Conversations keep the layouts in which such data come: a system, a user and an assistant turn
    as instruction, a user and an assistant turn as prompt or as instruction, by conv_id, and others
    as messages of one or the other kind. Turns are ordered by turn, then role, then text; repeated
    rows stay. A null role or text is empty. A conversation is one record, so it must fit a task.
    """
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", role.alias("role"), text.alias("text")))).alias("t"))
    order = F.array_join(F.transform("t", lambda x: x["role"]), "|")
    say = lambda i: F.col("t")[i]["text"]
    even = F.coalesce(F.col("conv_id") % 2 == 0, F.lit(True))
    short = order == "user|assistant"
    payload = (
        F.when(short & even, F.to_json(F.struct(say(0).alias("prompt"), say(1).alias("completion"))))
        .when(short, F.to_json(F.struct(say(0).alias("instruction"), say(1).alias("output"))))
        .when(order == "system|user|assistant", F.to_json(F.struct(say(0).alias("system"), say(1).alias("instruction"), say(2).alias("output"))))
        .when(
            even | F.exists("t", lambda x: x["role"].isin("human", "gpt")),
            F.to_json(F.struct(F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("content"))).alias("messages"))),
        )
    )
    other = F.transform(
        "t",
        lambda x: F.struct(
            F.when(x["role"] == "user", "human").when(x["role"] == "assistant", "gpt").otherwise(x["role"]).alias("from"), x["text"].alias("value")
        ),
    )
    return turns.select("conv_id", F.coalesce(payload, F.to_json(F.struct(other.alias("conversations")))).alias("payload"))


def digests(back: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, layout of ``read_back``'s rows."""
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
