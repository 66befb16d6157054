"""Free-form labels: normal forms, categories, binary labels and ids. All are column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The terms of each category, in the order in which the categories are tried. Terms are a set.
TERMS = {
    "real": ["authentic", "genuine", "real"],
    "tampered": ["edited", "manipulated", "tampered"],
    "synthetic": [
        "ai-generated", "ai_generated", "aigenerated", "full-synthetic", "full_synthetic",
        "fully-synthetic", "fully_synthetic", "generated", "synthetic",
    ],
}
#: Numeric labels, the names that stand for them, and the columns they are looked for in.
NUMBERS = {
    0: ["0", "real", "real_image"],
    1: ["1", "full_synthetic", "fullsynthetic", "synthetic", "ai_generated"],
    2: ["2", "tampered", "manipulated"],
}
LABEL_COLUMNS = ["label", "labels", "class", "target"]
#: What ids of real and of other samples begin with, unless the caller says otherwise.
ID_PREFIXES = ("real_", "fake_")
IMAGE_ENDS = [".jpg", ".jpeg", ".png", ".webp", ".bmp"]
MIMES = {".jpg": "image/jpeg", ".jpeg": "image/jpeg", ".png": "image/png", ".webp": "image/webp", ".bmp": "image/bmp"}


def normalize(c: Column, mark: str = "_") -> Column:
    """Lower case; every run of other characters than a-z and 0-9 one ``mark``, none at the ends."""
    return F.btrim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", mark), F.lit(mark))


def tokens(c: Column) -> Column:
    """The parts of the normal form, and the whole of it with either mark."""
    n = normalize(c)
    every = F.array_union(F.split(n, "_"), F.array(n, F.replace(n, F.lit("_"), F.lit("-"))))
    return F.filter(F.array_distinct(every), lambda x: x != "")


def category(c: Column) -> Column:
    """real, tampered, synthetic or null, by the first category that a token belongs to."""
    found = F.lit(None).cast("string")
    for name in reversed(TERMS):
        found = F.when(F.arrays_overlap(tokens(c), F.array(*map(F.lit, TERMS[name]))), name).otherwise(found)
    return found


def representative(c: Column) -> Column:
    """The longest term of the label's category among its tokens; of equal ones that with underscores, then
    the first in the alphabet. Null where there is no category."""
    kind, own = category(c), tokens(c)
    found = F.lit(None).cast("string")
    for name, terms in TERMS.items():
        order = sorted(terms, key=lambda t: (-len(t), "-" in t, t))
        hit = F.filter(F.array(*map(F.lit, order)), lambda t: F.array_contains(own, t))
        found = F.when(kind == name, F.coalesce(F.try_element_at(hit, F.lit(1)), F.lit(name))).otherwise(found)
    return found


def number(c: Column, whole: bool = False) -> Column:
    """0, 1 or 2 of a label given as a name; null for others. ``whole`` numbers are passed on as they are."""
    if whole:
        return c.cast("bigint")
    bare = F.replace(F.replace(F.lower(F.btrim(c)), F.lit("-"), F.lit("_")), F.lit(" "), F.lit("_"))
    found = F.lit(None).cast("int")
    for value, names in NUMBERS.items():
        found = F.when(bare.isin(names), value).otherwise(found)
    return found


def first_number(columns: list[str]) -> Column:
    """``number`` of the first of the known label columns that has one of the three; ``columns`` are those at hand."""
    given = [number(F.col(f"`{c}`").cast("string")) for c in LABEL_COLUMNS if c in columns]
    return F.coalesce(*given) if given else F.lit(None).cast("int")


def binary(kind: Column, include_tampered: bool = False) -> Column:
    """REAL or AI-GENERATED of a category; null for what is left out."""
    fake = ["synthetic", "tampered"] if include_tampered else ["synthetic"]
    return F.when(kind == "real", "REAL").when(kind.isin(fake), "AI-GENERATED")


def sample_id(label: Column, rank: Column, prefixes: tuple[str, str] = ID_PREFIXES) -> Column:
    """Ids with six digits at least. lpad would cut longer numbers. ``prefixes`` are those of real and of others."""
    stem = F.when(label == "REAL", prefixes[0]).otherwise(prefixes[1])
    return F.concat(stem, F.format_string("%06d", rank))


def kept_or_ranked_id(name: Column, label: Column, rank: Column, prefixes: tuple[str, str] = ID_PREFIXES) -> Column:
    """A file's stem if it is an id of its own class, else an id by rank."""
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    own = F.when(label == "REAL", stem.rlike(f"^{prefixes[0]}[0-9]{{6}}$")).otherwise(stem.rlike(f"^{prefixes[1]}[0-9]{{6}}$"))
    return F.when(own, stem).otherwise(sample_id(label, rank, prefixes))


def original(c: Column, text_or_whole: bool) -> Column:
    """A label as it is told beside the derived ones: texts and whole numbers (``text_or_whole``) as they are, other
    values cut to a whole number where they can be, else as text."""
    return c.cast("string") if text_or_whole else F.coalesce(c.try_cast("bigint").cast("string"), c.cast("string"))


def image_like(c: Column) -> Column:
    """Whether a string names an image, a query part aside."""
    return F.split_part(F.lower(c), F.lit("?"), F.lit(1)).rlike(r"\.(?:jpg|jpeg|png|webp|bmp)$")


def extension(c: Column) -> Column:
    return F.lower(F.regexp_extract(c, r"\.[^./]+$", 0))


def data_url(path: Column, content: Column) -> Column:
    """Payload as a data URL, its type by the extension, png for unknown ones."""
    kind = F.lit("image/png")
    for end, mime in MIMES.items():
        kind = F.when(extension(path) == end, mime).otherwise(kind)
    plain = F.regexp_replace(F.base64(content), "[\r\n]", "")
    return F.concat(F.lit("data:"), kind, F.lit(";base64,"), plain)
