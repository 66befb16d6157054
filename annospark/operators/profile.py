"""Roles of columns: which column holds the label, which the image."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annospark.functions import images, labels

#: Names that speak for a column, and for masks, which are no images.
LABEL_NAMES = ["label", "labels", "class", "classes", "category", "target"]
IMAGE_NAMES = ["image", "img", "photo", "picture"]
MASK_NAMES = ["mask", "segmentation", "alpha"]
SCALARS = (T.StringType, T.IntegerType, T.LongType, T.ShortType, T.ByteType)


def normal(name: str) -> str:
    """A column's name as names of labels are compared, see ``labels.normalize``."""
    return re.sub("[^a-z0-9]+", "_", name.lower()).strip("_")


def explicit_name(columns: list[str], of: str) -> tuple[Column, Column]:
    """(name, conflict): the representative term of the first other string column's value that has a category, and
    whether such values have two categories."""
    others = [F.struct(labels.category(F.col(f"`{c}`")).alias("kind"), labels.representative(F.col(f"`{c}`")).alias("name")) for c in columns if c != of]
    if not others:
        return F.lit(None).cast("string"), F.lit(False)
    known = F.filter(F.array(*others), lambda x: x["kind"].isNotNull())
    conflict = F.size(F.array_distinct(F.transform(known, lambda x: x["kind"]))) > 1
    return F.when(~conflict, F.try_element_at(known, F.lit(1))["name"]), conflict


def of_type(rows: DataFrame, name: str) -> list[str]:
    """Columns whose metadata names this type: ``{"type": "ClassLabel"}`` or ``{"type": "Image"}``."""
    return [f.name for f in rows.schema.fields if f.metadata.get("type") == name]


def label_scores(rows: DataFrame, exclude: tuple[str, ...] = ()) -> DataFrame:
    """column, n_distinct, score of the columns that can be the label of ``rows``, a sample.

    A candidate is a whole-number or string column without nulls, with 2 to 20 values. A name of a
    label counts 10, at most ten values 2, whole numbers 1, values that go with one category each 3,
    and more than one category among them 3. The sample is read once: every column's values are unpivoted with the
    category of the row's other columns, and grouped by column and value.
    """
    left_out = {*exclude, *of_type(rows, "Image")}
    fields = [f for f in rows.schema.fields if isinstance(f.dataType, SCALARS) and f.name not in left_out]
    strings = [f.name for f in fields if isinstance(f.dataType, T.StringType)]
    # A category for each string column, told once a row; a column's own is left out below.
    kinds = F.array(*[F.struct(F.lit(c).alias("of"), labels.category(F.col(f"`{c}`")).alias("kind")) for c in strings]).cast("array<struct<of:string,kind:string>>")
    values = F.array(*[F.struct(F.lit(f.name).alias("column"), F.col(f"`{f.name}`").cast("string").alias("v")) for f in fields]).cast("array<struct<column:string,v:string>>")
    cells = rows.select(kinds.alias("kinds"), values.alias("cells")).select("kinds", F.inline("cells"))
    other = F.array_distinct(F.transform(F.filter("kinds", lambda x: (x["of"] != F.col("column")) & x["kind"].isNotNull()), lambda x: x["kind"]))
    told = cells.select("column", "v", F.when(F.size(other) == 1, F.get(other, F.lit(0))).alias("k"))
    by_value = told.groupBy("column", "v").agg(F.min("k").alias("kind"), F.max("k").alias("last"))
    # As many rows as a sample has values.
    found = by_value.groupBy("column").agg(
        F.count_if(F.col("v").isNull()).alias("nulls"),
        F.count_if(F.col("v").isNotNull()).alias("n_distinct"),
        F.coalesce(F.bool_and(F.col("kind") == F.col("last")), F.lit(False)).alias("single"),
        F.count_distinct("kind").alias("categories"),
    )
    named = F.array(*map(F.lit, [f.name for f in fields if normal(f.name) in LABEL_NAMES])).cast("array<string>")
    whole = F.array(*map(F.lit, [f.name for f in fields if f.name not in strings])).cast("array<string>")
    points = [(F.array_contains(named, F.col("column")), 10), (F.array_contains(whole, F.col("column")), 1), (F.col("n_distinct") <= 10, 2), (F.col("single"), 3), (F.col("categories") > 1, 3)]
    score = reduce(Column.__add__, [F.when(holds, n).otherwise(0) for holds, n in points])
    return found.where("nulls = 0 and n_distinct between 2 and 20").select("column", "n_distinct", score.cast("int").alias("score"))


def label_column(rows: DataFrame, exclude: tuple[str, ...] = ()) -> str:
    """The label's column: the only one of a class type, whatever the values; of none, the only candidate, or the one
    with the best score; else ``ValueError``."""
    classed = of_type(rows, "ClassLabel")
    if len(classed) == 1:
        return classed[0]
    if classed:
        raise ValueError(f"several columns of a class type: {classed}")
    found = sorted(label_scores(rows, exclude).collect(), key=lambda r: -r["score"])  # a row for each column
    if len(found) == 1 or len(found) > 1 and found[0]["score"] > max(found[1]["score"], 0):
        return found[0]["column"]
    raise ValueError(f"no column is clearly the label: {[(r['column'], r['score']) for r in found]}")


def _decoded(kind: T.DataType) -> bool:
    return isinstance(kind, T.StructType) and {"nChannels", "mode", "data"} <= set(kind.names)


def image_scores(rows: DataFrame) -> DataFrame:
    """column, typed, like, score of the columns that can be the image of ``rows``, a sample: whether the type is
    an image's (binary, a struct with bytes or path, a decoded image, or named so by its metadata), how many rows look
    like one, and ten for a good name, minus ten for a mask's, two for each such row. Rows of decoded images count five
    in colour, one with one channel, else two. All columns are counted in one pass."""
    shown, typed_as = [], of_type(rows, "Image")
    for f in rows.schema.fields:
        struct = isinstance(f.dataType, T.StructType) and bool({"bytes", "path"} & set(f.dataType.names))
        typed = isinstance(f.dataType, T.BinaryType) or struct or _decoded(f.dataType) or f.name in typed_as
        c = F.col(f"`{f.name}`")
        if not typed and not isinstance(f.dataType, T.StringType):
            continue
        by_type = isinstance(f.dataType, T.BinaryType) or struct or _decoded(f.dataType)
        like = c.isNotNull() if by_type else F.coalesce(labels.image_like(c), F.lit(False))
        each = F.when(like, 2).otherwise(0)
        if _decoded(f.dataType):
            mode = images.mode_of_channels(c["mode"])
            each = F.when(mode.isin(images.COLOUR), 5).when(mode.isin(images.SINGLE), 1).when(like, 2).otherwise(0)
        name = normal(f.name)
        start = 10 if name in IMAGE_NAMES else -10 if name in MASK_NAMES else 0
        score = (F.lit(start) + F.coalesce(F.sum(each), F.lit(0))).cast("int")
        shown.append(F.struct(F.lit(f.name).alias("column"), F.lit(typed).alias("typed"), F.count_if(like).alias("like"), score.alias("score")))
    if not shown:
        return rows.sparkSession.createDataFrame([], "column string, typed boolean, like long, score int")
    return rows.agg(F.array(*shown).alias("found")).select(F.inline("found"))


def image_column(rows: DataFrame) -> str:
    """The image's column: the only typed one, one of a good name, or the best score; without a typed one
    the only column whose values look like images; else ``ValueError``."""
    found = image_scores(rows).collect()  # a row for each column
    typed = [r for r in found if r["typed"]]
    if len(typed) == 1:
        return typed[0]["column"]
    named = [r for r in typed if normal(r["column"]) in IMAGE_NAMES]
    if len(named) == 1:
        return named[0]["column"]
    best = sorted(typed, key=lambda r: -r["score"])
    if len(best) > 1 and best[0]["score"] > best[1]["score"]:
        return best[0]["column"]
    like = [r for r in found if not r["typed"] and r["like"] > 0]
    if not typed and len(like) == 1:
        return like[0]["column"]
    raise ValueError("no column is clearly the image")
