"""Substring dedup by digests of lines and paragraphs, and of word runs for what these cannot reach.

Texts are cut into lines and paragraphs (lines between lines without a word). A unit is normalised to its words,
A-Z lower-cased; digests are grouped globally, the earliest occurrence of each, by doc_id and place, is kept,
and all others are removed. What is removed is told by offsets into the original text.

Lines and paragraphs under ``least`` words are kept: such short ones are headings and list marks, which repeat by
chance. A passage that is set into the middle of lines is no unit of these kinds. For it, runs of ``unit`` words at any
place are units too. Not every run is shuffled: of any ``unit // 2 + 1`` consecutive runs of ``unit // 2`` words
the one with the least number is an anchor, so two equal runs hold an equal anchor at the same place. Only
runs around an anchor that occurs twice can occur twice; only those are grouped. Passages that removed lines and
paragraphs cover are left to these. Exact copies of a text are told apart first, by one digest of the whole text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from annospark.llm import words
from annospark.llm.places import joined, placed
from annospark.llm.scratch import drop, scoped, small, stored

#: Words of a run that is removed wherever it lies, and least words of a line, paragraph or text that is removed as a whole.
UNIT, LEAST = 50, 5
AT = ["doc_id", "part"]
#: The kinds of spans, by number.
KINDS = ["text", "paragraph", "line", "passage"]


def _whole(p: words.Piece, text: int) -> int:
    own = p.data[p.bounds[text] : p.bounds[text + 1]]
    return int.from_bytes(hashlib.blake2b(own, digest_size=8).digest(), "little", signed=True)


def _lines(least: int):
    """Rows (d1, d2, doc_id, part, start, end, place, n_words, kind) of the lines and paragraphs of at least
    ``least`` words; place counts words. A paragraph of one line is given as a line."""

    names = ["d1", "d2", *AT, "start", "end", "place", "n_words", "kind"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, part = (batch[c].to_numpy(zero_copy_only=False) for c in AT)
            for p in words.pieces(batch["text"]):
                if len(p.hash) < least:
                    continue
                line = np.searchsorted(np.flatnonzero(p.data == 10), p.start) + p.text  # texts do not share a line
                step = np.diff(line, prepend=-2)
                text = np.diff(p.text, prepend=-1) != 0
                first = np.flatnonzero((step != 0) | text)
                whole = np.flatnonzero((step > 1) | text)
                size, wide = np.diff(np.r_[first, len(line)]), np.diff(np.r_[whole, len(line)])
                several = ~np.isin(whole, first[np.isin(first + size, whole + wide)])
                begin = np.r_[first, whole[several]]
                size = np.r_[size, wide[several]]
                kind = np.r_[np.full(len(first), 2), np.full(int(several.sum()), 1)]
                begin, size, kind = (x[np.r_[size] >= least] for x in (begin, size, kind))
                if not len(begin):
                    continue
                row = np.repeat(np.arange(len(begin)), size)
                nth = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
                token, edge = p.hash[begin[row] + nth], np.cumsum(size) - size
                power = words.powers(int(size.max()) + 1)[nth]
                d1 = words.mix(np.add.reduceat(token * power, edge) + size.astype(np.uint64))
                d2 = words.mix(np.add.reduceat(words.mix(token ^ words.ODD[41]) * power, edge))
                point = words.code_points(p)
                of = p.text[begin]
                base = point[p.bounds[of]]
                place = begin - np.searchsorted(p.text, of)
                at = p.lo + of
                ends = [point[p.start[begin]] - base, point[p.end[begin + size - 1]] - base]
                columns = [d1.view(np.int64), d2.view(np.int64), doc[at], part[at], *(x.astype(np.int64) for x in ends)]
                columns += [x.astype(np.int32) for x in (place, size, kind)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    return run


def _anchors(width: int, unit: int):
    """Rows (anchor, doc_id, part, place, whole, again) of the anchors of each text: places count words,
    whole is a digest of the text's bytes, again tells that the text has the anchor twice."""

    names = ["anchor", *AT, "place", "whole", "again"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, part = (batch[c].to_numpy(zero_copy_only=False) for c in AT)
            for p in words.pieces(batch["text"]):
                if len(p.hash) < unit:
                    continue
                number = words.runs(p.hash, width)
                number |= words.U(1)
                span = unit - width + 1  # runs of `width` words in a unit
                least = words.sliding(number, span, np.minimum)
                least[p.text[: len(least)] != p.text[unit - 1 : unit - 1 + len(least)]] = 0
                pad = np.zeros(span - 1, dtype=np.uint64)
                best = words.sliding(np.r_[pad, least, pad], span, np.maximum)[: len(number)]
                at = np.flatnonzero(best == number)
                place = at - np.searchsorted(p.text, p.text[at])
                number, text = number[at], p.text[at]
                whole = np.fromiter((_whole(p, t) for t in range(p.hi - p.lo)), dtype=np.int64, count=p.hi - p.lo)[text]
                order = np.lexsort((number, text))
                same = (number[order][1:] == number[order][:-1]) & (text[order][1:] == text[order][:-1])
                again = np.zeros(len(at), dtype=bool)
                again[order[1:][same]] = again[order[:-1][same]] = True
                columns = [number.view(np.int64), doc[p.lo + text], part[p.lo + text], place.astype(np.int32), whole, again]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    return run


def _units(width: int, unit: int):
    """Rows (d1, d2, doc_id, part, place, begin, end, again) of the runs that hold one of the given
    anchors; again tells that the text has the run before, without overlap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["d1", "d2", *AT, "place", "begin", "end", "again"]
        for batch in batches:
            doc, part = (batch[c].to_numpy(zero_copy_only=False) for c in AT)
            places, bound = batch["places"].flatten().to_numpy(), np.r_[0, np.cumsum(batch["places"].value_lengths().to_numpy())]
            for p in words.pieces(batch["text"]):
                if len(p.hash) < unit:
                    continue
                own = places[bound[p.lo] : bound[p.hi]]
                first = np.searchsorted(p.text, np.arange(p.hi - p.lo))
                at = own + np.repeat(first, np.diff(bound[p.lo : p.hi + 1]))
                n = len(p.hash) - unit + 1
                # A unit from i holds the anchor at a if i <= a <= i + unit - width.
                step = np.zeros(len(p.hash) + 1, dtype=np.int64)
                np.add.at(step, np.maximum(at - (unit - width), 0), 1)
                np.add.at(step, at + 1, -1)
                near = np.cumsum(step)[:n] > 0
                near &= p.text[:n] == p.text[unit - 1 : unit - 1 + n]
                i = np.flatnonzero(near)
                if not len(i):
                    continue
                digest = words.runs(p.hash, unit)[i]
                point = words.code_points(p)
                base = point[p.bounds[p.text[i]]]
                begin = point[p.start[i]] - base
                end = point[p.end[i + unit - 1]] - base
                order = np.lexsort((i, digest, p.text[i]))
                new = np.r_[True, (digest[order][1:] != digest[order][:-1]) | (p.text[i][order][1:] != p.text[i][order][:-1])]
                again = np.zeros(len(i), dtype=bool)
                again[order] = i[order] >= i[order][np.maximum.accumulate(np.where(new, np.arange(len(i)), 0))] + unit
                second = words.runs(words.mix(p.hash ^ words.ODD[41]), unit)[i]
                at = p.lo + p.text[i]
                columns = [digest.view(np.int64), second.view(np.int64), doc[at], part[at], *((x.astype(np.int32)) for x in (i - first[p.text[i]], begin, end)), again]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    return run


def _line_spans(texts: DataFrame, least: int) -> DataFrame:
    """Lines and paragraphs that occur earlier; lines within such paragraphs are left to these."""
    schema = "d1 long, d2 long, doc_id long, part long, start long, end long, place int, n_words int, kind int"
    units = stored(texts.mapInArrow(_lines(least), schema), "units")
    # One digest is counted of every unit; places are shuffled of those alone that have it twice.
    again = stored(units.groupBy("d1").agg(F.count("*").alias("k")).where("k > 1"), "again")
    twice = stored(joined(units, again, ["d1"]), "twice")
    drop(units, again)
    first = twice.groupBy("d1", "d2").agg(F.min(F.struct(*AT, "start", "kind")).alias("first"), F.count("*").alias("k"))
    later = joined(twice, stored(first.where("k > 1"), "first"), ["d1", "d2"])
    later = later.where(F.struct(*AT, "start") != F.struct(*[f"first.{c}" for c in (*AT, "start")]))
    by_start = Window.partitionBy(*AT).orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, 0)
    upto = F.max(F.when(F.col("kind") == 1, F.col("end"))).over(by_start)
    later = later.select(*AT, "start", "end", "place", "n_words", "kind", F.col("first.doc_id").alias("kept_doc_id"), upto.alias("upto"))
    return later.where("kind = 1 or upto is null or upto < end").drop("upto")


def _passage_spans(texts: DataFrame, copies: DataFrame, unit: int) -> DataFrame:
    """Maximal runs of words each of which lies in a run of ``unit`` words that occurs earlier."""
    width = unit // 2
    schema = "anchor long, doc_id long, part long, place int, whole long, again boolean"
    anchors = stored(texts.mapInArrow(_anchors(width, unit), schema), "anchors")
    twice = anchors.groupBy("anchor").agg(F.min("whole").alias("low"), F.max("whole").alias("high"), F.max("again").alias("again"), F.count("*").alias("k"))
    twice = stored(twice.where("low < high or again").select("anchor", "k"), "twice")
    places = joined(anchors.select("anchor", *AT, "place"), twice, ["anchor"]).groupBy(*AT).agg(F.collect_list("place").alias("places"))
    places = stored(places.join(small(copies), AT, "left_anti"), "places")
    drop(anchors, twice)
    schema = "d1 long, d2 long, doc_id long, part long, place int, begin int, end int, again boolean"
    runs = stored(texts.join(places, AT).mapInArrow(_units(width, unit), schema), "runs")
    first = runs.groupBy("d1", "d2").agg(F.min(F.struct(*AT)).alias("first"), F.max(F.struct(*AT)).alias("last"), F.max("again").alias("any"), F.count("*").alias("k"))
    first = stored(first.where("first < last or any").select("d1", "d2", "first", "k"), "first")
    later = joined(runs, first, ["d1", "d2"]).where(F.struct(F.col("first.doc_id"), F.col("first.part")) < F.struct(*AT))
    later = later.unionByName(joined(runs.where("again"), first, ["d1", "d2"]).where(F.struct(F.col("first.doc_id"), F.col("first.part")) == F.struct(*AT)))
    by_place = Window.partitionBy(*AT).orderBy("place")
    spans = later.withColumn("new", (F.col("place") - F.lag("place", 1, -unit - 1).over(by_place) > unit).cast("int"))
    spans = spans.withColumn("span", F.sum("new").over(by_place))
    spans = spans.groupBy(*AT, "span").agg(
        F.min("begin").cast("long").alias("start"),
        F.max("end").cast("long").alias("end"),
        F.min("place").alias("place"),
        (F.max("place") - F.min("place") + unit).cast("int").alias("n_words"),
        F.min_by("first.doc_id", "place").alias("kept_doc_id"),
    )
    return spans.select(*AT, "start", "end", "place", "n_words", F.lit(3).alias("kind"), "kept_doc_id")


def _uncovered(spans: DataFrame) -> DataFrame:
    """``spans`` without the passages whose words all lie in lines and paragraphs of ``spans``."""
    by_place = Window.partitionBy(*AT).orderBy("place", "kind").rowsBetween(Window.unboundedPreceding, 0)
    stop, unit = F.col("place") + F.col("n_words"), F.col("kind") < 3
    # Lines and paragraphs that follow each other without a word between are one stretch.
    before = Window.partitionBy(*AT).orderBy("place", "kind").rowsBetween(Window.unboundedPreceding, -1)
    begins = unit & (F.coalesce(F.max(F.when(unit, stop)).over(before), F.lit(-1)) < F.col("place"))
    rows = spans.select("*", F.sum(begins.cast("int")).over(by_place).alias("stretch"))
    reach = F.max(F.when(unit, stop)).over(Window.partitionBy(*AT, "stretch"))
    rows = rows.select("*", reach.alias("reach"))
    return rows.where(unit | F.col("reach").isNull() | (F.col("reach") < stop)).drop("stretch", "reach")


@scoped
def repeated(docs: DataFrame, unit: int | None = UNIT, least: int = LEAST) -> DataFrame:
    """Spans to remove: doc_id, start, end (code points, end exclusive), n_words, kept_doc_id, unit.

    ``docs`` needs doc_id and text; other columns are not read. unit tells the kind of a span. text: a copy of
    a whole text, with the least doc_id of its equals. paragraph, line: one of at least ``least`` words
    that occurs earlier, in a smaller doc_id or above; lines of a removed paragraph are not told again.
    passage: a maximal run of words each of which lies in a run of ``unit`` words that occurs earlier, in
    a smaller doc_id or in the same text without overlap; kept_doc_id has the earliest occurrence of its first
    run. Without ``unit`` passages are not looked for. Texts, paragraphs and lines under ``least`` words are kept. Null and empty texts have no units. Rows
    with a null doc_id are left out, and those of one doc_id with different texts are told apart; such with equal
    texts are one. Without documents there are no rows. Work at a time is that of one text.
    """
    texts = placed(docs.where(F.col("doc_id").isNotNull()))
    texts = texts.select(*AT, F.coalesce("text", F.lit("")).alias("text"))
    named = texts.select(*AT, F.md5("text").alias("whole"))
    firsts = named.groupBy("whole").agg(F.min(F.struct(*AT)).alias("first"), F.count("*").alias("k")).where("k > 1")
    copies = joined(named, stored(firsts, "firsts"), ["whole"]).where(F.struct(*AT) > F.col("first"))
    copies = stored(copies.select(*AT, F.col("first.doc_id").alias("kept_doc_id")), "copies")

    spans = _line_spans(texts, least).join(small(copies).select(*AT), AT, "left_anti")
    if unit:
        spans = _uncovered(spans.unionByName(_passage_spans(texts, copies.select(*AT), unit)))
    bare = F.btrim("text", F.lit(" \t\n\x0b\x0c\r"))
    start = F.length("text") - F.length(F.ltrim("text", F.lit(" \t\n\x0b\x0c\r")))
    whole = texts.join(small(copies), AT).select(
        *AT,
        start.cast("long").alias("start"),
        (start + F.length(bare)).cast("long").alias("end"),
        F.lit(0).alias("place"),
        F.size(F.split(bare, "[ \t-\r]+")).alias("n_words"),
        F.lit(0).alias("kind"),
        "kept_doc_id",
    )
    every = spans.unionByName(whole.where(F.col("n_words") >= least))
    name = F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind") + 1)
    return every.select("doc_id", "part", "start", "end", F.col("n_words").cast("long").alias("n_words"), "kept_doc_id", name.alias("unit"))


def remove(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``docs`` with the spans of ``repeated`` cut out of text; removed keeps their original offsets.

    Documents without spans stay as they are, with an empty array. Spans may overlap.
    """
    cuts = spans.groupBy(*AT).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("_cuts"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    every = placed(docs, row).join(cuts, AT, "left")
    every = every.select("text", "_row", F.coalesce("_cuts", F.array().cast("array<struct<start:bigint,end:bigint>>")).alias("removed"))
    every = every.mapInArrow(_cut, every.schema)
    others = [F.col("text") if c == "text" else F.col(f"_row.`{c}`") for c in docs.columns if c != "removed"]
    return every.select(*others, "removed")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch["text"].to_pylist()
        for k, cuts in enumerate(batch["removed"]):
            if len(cuts):
                kept, at = [], 0
                for cut in cuts.as_py():
                    kept.append(texts[k][at : max(cut["start"], at)])
                    at = max(cut["end"], at)
                texts[k] = "".join([*kept, texts[k][at:]])
        yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), *batch.columns[1:]], names=batch.schema.names)
