import struct
import zlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annospark.operators import payloads, profile, sampling


def png(width, height, colour, rows, cut=None, depth=8):
    def chunk(name, body):
        return struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))

    head = chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, depth, colour, 0, 0, 0))
    return (b"\x89PNG\r\n\x1a\n" + head + chunk(b"IDAT", zlib.compress(b"".join(b"\0" + bytes(r) for r in rows))) + chunk(b"IEND", b""))[:cut]


def jpeg(width, height, components, end=b"\xff\xd9"):
    frame = struct.pack(">HBHHB", 8 + 3 * components, 8, height, width, components) + bytes(3 * components)
    return b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0" + frame + b"\xff\xda\x00\x03x" + b"\x11" * 9 + end


RGBA = png(2, 1, 6, [[255, 0, 0, 128, 0, 0, 255, 255]])


def test_inspect(spark):
    bad = bytearray(RGBA)
    bad[20] ^= 1
    cases = [
        (RGBA, ("png", 2, 1, "RGBA", None)),
        (png(3, 2, 2, [[0] * 9] * 2), ("png", 3, 2, "RGB", None)),
        (png(9, 1, 0, [[0, 0]], depth=1), ("png", 9, 1, "1", None)),
        (png(3, 2, 2, [[0] * 9]), ("png", None, None, None, "truncated")),
        (png(0, 1, 0, [[]]), ("png", 0, 1, "L", "non_positive_dimensions")),
        (bytes(bad), ("png", None, None, None, "bad_checksum")),
        (RGBA[:50], ("png", None, None, None, "truncated")),
        (jpeg(7, 5, 3), ("jpeg", 7, 5, "RGB", None)),
        (jpeg(7, 5, 4), ("jpeg", 7, 5, "CMYK", None)),
        (jpeg(7, 5, 3, b""), ("jpeg", None, None, None, "truncated")),
        (b"\xff\xd8\xff\xe0broken", ("jpeg", None, None, None, "truncated")),
        (b"RIFF" + struct.pack("<I", 22) + b"WEBPVP8X" + bytes([10, 0, 0, 0, 0x10, 0, 0, 0, 4, 0, 0, 6, 0, 0]), ("webp", 5, 7, "RGBA", None)),
        (b"BM" + bytes(8), ("bmp", None, None, None, "truncated")),
        (b"text", (None, None, None, None, "unknown_format")),
        (b"", (None, None, None, None, "empty")),
        (None, (None, None, None, None, "empty")),
    ]
    rows = spark.createDataFrame([(i, c and bytearray(c)) for i, (c, _) in enumerate(cases)], "id int, content binary")
    for r in payloads.verified(rows.repartition(3)).collect():
        want = cases[r.id][1]
        assert (r.format, r.width, r.height, r.mode, r.reason) == want and r.ok == (want[-1] is None), r.id


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "a b.png").write_bytes(RGBA)
    (tmp_path / "in" / "broken.jpg").write_bytes(b"\xff\xd8\xff\xe0broken")
    (tmp_path / "in" / "grey.png").write_bytes(png(1, 1, 0, [[77]]))
    return tmp_path


def test_files_are_decoded_where_they_are_read(spark, folder):
    found = payloads.verified_files(spark, [f"{folder}/a b.png", f"{folder}/in/broken.jpg", f"{folder}/in/grey.png"])
    rows = {r.path.rsplit("/", 1)[1].replace("%20", " "): tuple(r)[1:] for r in found.collect()}
    assert rows == {"a b.png": (2, 1, "RGBA", None, True), "broken.jpg": (None, None, None, "undecodable", False), "grey.png": (1, 1, "L", None, True)}


def test_flattened_on_white(spark, folder):
    images = spark.read.format("image").option("dropInvalid", "false").load([f"{folder}/a b.png", f"{folder}/in/broken.jpg", f"{folder}/in/grey.png"])
    rows = {r.path.rsplit("/", 1)[1].replace("%20", " "): r.data and list(r.data) for r in payloads.flattened(images).collect()}
    # 255 * 128 / 255 of red on 127 of white.
    assert rows == {"a b.png": [255, 127, 127, 0, 0, 255], "broken.jpg": None, "grey.png": [77, 77, 77]}
    opaque = [{0: 255, 255: 0, 1: 254, 127: 128}[a] for a in (0, 255, 1, 127)]
    data = bytearray(x for a in (0, 255, 1, 127) for x in (0, 0, 0, a))
    shape = "struct<origin:string,height:int,width:int,nChannels:int,mode:int,data:binary>"
    black = spark.createDataFrame([(("o", 1, 4, 4, 24, data),)], f"image {shape}")
    assert list(payloads.flattened(black).first().data)[::3] == opaque


FORMS = "id int, image struct<bytes:binary,path:string>"


@pytest.mark.parametrize("max_paths", [10, 1])
def test_resolved_forms(spark, folder, max_paths):
    """Bytes before a path, paths below the root, absolute and with a scheme; by name or from all files below the root."""
    rows = [(1, (bytearray(b"own"), "in/grey.png")), (2, (None, "in/grey.png")), (3, (None, f"{folder}/in/./grey.png")), (4, (None, f"file://{folder}/in//broken.jpg"))]
    rows += [(5, (None, "none.png")), (6, (None, None)), (7, None), (8, (None, "https://h/x.png")), (9, (None, ""))]
    found = {r.id: r for r in payloads.resolved(spark.createDataFrame(rows, FORMS), "image", str(folder), max_paths).collect()}
    grey = (folder / "in" / "grey.png").read_bytes()
    assert [found[i].content for i in (1, 2, 3, 4)] == [b"own", grey, grey, b"\xff\xd8\xff\xe0broken"]
    problems = [found[i].problem for i in range(1, 10)]
    assert problems == [None] * 4 + ["file_not_found", "image_missing_bytes_or_path", "unsupported_image_value", "remote_path", "image_missing_bytes_or_path"]
    paths = spark.createDataFrame([(1, "a b.png"), (2, None)], "id int, photo string")
    told = {r.id: r for r in payloads.verified(payloads.resolved(paths, "photo", str(folder))).collect()}
    assert (told[1].width, told[1].mode, told[2].problem, told[2].reason) == (2, "RGBA", "unsupported_image_value", "empty")
    raw = spark.createDataFrame([(1, bytearray(RGBA)), (2, None)], "id int, jpg binary")
    assert [r.problem for r in payloads.resolved(raw, "jpg", str(folder)).orderBy("id").collect()] == [None, "unsupported_image_value"]
    with pytest.raises(ValueError):
        payloads.resolved(paths, "id", str(folder))


def test_only_chosen_files_are_read(spark, folder):
    rows = spark.createDataFrame([(2, (None, "in/grey.png"))], FORMS)
    found = payloads.resolved(rows, "image", str(folder))
    plan = found._jdf.queryExecution().toString()
    assert "broken.jpg" not in plan and [f.split(":", 1)[1].lstrip("/") for f in found.inputFiles()] == [f"{folder}/in/grey.png".lstrip("/")]


def test_lazy_fill_verifies_little(spark):
    """Close to the quota; the rows of ``fill`` and ``fill_errors``, which know the whole pool."""
    seen = spark.sparkContext.accumulator(0)
    rows = spark.range(3000).select("id", (F.col("id") % 3 == 0).cast("string").alias("class"), (F.col("id") % 2).alias("pref"))
    ok = F.pmod(F.xxhash64("id"), F.lit(10)) < 7

    def verify(batch):
        n = batch.count()
        seen.add(n)
        return batch.withColumn("ok", F.when(ok, True))

    chosen, failed = sampling.fill_lazily(rows, "class", "id", 60, verify, "pref")
    pool = rows.withColumn("ok", ok)
    same = lambda a, b: sorted(map(tuple, a.select("class", "id").collect())) == sorted(map(tuple, b.select("class", "id").collect()))
    full = sampling.fill(pool, "class", "id", 60, "ok", "pref")
    assert same(chosen, full) and same(failed, sampling.fill_errors(pool, "class", "id", 60, "ok", "pref"))
    assert {(r.id, r["rank"]) for r in chosen.collect()} == {(r.id, r["rank"]) for r in full.collect()}
    assert 120 / 0.8 < seen.value < 120 / 0.7 * 1.5
    # A pool that can't fill its classes is verified as a whole, and so is none.
    chosen, failed = sampling.fill_lazily(rows.where("id < 60"), "class", "id", 60, verify, "pref")
    assert chosen.count() + failed.count() == 60
    assert sampling.fill_lazily(rows.limit(0), "class", "id", 60, verify, "pref")[0].count() == 0


def test_image_columns(spark):
    decoded = "struct<origin:string,height:int,width:int,nChannels:int,mode:int,data:binary>"
    rows = [((None, 1, 1, 3, 16, None), (None, 1, 1, 1, 0, None), bytearray(b"1"), "x.png"), ((None, 1, 1, 4, 24, None), None, None, "text")]
    df = spark.createDataFrame(rows, f"one {decoded}, two {decoded}, Alpha binary, url string")
    found = {r["column"]: tuple(r)[1:] for r in profile.image_scores(df).collect()}
    assert found == {"one": (True, 2, 10), "two": (True, 1, 1), "Alpha": (True, 1, -8), "url": (False, 1, 2)}
    assert profile.image_column(df) == "one"
    assert {m: profile.image_scores(df.select(F.col("Alpha").alias(m))).first().score for m in ("Mask", "segmentation", "segmentation_mask", " IMG ")} == {"Mask": -8, "segmentation": -8, "segmentation_mask": 2, " IMG ": 12}
    named = df.select(F.col("url").alias("pic"), "Alpha", F.col("url").alias("other", metadata={"type": "Image"}))
    assert {r["column"]: r["typed"] for r in profile.image_scores(named).collect()} == {"pic": False, "Alpha": True, "other": True}


def test_label_columns(spark):
    rows = [(i % 3, f"s{i % 2}", ["real thing", "AI generated", None][i % 3], "x", i) for i in range(9)]
    df = spark.createDataFrame(rows, "kind int, text string, note string, same string, n int")
    scores = {r["column"]: (r.n_distinct, r.score) for r in profile.label_scores(df).collect()}
    # kind and n: few values, whole, each with one category of note, and two of these; text: values with two categories each.
    assert scores == {"kind": (3, 9), "text": (2, 2), "n": (9, 9)}
    plan = profile.label_scores(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1 and plan.count("Aggregate") <= 3
    with pytest.raises(ValueError):
        profile.label_column(df)
    classed = df.select(F.col("same").alias("same", metadata={"type": "ClassLabel", "names": ["a"]}), "kind", "n", "note")
    assert profile.label_column(classed) == "same"
    with pytest.raises(ValueError, match="class type"):
        profile.label_column(classed.select("same", F.col("n").alias("n", metadata={"type": "ClassLabel"})))
    assert isinstance(classed.schema["same"].dataType, T.StringType)


def test_label_names(spark):
    card = spark.createDataFrame([("0", "card name")], "raw_value string, label_name string")
    classes = spark.createDataFrame([(0, "zero"), (1, "one")], "class_id int, class_name string")
    rows = [(0, "x", None), (1, "x", None), (7, "Fully-Synthetic", "x"), (7, "real", "edited"), (None, "Authentic / photo", "genuine")]
    df = spark.createDataFrame(rows, "raw int, a string, b string")
    named = lambda d, c, o: [r.label_name for r in sampling.label_names(d.coalesce(1), "raw", card, c, o).orderBy(F.col("raw").isNull(), "raw", "a").collect()]
    assert named(df, classes, None) == ["card name", "one", None, None, None]
    # Conflicting cues give none; a representative term stands for the text.
    assert named(df, classes, ["a", "b"]) == ["card name", "one", "fully_synthetic", None, "authentic"]
    assert named(df, None, None) == ["card name", None, None, None, None]
    text = df.selectExpr("cast(raw as string) raw", "a", "b")
    assert named(text, classes, ["a", "b"]) == ["card name", "one", "7", "7", "authentic"]
    assert named(text, None, None) == ["card name", "1", "7", "7", None]
