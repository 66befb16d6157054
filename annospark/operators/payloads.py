"""Image payloads: where their bytes are, whether they can be read, and pixels without transparency."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annospark.functions.images import inspect, mode_of_channels

PIXELS = "width int, height int, data binary"


def _parts(field: T.StructField) -> tuple[Column, Column, Column]:
    """(bytes, path, problem) of an image column: bytes, a struct of bytes and path, of which bytes come first, or a path."""
    c, none = F.col(f"`{field.name}`"), F.lit(None)
    if isinstance(field.dataType, T.BinaryType):
        return c, none.cast("string"), F.when(c.isNull(), "unsupported_image_value")
    if isinstance(field.dataType, T.StringType):
        return none.cast("binary"), c, F.when(c.isNull(), "unsupported_image_value")
    if isinstance(field.dataType, T.StructType) and {"bytes", "path"} & set(field.dataType.names):
        content = c["bytes"] if "bytes" in field.dataType.names else none.cast("binary")
        path = F.nullif(c["path"], F.lit("")) if "path" in field.dataType.names else none.cast("string")
        missing = F.when(c.isNull(), "unsupported_image_value").when(content.isNull() & path.isNull(), "image_missing_bytes_or_path")
        return content, F.when(content.isNull(), path), missing
    raise ValueError(f"{field.name} holds no image payloads")


def full_path(path: Column, root: str) -> Column:
    """A path as the file sources write it: relative ones below ``root``, with a scheme, without empty and dot parts."""
    base = root if ":/" in root else f"file:{root}"
    whole = F.when(path.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), path).when(path.startswith("/"), F.concat(F.lit(base.split(":", 1)[0] + ":"), path)).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), path))
    whole = F.regexp_replace(F.regexp_replace(whole, r"/(\./)+", "/"), "(?<!:)(?<!:/)//+", "/")
    return F.regexp_replace(whole, "^file:/+", "file:///")


def resolved(rows: DataFrame, column: str, root: str, max_paths: int = 10_000) -> DataFrame:
    """``rows``, those that were chosen, with content, the bytes of ``column``, and problem where there are none.

    Bytes in a row count before its path; bytes in rows move nowhere. Files are read by the binary source: exactly
    those that the rows name, where these are at most ``max_paths``, of which the driver holds the names; else all below
    ``root``, each joined where it is read if the names fit a broadcast. Remote addresses are told as a problem.
    """
    spark = rows.sparkSession
    content, path, problem = _parts(next(f for f in rows.schema.fields if f.name == column))
    given = rows.withColumns({"_bytes": content, "_path": full_path(path, root), "_problem": problem})
    remote = F.col("_path").rlike("^https?:")
    wanted = given.where(F.col("_path").isNotNull() & ~remote).select("_path").distinct()
    names = [r["_path"] for r in wanted.limit(max_paths + 1).collect()]
    if not names:
        return given.withColumns({"content": F.col("_bytes"), "problem": F.coalesce("_problem", F.when(remote, "remote_path"))}).drop("_bytes", "_path", "_problem")
    reader = spark.read.format("binaryFile")
    if len(names) <= max_paths:
        files = reader.load(_existing(spark, names)) if _existing(spark, names) else spark.createDataFrame([], "path string, content binary")
    else:
        files = reader.option("recursiveFileLookup", "true").load(root)
    files = files.select(full_path(F.col("path"), root).alias("_path"), F.col("content").alias("_content"))
    found = given.join(files, "_path", "left")
    absent = F.when(remote, "remote_path").when(F.col("_path").isNotNull() & F.col("_content").isNull(), "file_not_found")
    found = found.withColumns({"content": F.coalesce("_bytes", "_content"), "problem": F.coalesce("_problem", absent)})
    return found.drop("_bytes", "_path", "_problem", "_content")


def _existing(spark: SparkSession, names: list[str]) -> list[str]:
    """Those of some file names that are there; asked of the file system, by name, not by listing."""
    conf, path = spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs.Path
    return [n for n in names if path(n).getFileSystem(conf).exists(path(n))]


def verified(rows: DataFrame, content: str = "content") -> DataFrame:
    """``rows`` with format, width, height, mode, reason and ok of a binary column, in the tasks that hold the rows."""
    told = rows.withColumn("_image", inspect(F.col(content)))
    return told.select(*rows.columns, "_image.*").withColumn("ok", F.col("reason").isNull())


def verified_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """path, width, height, mode, reason and ok of image files, decoded by the JVM in the tasks that read them; files
    that can't be decoded stay, with the reason. WebP isn't among the formats that this reader knows."""
    images = spark.read.format("image").option("dropInvalid", "false").load(path)
    width, height, kind = F.col("image.width"), F.col("image.height"), F.col("image.mode")
    reason = F.when(kind < 0, "undecodable").when((width <= 0) | (height <= 0), "non_positive_dimensions")
    size = lambda c: F.when(kind >= 0, c)
    told = images.select(F.col("image.origin").alias("path"), size(width).alias("width"), size(height).alias("height"), mode_of_channels(kind).alias("mode"), reason.alias("reason"))
    return told.withColumn("ok", F.col("reason").isNull())


def _flat(n: int, data: np.ndarray) -> np.ndarray:
    """RGB pixels of those of n channels, blue first as the image source has them, on white where they let it through."""
    pixels = data.reshape(-1, n)
    if n == 1:
        return np.repeat(pixels, 3, axis=1)
    colours = pixels[:, 2::-1]
    if n == 3:
        return colours
    alpha = pixels[:, 3:].astype(np.uint32)
    return ((colours * alpha + 255 * (255 - alpha) + 127) // 255).astype(np.uint8)


def _flattened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        done = []
        for n, data in zip(batch["channels"].to_pylist(), batch["data"], strict=True):
            usable = n in (1, 3, 4) and data.is_valid
            done.append(_flat(n, np.frombuffer(data.as_buffer(), dtype=np.uint8)).tobytes() if usable else None)
        columns = [batch.column(i) for i in range(batch.num_columns - 2)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(done, pa.binary())], names=[*batch.schema.names[:-2], "data"])


def flattened(images: DataFrame, column: str = "image") -> DataFrame:
    """path, width, height and data of decoded images: RGB, three bytes a pixel, row by row. Transparent pixels are laid on
    white, rounded to the nearest; grey ones get three channels. Images that couldn't be decoded have null data."""
    c = F.col(column)
    kept = F.when(c["nChannels"] > 0, c["data"])
    rows = images.select(c["origin"].alias("path"), c["width"].alias("width"), c["height"].alias("height"), c["nChannels"].alias("channels"), kept.alias("data"))
    return rows.mapInArrow(_flattened, f"path string, {PIXELS}")
