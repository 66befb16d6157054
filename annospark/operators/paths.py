"""Directory trees of images: listings by path, counts by directory, class directories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annospark.functions import labels


def parents(path: Column) -> Column:
    """The directories above a file, the root as an empty string first."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/"))


def resolved(path: Column, root: str = "/") -> Column:
    """An absolute path without empty parts, ``.`` and ``..``; relative ones lie below ``root``. Links are not followed, and
    a scheme stays as it is."""
    whole = F.when(path.rlike("^([a-zA-Z][a-zA-Z0-9+.-]*:)?/"), path).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), path))
    scheme = F.regexp_extract(whole, "^([a-zA-Z][a-zA-Z0-9+.-]*:(?://[^/]+)?)?", 0)
    parts = F.split(F.substring(whole, F.length(scheme) + 1, F.length(whole)), "/")

    def step(kept: Column, part: Column) -> Column:
        up = F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0)))
        return F.when(part.isin("", "."), kept).when(part == "..", up).otherwise(F.concat(kept, F.array(part)))

    return F.concat(scheme, F.lit("/"), F.array_join(F.aggregate(parts, F.array().cast("array<string>"), step), "/"))


def images(files: DataFrame, path: str = "path") -> DataFrame:
    return files.where(labels.extension(F.col(path)).isin(labels.IMAGE_ENDS))


def directory_counts(files: DataFrame, path: str = "path") -> DataFrame:
    """directory, n_direct, n_recursive of every directory with a file beneath it."""
    rows = files.select(F.explode(parents(F.col(path))).alias("directory"), F.regexp_replace(path, "/?[^/]*$", "").alias("own"))
    return rows.groupBy("directory").agg(F.count_if(F.col("directory") == F.col("own")).alias("n_direct"), F.count("*").alias("n_recursive"))


def every_directory(directories: DataFrame, files: DataFrame, path: str = "path") -> DataFrame:
    """``directories`` (directory, and other columns) with n_direct and n_recursive images, 0 where there are none: what
    ``directory_counts`` can't tell of paths alone. ``files`` lie in directories of the table."""
    counts = directory_counts(files, path)
    found = directories.join(counts, "directory", "left")
    return found.withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in ("n_direct", "n_recursive")})


def class_members(files: DataFrame, path: str = "path", real: str = "real", fake: str = "fake") -> DataFrame:
    """``files`` with is_real and is_fake: beneath a directory whose normal name is that of the class."""
    above = F.transform(F.slice(F.split(path, "/"), F.lit(1), F.size(F.split(path, "/")) - 1), lambda d: labels.normalize(d, "-"))
    return files.withColumns({"is_real": F.array_contains(above, real), "is_fake": F.array_contains(above, fake)})


def class_directories(files: DataFrame, path: str = "path", names: tuple[str, ...] = ("real", "fake")) -> DataFrame:
    """class, directory, n_images of the directories whose normal name is that of a class."""
    counts = directory_counts(files, path).select("directory", F.col("n_recursive").alias("n_images"))
    name = labels.normalize(F.element_at(F.split("directory", "/"), -1), "-")
    return counts.select(name.alias("class"), "directory", "n_images").where(F.col("class").isin(*names))


def overlap(files: DataFrame, path: str = "path") -> DataFrame:
    """Paths that belong to both classes."""
    return class_members(files, path).where("is_real and is_fake").select(path).distinct()


def prepare_report(files: DataFrame, path: str = "path") -> DataFrame:
    """One row: n_directories, n_images, found_real, found_fake, overlap_count of a listing."""
    seen = class_members(images(files, path), path)
    counts = seen.agg(
        F.count("*").alias("n_images"),
        F.count_if("is_real").alias("found_real"),
        F.count_if("is_fake").alias("found_fake"),
        F.count_if(F.col("is_real") & F.col("is_fake")).alias("overlap_count"),
    )
    # Two tables of one row.
    return files.select(F.explode(parents(F.col(path))).alias("d")).agg(F.count_distinct("d").alias("n_directories")).crossJoin(counts)


def gate_violations(files: DataFrame, path: str = "path") -> DataFrame:
    """gate, value, n of what a strict run stops at: images of both classes, and classes without any."""
    report = prepare_report(files, path)
    rules = [
        ("class_overlap", "both", F.col("overlap_count"), F.col("overlap_count") > 0),
        ("missing_class_folder", "real", F.col("found_real"), F.col("found_real") == 0),
        ("missing_class_folder", "fake", F.col("found_fake"), F.col("found_fake") == 0),
    ]
    found = F.array_compact(F.array(*[F.when(holds, F.struct(F.lit(gate).alias("gate"), F.lit(value).alias("value"), n.alias("n"))) for gate, value, n, holds in rules]))
    return report.select(F.inline(found))
