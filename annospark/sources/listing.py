"""Directory trees as a data source: directories without files too, which readers of files do not list."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from annospark.functions import labels


def _opened(path: str):
    """(file system, path in it) of a URI or a local path; imported where it runs, on executors too."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


class _Subtree(InputPartition):
    def __init__(self, path: str, deep: bool):
        self.path, self.deep = path, deep


class _TreeReader(DataSourceReader):
    def __init__(self, options: dict):
        self.root, self.levels = options["path"].rstrip("/"), int(options.get("levels", 1))

    def partitions(self) -> list[_Subtree]:
        """One for each directory ``levels`` below the root, and one for the entries of each directory above; only
        these levels are listed here."""
        from pyarrow import fs

        system, root = _opened(self.root)
        found, level = [], [root]
        for _ in range(self.levels):
            found += [_Subtree(d, False) for d in level]
            inner = [system.get_file_info(fs.FileSelector(d)) for d in level]
            level = [x.path for infos in inner for x in infos if x.type == fs.FileType.Directory]
        return found + [_Subtree(d, True) for d in level]

    def read(self, partition: _Subtree) -> Iterator[tuple]:
        from pyarrow import fs

        system, root = _opened(self.root)
        open_ = [partition.path]
        while open_:
            for x in system.get_file_info(fs.FileSelector(open_.pop())):
                is_directory = x.type == fs.FileType.Directory
                yield x.path[len(root) :].lstrip("/"), is_directory, None if is_directory else x.size
                if is_directory and partition.deep:
                    open_.append(x.path)


class TreeSource(DataSource):
    """path (below the root), is_directory and length of everything below ``path``."""

    @classmethod
    def name(cls) -> str:
        return "tree"

    def schema(self) -> str:
        return "path string, is_directory boolean, length long"

    def reader(self, schema) -> DataSourceReader:
        return _TreeReader(self.options)


def tree(spark: SparkSession, root: str, levels: int = 1) -> DataFrame:
    """Everything below ``root``, a URI that pyarrow's file systems open or an absolute local path; a task lists each
    subtree ``levels`` below it. The root itself is not listed; a root that isn't there is an error."""
    spark.dataSource.register(TreeSource)
    return spark.read.format("tree").option("path", root).option("levels", levels).load()


def directories(listing: DataFrame) -> DataFrame:
    """directory, name, normal of the root (an empty path) and every directory of a listing, with files or without."""
    name = F.element_at(F.split("directory", "/"), -1)
    found = listing.where("is_directory").select(F.col("path").alias("directory"))
    found = found.unionByName(listing.sparkSession.range(1).select(F.lit("").alias("directory")))
    return found.withColumn("name", name).withColumn("normal", labels.normalize(name, "-"))


def images(listing: DataFrame) -> DataFrame:
    """path and length of the images of a listing."""
    return listing.where(~F.col("is_directory") & labels.extension(F.col("path")).isin(labels.IMAGE_ENDS)).select("path", "length")
