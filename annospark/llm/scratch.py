"""Intermediate tables that survive the loss of an executor, and their removal.

A table is written once as Parquet to the folder that ``spark.checkpoint.dir`` names, which all
executors share, and read back; later stages then depend on files instead of on shuffle output. Tables that
are written inside of a scope go when it ends. Scopes belong to the thread that opens them, so operators in several
threads of a session do not remove each other's tables.
"""

from __future__ import annotations

import functools
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20)


class _Scopes(threading.local):
    def __init__(self):
        self.open: list[set[str]] = []


_scopes = _Scopes()
#: Jobs of all threads hand small batches to Python while a scope of any is open.
_lock, _small_batches = threading.Lock(), {"open": 0, "before": None}
_path: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


@functools.cache
def _local_folder() -> str:
    return "file://" + tempfile.mkdtemp(prefix="annospark-scratch-")


def folder(spark: SparkSession) -> str:
    """The shared folder. Where the setting is missing, one is made in local mode alone; a cluster has no
    machine-local folder that all executors see, so there this is an error."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (path or _local_folder()).rstrip("/")


def _remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Tables that are stored inside are removed at the end. Jobs inside hand texts to Python in batches of at most
    ``BATCH_BYTES``, of which a task holds a few at a time."""
    _scopes.open.append(set())
    with _lock:
        if not _small_batches["open"]:
            _small_batches["before"] = spark.conf.get(_BATCH, None)
            spark.conf.set(_BATCH, BATCH_BYTES)
        _small_batches["open"] += 1
    try:
        yield
    finally:
        with _lock:
            _small_batches["open"] -= 1
            if not _small_batches["open"]:
                before = _small_batches["before"]
                spark.conf.set(_BATCH, before) if before else spark.conf.unset(_BATCH)
        for path in _scopes.open.pop():
            _remove(spark, path)


def scoped(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """An operator of documents whose result is written, after which the tables it needed are removed. The
    result's own table stays until the caller's scope ends, if there is one."""

    @functools.wraps(operator)
    def run(docs: DataFrame, *args, **kwargs) -> DataFrame:
        with scope(docs.sparkSession):
            return keep(stored(operator(docs, *args, **kwargs), operator.__name__))

    return run


def keep(table: DataFrame) -> DataFrame:
    """A stored table that outlives the scope and belongs to the one around it, if there is one."""
    _scopes.open[-1].discard(_path[table])
    if len(_scopes.open) > 1:
        _scopes.open[-2].add(_path[table])
    return table


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` written to the shared folder and read back with the same schema."""
    spark = df.sparkSession
    path = f"{folder(spark)}/{name}-{uuid.uuid4().hex}"
    if _scopes.open:
        _scopes.open[-1].add(path)
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    _path[back] = path
    return back


def drop(*tables: DataFrame) -> None:
    """Remove stored tables that nothing reads any more."""
    for table in tables:
        path = _path.pop(table)
        _remove(table.sparkSession, path)
        for scope_ in _scopes.open:
            scope_.discard(path)


def small(df: DataFrame, max_rows: int = 400_000) -> DataFrame:
    """``df``, a stored table of a few numbers a row, to be broadcast if it has at most ``max_rows``
    rows; larger ones are joined by a shuffle."""
    return F.broadcast(df) if df.count() <= max_rows else df
