"""Helpers shared by the operators: staged tables and their folders, bounded batches."""

from __future__ import annotations

import ctypes
import inspect
import math
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import wraps

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN: dict[str, str] = {}
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def shared_folder(spark: SparkSession) -> str:
    """A new folder name under ``spark.checkpoint.dir``; deleted when the session's JVM ends.

    Where the setting is missing, a local master gets a folder of its own, anything else an
    error: a folder of one machine is of no use to executors on others.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = _OWN.setdefault("root", tempfile.mkdtemp(prefix="tidemark-llm-"))
    path = f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"
    files, at = _place(spark, path)
    files.deleteOnExit(at)
    if (made := _made.get()) is not None:
        made.append(path)
    return path


def _place(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


@contextmanager
def noted_folders() -> Iterator[list[str]]:
    """The folders that ``shared_folder`` names meanwhile."""
    before = _made.set([])
    try:
        yield _made.get()
    finally:
        _made.reset(before)


def drop_folders(spark: SparkSession, paths: list[str]) -> None:
    """Delete folders whose tables nobody reads any more."""
    for path in paths:
        files, at = _place(spark, path)
        files.delete(at, True)


def staged(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` written to the shared folder and read back: cuts the lineage, computed once, safe
    from lost executors."""
    path = f"{shared_folder(df.sparkSession)}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def power_of_two(n: float) -> int:
    """The number of bits of the smallest power of two that isn't less than ``n``."""
    return max(0, math.ceil(math.log2(max(1.0, n))))


def _release() -> None:
    """Give free memory back to the system: workers live on after a task, several on a machine."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def releasing(f: Callable) -> Callable:
    """A map over batches, or a function of a group, that keeps no free memory when it ends."""
    if inspect.isgeneratorfunction(f):

        @wraps(f)
        def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            try:
                yield from f(batches)
            finally:
                _release()

        return mapped

    @wraps(f)
    def grouped(key: tuple, table: pa.Table) -> pa.Table:
        try:
            return f(key, table)
        finally:
            _release()

    return grouped


def small_batches(
    batches: Iterator[pa.RecordBatch], column: str, most_bytes: int
) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds at most ``most_bytes`` of ``column``, or one row."""
    for batch in batches:
        sizes = [x or 0 for x in pc.binary_length(batch.column(column)).to_pylist()]
        begin, total = 0, 0
        for i, size in enumerate(sizes):
            if i > begin and total + size > most_bytes:
                yield batch.slice(begin, i - begin)
                begin, total = i, 0
            total += size
        if begin < len(sizes):
            yield batch.slice(begin)
