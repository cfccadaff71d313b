"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import file_system, scratch_path

BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
SHUFFLE_GOES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_COPIES: ContextVar[list[str] | None] = ContextVar("copies", default=None)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, every other code point as it is; null as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str, copies: list[str] | None = None) -> DataFrame:
    """Cut the lineage: write to the cluster's shared folder and read back.

    Every executor can read the copy, so losing one loses nothing; unlike
    ``checkpoint()`` the plan runs once. Its shuffle files go as soon as the copy is there. copies: gets the copy's path,
    if not the list of ``passing``."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    copies = passing_copies() if copies is None else copies
    copies.append(path)
    with _set(spark, SHUFFLE_GOES, "true"):
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def passing_copies() -> list[str]:
    """Paths of the copies that go when the innermost ``passing`` ends."""
    copies = _COPIES.get()
    return [] if copies is None else copies


@contextmanager
def passing(spark: SparkSession, copies: list[str] | None = None) -> Iterator[None]:
    """For copies that only jobs inside read: those written inside, and the given ones, go at the end. Shuffle files of
    inner jobs, also of those that collect, go after each."""
    copies = [] if copies is None else copies
    before = _COPIES.set(copies)
    try:
        with _set(spark, SHUFFLE_GOES, "true"):
            yield
    finally:
        _COPIES.reset(before)
        for path in copies:
            fs, at = file_system(spark, path)
            fs.delete(at(path), True)


def lean(rows: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """rows, after which a worker hands back the memory that it freed: it may wait for long while others need it."""
    def run(batches: Iterator) -> Iterator:
        yield from rows(batches)
        hand_back()
    return run


def hand_back() -> None:
    """Memory that this process has freed goes to the system, where its C library can do so."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


@contextmanager
def _set(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def text_batches(spark: SparkSession, size: str = "8m"):
    """Arrow batches of at most ``size`` (or one row): a worker's memory follows neither the length of texts
    nor the number of rows a batch. For jobs that run inside; results don't depend on it."""
    return _set(spark, BATCH_BYTES, size)


def crc32_text(c: Column) -> Column:
    """crc32 of a value as text."""
    return F.crc32(c.cast("string").cast("binary"))
