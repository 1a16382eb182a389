"""Helpers shared by the corpus operators: tables, scratch storage and size-checked broadcasts."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import materialise, scratch_path, shared_dir

__all__ = ["ascii_lower", "fresh", "in_fold", "materialise", "partitions", "release", "scratch_path", "shared_dir", "sized", "sized_arrays", "small_batches", "table", "tidy", "worker_cpu_bound"]

#: Rows that a side may have at most to be broadcast; beyond it the join is shuffled.
BROADCAST_ROWS = 400_000

#: Bytes of a batch that goes to a Python worker. Spark's own limits (10,000 rows, 64 MB) have the JVM and a worker hold some 20 MB of texts each, more than once.
BATCH = "4m"
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

#: Every A-Z of the specification, and what it becomes.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sized(df: DataFrame, rows: int | None = None, limit: int | None = None) -> DataFrame:
    """The side of a join, with a broadcast hint only if its counted rows are within the limit. df must be cheap to count: a materialised table."""
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n <= (BROADCAST_ROWS if limit is None else limit) else df


def sized_arrays(df: DataFrame, column: str, factor: int = 5) -> DataFrame:
    """sized() for a table with an array column: entries are counted, not rows, up to factor times the limit of rows, so the bound is one of bytes too."""
    return sized(df, df.agg(F.coalesce(F.sum(F.size(column) + 2), F.lit(0))).first()[0], factor * BROADCAST_ROWS)


def fresh(df: DataFrame, base: str) -> str:
    """A column name that df doesn't have yet."""
    have, name = {c.lower() for c in df.columns}, base
    while name.lower() in have:
        name += "_"
    return name


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(text: Column) -> Column:
    """A-Z become a-z and nothing else changes. lower() would change other letters too, so it serves only texts that are all ASCII."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def in_fold(doc_id: Column, modulus: int, remainder: int) -> Column:
    """crc32 of doc_id as text, modulo modulus, is remainder. A null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % modulus == remainder


def release() -> None:
    """Give memory that a Python worker no longer uses back to the system: workers outlive their tasks, and share the executor's memory with the JVM."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # no glibc
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def small_batches(df: DataFrame) -> DataFrame:
    """df, in a session that sends BATCH bytes to a Python worker at once, unless its user has set that limit. The setting is read when the query runs, so it stays; it changes no result."""
    conf = df.sparkSession.conf
    if conf.get(BATCH_SETTING, None) is None:
        conf.set(BATCH_SETTING, BATCH)
    return df


def tidy(run: Callable[[Iterator], Iterator], *forget: Callable[[], None]) -> Callable[[Iterator], Iterator]:
    """A function for mapInArrow that leaves nothing behind in the worker when its partition ends."""

    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            for f in forget:
                f()
            release()

    return wrapped


def worker_cpu_bound() -> None:
    """Numeric libraries in a Python worker use one thread: the executor's cores belong to its tasks."""
    for name in ("OMP_NUM_THREADS", "OPENBLAS_NUM_THREADS", "MKL_NUM_THREADS"):
        os.environ.setdefault(name, "1")
