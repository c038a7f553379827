"""Sizes of Arrow batches, and memory that Python workers give back."""

from __future__ import annotations

import ctypes
import ctypes.util
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import SparkSession

ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """While a job runs, Arrow batches of few rows: a batch holds whole texts, once in
    the executor's JVM and once in its Python worker."""
    before = spark.conf.get(ROWS)
    spark.conf.set(ROWS, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(ROWS, before)


def give_back() -> None:
    """Return freed memory to the machine: workers wait for later tasks with what they hold."""
    pa.default_memory_pool().release_unused()
    name = ctypes.util.find_library("c")
    trim = getattr(ctypes.CDLL(name), "malloc_trim", None) if name else None
    if trim:
        trim(0)


def gathered(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at least ``size`` bytes, but for the last."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.nbytes
        if n >= size:
            yield pa.concat_batches(held)
            held, n = [], 0
    if held:
        yield pa.concat_batches(held)
