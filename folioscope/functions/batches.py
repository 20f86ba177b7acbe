"""Bounds on what Python workers hold: the bytes of an Arrow batch, and memory freed after each."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import SparkSession

try:
    _TRIM = ctypes.CDLL("libc.so.6").malloc_trim
except (OSError, AttributeError):  # another C library
    _TRIM = None


def trim() -> None:
    """Gives freed memory back to the system: workers live on, and an executor's memory is shared by all of them."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def small_batches(spark: SparkSession, most: int = 4 << 20) -> None:
    """Lowers the session's bound on the bytes of an Arrow batch: texts stand in memory on both sides of the pipe."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key)
    if not now.rstrip("b").isdigit() or not 0 < int(now.rstrip("b")) <= most:
        spark.conf.set(key, str(most))
