"""Memory that a Python worker hands back when a task is done, and batches of bounded size.

Workers outlive their tasks: several wait idle beside those of the next stage, each with
what its allocators keep of the last task. ``give_back`` returns that to the system.

The executor's allocators keep as well what batches of texts once took: Spark counts a
batch in rows (4,096 read, 10,000 or 64 MB sent to a worker), and whole texts make that
tens of MB a task. ``small_batches`` bounds both.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import SparkSession

# Setting, Spark's default, value for whole texts.
_BATCHES = [
    ("spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "1m"),
    ("spark.sql.parquet.columnarReaderBatchSize", "4096", "512"),
]


def small_batches(spark: SparkSession) -> None:
    """Small batches from here on, unless the session has sizes of its own. No result changes."""
    for key, default, small in _BATCHES:
        if spark.conf.get(key) == default:
            spark.conf.set(key, small)


def give_back() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass  # other C libraries return memory by themselves


def returning_memory(task: Callable[..., Iterator]) -> Callable[..., Iterator]:
    """A task over batches that gives back its memory when it ends."""

    @wraps(task)
    def run(*args):
        try:
            yield from task(*args)
        finally:
            give_back()

    return run
