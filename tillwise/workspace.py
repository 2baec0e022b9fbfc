"""Shared scratch space for written intermediates and stream checkpoints.

Intermediates that several later stages read are written as Parquet to the
folder named by ``spark.checkpoint.dir``, so they outlive a lost executor and
cut the lineage behind them.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_DROPPED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Folder per application, only where a local session names none.
_local: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the session names; a fresh local one only on a local master."""
    configured = spark.conf.get(_SETTING, None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local:
        _local[app] = tempfile.mkdtemp(prefix="tillwise-")
    return _local[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return it as a scan of the written table.

    What the write has shuffled is dropped with its end: nothing reads it after that, and
    Spark itself waits until the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    with _shuffles_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def _shuffles_dropped(spark: SparkSession):
    # A session's own value is kept.
    if spark.conf.get(_DROPPED, None) is not None:
        yield
        return
    spark.conf.set(_DROPPED, "true")
    try:
        yield
    finally:
        spark.conf.unset(_DROPPED)
