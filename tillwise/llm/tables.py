"""Intermediate tables that are joined more than once or are too large to move again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from tillwise.workspace import fresh_path


def bucketed(df: DataFrame, key: str, label: str) -> DataFrame:
    """``df`` written to the shared folder in as many buckets as shuffles have partitions.

    A join or grouping by ``key`` with that many partitions reads it where it lies.
    """
    spark = df.sparkSession
    name = f"{label}_{uuid.uuid4().hex}".replace("-", "_")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = fresh_path(spark, label)
    df.write.bucketBy(buckets, key).option("path", path).saveAsTable(name)
    return spark.table(name)
