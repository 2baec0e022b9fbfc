"""Vectors as packed rows: one row per distinct vector, with the smallest ids that have it."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """True for arrays without null, infinite or not-a-number components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad, F.lit(False))


def stack(column: pa.Array, dtype) -> np.ndarray:
    """Packed vectors as rows of an array; shorter ones end in zeros."""
    rows = [np.frombuffer(v.as_py(), dtype) for v in column]
    if not rows:
        return np.empty((0, 0), dtype)
    width = max(map(len, rows))
    if all(len(r) == width for r in rows):
        return np.concatenate(rows).reshape(len(rows), width)
    return np.stack([np.pad(r, (0, width - len(r))) for r in rows])


def distinct(rows: DataFrame, vector: str, id_col: str, k: int) -> DataFrame:
    """Per distinct ``vector``: ``ids``, its ``k`` smallest ids, ascending.

    With one id more than neighbours are asked for, a row that looks for others never
    needs the rest. The rank is limited before the shuffle, so a vector that a third
    of the rows share moves ``k`` rows a task.
    """
    ranked = rows.withColumn(
        "_rank", F.row_number().over(W.partitionBy(vector).orderBy(id_col))
    ).where(F.col("_rank") <= k)
    return ranked.groupBy(vector).agg(
        F.array_sort(F.collect_list(id_col)).alias("ids")
    )
