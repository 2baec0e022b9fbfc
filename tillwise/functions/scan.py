"""Rows in ranges of an order, and running totals over the ranges, level by level.

A range holds about as many rows as asked for, whatever the input: their number grows
instead. Ranges are written, so a recomputed task sees the same ones. Totals of ranges
stay a table: they are summed in groups of ``FAN`` ranges, the groups' totals in groups
again, and joined back. No offsets reach the driver or a plan.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.functions.skew import join_on_group
from tillwise.workspace import materialise

RANGE_ROWS = 500_000
FAN = 1_000
#: Blocks of work that a range of ``in_blocks`` is planned for.
BLOCKS_PER_RANGE = 4


def in_ranges(
    df: DataFrame, order: Sequence[str], rows_per_range: int = RANGE_ROWS, out: str = "range"
) -> DataFrame:
    """``df`` plus ``out``: range numbers from 0 that follow ``order``, nulls first.

    End ``order`` with a unique column: ties on the columns before it are then split too,
    so equal values cannot make one range long. Spark samples the bounds, of any number
    of ranges at most a million rows. Several ranges are written; a single one is not.
    """
    rows = df.count()
    ranges = max(1, math.ceil(rows / rows_per_range))
    if ranges == 1:
        return df.withColumn(out, F.lit(0))
    placed = df.repartitionByRange(ranges, *order).withColumn(out, F.spark_partition_id())
    return materialise(placed, "ranges")


def in_blocks(
    df: DataFrame, order: Sequence[str], weight: str, work: int, least: int, spread: int
) -> DataFrame:
    """``df``, without ``weight``, plus ``block``: rows that follow each other in ``order``.

    A block ends once its weights sum to ``work``; for small inputs sooner, at a share of
    1 / ``spread``, but not before ``least``. What rows near each other have in common is
    then needed by one block, not by as many as there are rows. The result is written.
    """
    rows, total = df.agg(F.count(F.lit(1)), F.sum(weight)).first()
    total = total or 0
    size = max(1, min(work, max(least, math.ceil(total / spread))))
    ranges = max(1, math.ceil(rows / RANGE_ROWS), math.ceil(total / (BLOCKS_PER_RANGE * size)))
    names = [c for c in df.columns if c != weight]
    schema = T.StructType([*df.select(*names).schema.fields, T.StructField("block", T.LongType())])

    def cut(batches):
        first, seen = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            upto = seen + np.cumsum(batch.column(weight).to_numpy())
            before = np.concatenate([[seen], upto[:-1]])[: len(upto)]
            seen = int(upto[-1]) if len(upto) else seen
            block = pa.array((first + before // size).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), block], [*names, "block"]
            )

    placed = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    return materialise(placed.mapInArrow(cut, schema), "blocks")


def prefix_sums(
    ranges: DataFrame, key: str, columns: Sequence[str], by: Sequence[str] = (), fan: int = FAN
) -> DataFrame:
    """``ranges`` plus ``before_<column>``: the sums over smaller ``key`` of the same ``by``.

    ``key`` counts from 0 and is unique within ``by``. No window holds more than ``fan``
    rows of a group.
    """
    top = ranges.agg(F.max(key)).first()[0] or 0
    return _level(ranges, key, list(columns), list(by), fan, top)


def _level(rows: DataFrame, key: str, columns: list, by: list, fan: int, top: int) -> DataFrame:
    above = f"{key}_above"
    grouped = rows.withColumn(above, F.floor(F.col(key) / fan))
    earlier = (
        Window.partitionBy(*by, above).orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    )
    zero = {c: F.lit(0).cast(rows.schema[c].dataType) for c in columns}
    inside = grouped.withColumns(
        {f"before_{c}": F.coalesce(F.sum(c).over(earlier), zero[c]) for c in columns}
    )
    if top < fan:
        return inside.drop(above)
    sums = grouped.groupBy(*by, above).agg(*[F.sum(c).alias(c) for c in columns])
    higher = _level(sums, above, columns, by, fan, top // fan).select(
        *by, above, *[F.col(f"before_{c}").alias(f"higher_{c}") for c in columns]
    )
    joined = join_on_group(inside, higher, [*by, above], "inner")
    return joined.withColumns(
        {f"before_{c}": F.col(f"before_{c}") + F.col(f"higher_{c}") for c in columns}
    ).drop(above, *[f"higher_{c}" for c in columns])
