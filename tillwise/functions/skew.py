"""Finding and separating groups that are too large for one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.workspace import materialise

HOT_ROWS = 1_000_000
MAX_HOT_KEYS = 50_000


def hot_groups(
    df: DataFrame,
    by: Sequence[str],
    hot_rows: int = HOT_ROWS,
    max_keys: int = MAX_HOT_KEYS,
) -> DataFrame | None:
    """Keys whose group exceeds ``hot_rows``, or None when no group does.

    The limit is the same for every input, so no ordinary group outgrows a task. The
    keys are written once and come back as a scan of that table. Up to ``max_keys`` of
    them the frame carries a broadcast hint; more are left to a shuffled join.
    """
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("group_rows"))
    keys = materialise(counts.where(F.col("group_rows") > hot_rows).select(*by), "hot-groups")
    found = keys.count()
    if not found:
        return None
    return F.broadcast(keys) if found <= max_keys else keys


def join_on_group(left: DataFrame, right: DataFrame, by: Sequence[str], how: str) -> DataFrame:
    """Join on group keys the way grouping sees them: a missing key is a group too."""
    renamed = right.withColumnsRenamed({c: f"group_{c}" for c in by})
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"group_{c}")) for c in by])
    return left.join(renamed, same, how).drop(*[f"group_{c}" for c in by])


def split_hot(
    df: DataFrame, by: Sequence[str], hot: DataFrame | None
) -> tuple[DataFrame, DataFrame | None]:
    """(rows of ordinary groups, rows of hot groups); one narrow pass each."""
    if hot is None:
        return df, None
    return join_on_group(df, hot, by, "left_anti"), join_on_group(df, hot, by, "left_semi")
