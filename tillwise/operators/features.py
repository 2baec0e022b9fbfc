"""Behavioural fraud features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions.ordering import group_quantile, sketched_order_window
from tillwise.functions.running import running_quantile
from tillwise.functions.scan import RANGE_ROWS
from tillwise.functions.skew import HOT_ROWS, hot_groups, join_on_group, split_hot
from tillwise.operators.cleaning import user_mode

FEATURES = ["amount", "unusual_location", "high_spend", "new_device"]
BASELINE_FEATURES = ["amount"]
SPEND_QUANTILE = 0.95
# Quantiles are compared at this many digits, above the noise of interpolation.
QUANTILE_DIGITS = 6


def _above(amount: Column, limit: Column) -> Column:
    flag = F.round(amount, QUANTILE_DIGITS) > F.round(limit, QUANTILE_DIGITS)
    return F.coalesce(flag.cast("int"), F.lit(0))


def _away(location: Column, home: Column) -> Column:
    return F.coalesce((location != home).cast("int"), F.lit(1))


def engineer_fraud_features(
    tx: DataFrame, by: Sequence[str] = ("user_id",), hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Add unusual_location, high_spend and new_device to each transaction.

    ``by`` names the scope of a user's history: the user alone, or the user
    within a batch. Groups of ordinary size share one exchange on ``by`` and use
    windows. Groups above ``hot_rows`` go through aggregates that combine before
    the shuffle and joins on unique or the few keys of hot groups. Pass ``hot_rows=None``
    when the caller already bounds the group size.
    """
    by = list(by)
    hot = None if hot_rows is None else hot_groups(tx, by, hot_rows)
    ordinary, large = split_hot(tx, by, hot)
    result = _windowed(ordinary, by)
    if large is not None:
        result = result.unionByName(_aggregated(large, by))
    return result


def _windowed(tx: DataFrame, by: list[str]) -> DataFrame:
    group = Window.partitionBy(*by)
    sighting = Window.partitionBy(*by, "device_id").orderBy("timestamp", "txn_id")
    amount, location = F.col("amount"), F.col("location_id")
    return (
        tx.withColumn("home", F.mode(location, True).over(group))
        .withColumn("spend_limit", F.percentile(amount, SPEND_QUANTILE).over(group))
        .withColumn("new_device", (F.row_number().over(sighting) == 1).cast("int"))
        .withColumn("unusual_location", _away(location, F.col("home")))
        .withColumn("high_spend", _above(amount, F.col("spend_limit")))
        .select(*tx.columns, "unusual_location", "high_spend", "new_device")
    )


def _aggregated(tx: DataFrame, by: list[str]) -> DataFrame:
    homes = user_mode(tx, by, "location_id", "home")
    amounts = tx.where(F.col("amount").isNotNull()).select(*by, F.col("amount").alias("v"))
    near = sketched_order_window(amounts, by, SPEND_QUANTILE)
    limits = group_quantile(near, by, SPEND_QUANTILE, "spend_limit")
    first_seen = (
        tx.groupBy(*by, "device_id")
        .agg(F.min(F.struct("timestamp", "txn_id")).alias("first"))
        .select(F.col("first.txn_id").alias("txn_id"), F.lit(1).alias("new_device"))
    )
    # Both tables have one row per hot group: at most skew.MAX_HOT_KEYS rows.
    known = join_on_group(tx, homes, by, "left")
    return (
        join_on_group(known, limits, by, "left")
        .join(first_seen, "txn_id", "left")
        .withColumn("new_device", F.coalesce("new_device", F.lit(0)))
        .withColumn("unusual_location", _away(F.col("location_id"), F.col("home")))
        .withColumn("high_spend", _above(F.col("amount"), F.col("spend_limit")))
        .select(*tx.columns, "unusual_location", "high_spend", "new_device")
    )


def high_spend_asof(
    tx: DataFrame, by: Sequence[str] = ("user_id",), hot_rows: int = HOT_ROWS,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """``tx`` plus ``spend_limit_asof`` and ``high_spend_asof``: high spend without hindsight.

    The limit is the quantile of the user's amounts before the transaction, in the order of
    timestamp and id; null, with flag 0, where there is none. Missing amounts are no history.
    """
    limited = running_quantile(
        tx, by, ["timestamp", "txn_id"], "amount", SPEND_QUANTILE, "spend_limit_asof",
        hot_rows, range_rows,
    )
    return limited.withColumn("high_spend_asof", _above(F.col("amount"), F.col("spend_limit_asof")))


def feature_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The feature columns as doubles, 0 for nulls and NaN, the other columns unchanged."""
    return df.withColumns({c: filled(c) for c in columns})


def filled(column: str) -> Column:
    """A number as a double; a null or NaN is missing and counts as 0."""
    return F.coalesce(F.nanvl(F.col(column).cast("double"), F.lit(0.0)), F.lit(0.0))


def existing_columns(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select(*[c for c in wanted if c in df.columns])
