"""Aggregates behind the dashboard and the findings report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.functions.ordering import exact_quantiles
from tillwise.functions.text import yes_no
from tillwise.operators.features import QUANTILE_DIGITS

FRAUD_THRESHOLD = 0.5
ANOMALY_THRESHOLD = 0.55


def histogram(df: DataFrame, value: str, by: Column, bins: int) -> DataFrame:
    """Counts per equal-width bin between minimum and maximum, per group."""
    x = F.col(value)
    span = df.agg(
        F.min(value).cast("double").alias("low"), F.max(value).cast("double").alias("high")
    )
    low, high = span.select("low").scalar(), span.select("high").scalar()
    step = F.floor((x - low) / (high - low) * F.lit(float(bins)))
    position = F.when(high > low, F.least(step, F.lit(bins - 1))).otherwise(0)
    return (
        df.where(x.isNotNull())
        .groupBy(by.alias("series"), position.cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def amount_histogram(tx: DataFrame, bins: int = 60) -> DataFrame:
    return histogram(tx, "amount", yes_no(F.col("is_fraud")), bins)


def polarity_histogram(scored: DataFrame, bins: int = 40) -> DataFrame:
    return histogram(scored, "polarity", F.col("sentiment"), bins)


def churn_histogram(users: DataFrame, score: str = "churn_proba", bins: int = 40) -> DataFrame:
    return histogram(users, score, yes_no(F.col("churned")), bins)


def rate_by_quantile_bin(
    df: DataFrame, value: str, label: str, bins: int = 10
) -> DataFrame:
    """Mean label per quantile bin of a value.

    Bins are right-closed, the lowest edge belongs to the first, equal edges are
    merged, so equal values always share a bin.
    """
    found = exact_quantiles(df, {value: [i / bins for i in range(bins + 1)]})[value]
    edges = sorted({round(e, QUANTILE_DIGITS) for e in found if e is not None})
    x = F.round(F.col(value), QUANTILE_DIGITS)
    below = F.lit(0)
    for edge in edges:
        below = below + F.when(x > F.lit(edge), 1).otherwise(0)
    decile = F.greatest(below - 1, F.lit(0))
    return (
        df.where(F.col(value).isNotNull())
        .groupBy(decile.alias("decile"))
        .agg(F.avg(label).alias("rate"), F.count(F.lit(1)).alias("n"))
    )


def threshold_counts(df: DataFrame, score: str, thresholds: Sequence[float]) -> DataFrame:
    """Rows at or above each threshold, all thresholds in one pass."""
    counted = df.agg(*[F.count_if(F.col(score) >= t).alias(f"t{i}") for i, t in enumerate(thresholds)])
    lines = F.array(
        *[
            F.struct(F.lit(float(t)).alias("threshold"), F.col(f"t{i}").alias("n"))
            for i, t in enumerate(thresholds)
        ]
    )
    return counted.select(F.explode(lines).alias("l")).select("l.*")


def alert_counts(fraud: DataFrame, fraud_score: str, anomalies: DataFrame, anomaly_score: str) -> DataFrame:
    """Rows at or above the default alert threshold of each score."""
    parts = [
        threshold_counts(df, score, [limit]).withColumn("alert", F.lit(name))
        for name, df, score, limit in (
            ("fraud", fraud, fraud_score, FRAUD_THRESHOLD),
            ("anomaly", anomalies, anomaly_score, ANOMALY_THRESHOLD),
        )
    ]
    return parts[0].unionByName(parts[1]).select("alert", "threshold", "n")


def long_metrics(section: str, row: DataFrame) -> DataFrame:
    """A one-row frame of figures as (section, metric, value) lines; texts are left out."""
    figures = [f.name for f in row.schema if f.dataType.typeName() != "string"]
    lines = F.array(
        *[
            F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"))
            for c in figures
        ]
    )
    return row.select(F.lit(section).alias("section"), F.explode(lines).alias("l")).select(
        "section", "l.metric", "l.value"
    )


def lake_counts(transactions: DataFrame, reviews: DataFrame, lines: DataFrame,
                users: DataFrame, ratings: DataFrame, itemsets: DataFrame | None = None,
                rules: DataFrame | None = None) -> DataFrame:
    """Rows per feed, distinct users and products of the rating feed, and what was mined."""
    mined = [("frequent_itemsets", itemsets), ("association_rules", rules)]
    parts = [
        ("transactions", transactions),
        ("reviews", reviews),
        ("order_line_items", lines),
        ("user_churn_features", users),
        ("user_product_ratings", ratings),
        *[(name, frame) for name, frame in mined if frame is not None],
    ]
    out = None
    for name, frame in parts:
        line = frame.agg(F.count(F.lit(1)).alias("value")).select(
            F.lit(name).alias("metric"), "value"
        )
        out = line if out is None else out.unionByName(line)
    for name, column in (("rating_users", "user_id"), ("rating_products", "product_id")):
        line = (
            ratings.select(column)
            .distinct()
            .agg(F.count(F.lit(1)).alias("value"))
            .select(F.lit(name).alias("metric"), "value")
        )
        out = out.unionByName(line)
    return out
