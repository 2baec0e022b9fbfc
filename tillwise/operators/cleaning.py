"""Cleaning of the five feeds."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.functions.ordering import exact_quantiles
from tillwise.functions.text import strip_whitespace

# Fixed values of the cleaning rules.
CORRUPT_MARK = "###CORRUPT###"
EMPTY_REVIEW_TEXT = "neutral review placeholder"
RATING_RANGE = (1, 5)


def coerce_numeric(column: str, default: float | None = 0.0) -> Column:
    """Unparsable or missing input, a NaN included, becomes ``default``."""
    number = F.expr(f"try_cast(`{column}` as double)")
    value = F.when(~F.isnan(number), number)
    return value if default is None else F.coalesce(value, F.lit(default))


def user_mode(df: DataFrame, by: list[str], column: str, out: str) -> DataFrame:
    """Most frequent non-null value per group, the smallest on ties.

    Counts per (group, value) first, so a group's rows never meet in one task.
    """
    counts = (
        df.where(F.col(column).isNotNull()).groupBy(*by, column).agg(F.count(F.lit(1)).alias("n"))
    )
    rank = F.struct(F.col("n"), (-F.col(column)).alias("smallest_first"))
    return counts.groupBy(*by).agg(F.max_by(column, rank).alias(out))


def user_home_location(tx: DataFrame) -> DataFrame:
    """Per user the modal location; a user with no known location has none."""
    homes = user_mode(tx, ["user_id"], "location_id", "home_location")
    return tx.select("user_id").distinct().join(homes, "user_id", "left")


@dataclass(frozen=True)
class TransactionFill:
    """Replacement values taken from the whole feed before any row is changed."""

    location: int | None
    amount: float | None


def fit_transaction_fill(tx: DataFrame) -> TransactionFill:
    frame = tx.select("location_id", F.abs("amount").alias("amount"))
    medians = exact_quantiles(frame, {"location_id": [0.5], "amount": [0.5]})
    location = medians["location_id"][0]
    return TransactionFill(
        None if location is None else math.trunc(location), medians["amount"][0]
    )


def clean_transactions(tx: DataFrame, fill: TransactionFill | None = None) -> DataFrame:
    """Fill missing locations, repair amounts; every row and column is kept.

    Only rows without a location take part in the join with the users' modes;
    the others pass through without a shuffle.
    """
    fill = fill or fit_transaction_fill(tx)
    positive = F.abs("amount")
    repaired = tx.withColumn(
        "amount", F.when(positive <= 0, F.lit(fill.amount)).otherwise(positive)
    )
    known = repaired.where(F.col("location_id").isNotNull())
    homes = user_mode(tx, ["user_id"], "location_id", "home_location")
    location_type = tx.schema["location_id"].dataType
    filled = (
        repaired.where(F.col("location_id").isNull())
        .join(homes, "user_id", "left")
        .withColumn(
            "location_id",
            F.coalesce("home_location", F.lit(fill.location)).cast(location_type),
        )
        .select(*tx.columns)
    )
    return known.unionByName(filled)


def clean_reviews(reviews: DataFrame) -> DataFrame:
    text = F.replace(F.coalesce("text", F.lit("")), F.lit(CORRUPT_MARK), F.lit(""))
    stripped = strip_whitespace(text)
    return reviews.withColumn("text", stripped).withColumn(
        "text", F.when(F.col("text") == "", EMPTY_REVIEW_TEXT).otherwise(F.col("text"))
    )


def clean_baskets(lines: DataFrame) -> DataFrame:
    return (
        lines.where(F.col("product_id").isNotNull())
        .withColumn("product_id", strip_whitespace(F.upper(F.col("product_id").cast("string"))))
        .where(F.length("product_id") > 0)
    )


def clean_churn(users: DataFrame) -> DataFrame:
    median = exact_quantiles(users, {"monthly_spend": [0.5]})["monthly_spend"][0]
    return users.withColumn("monthly_spend", F.coalesce("monthly_spend", F.lit(median)))


def clean_ratings(ratings: DataFrame) -> DataFrame:
    low, high = RATING_RANGE
    clipped = F.least(F.greatest(F.col("rating"), F.lit(float(low))), F.lit(float(high)))
    return ratings.where(F.col("rating").isNotNull()).withColumn("rating", clipped.cast("int"))
