"""Review sentiment from a word list, or from a lexicon table with phrases."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.functions.lexicon import with_polarity
from tillwise.functions.text import (
    INTENSIFIERS,
    NEGATIONS,
    POLARITY,
    polarity,
    sentiment_label,
    word_tokens,
)
from tillwise.operators.evaluation import accuracy, classification_report

POLARITY_DIGITS = 4


def score_reviews(
    reviews: DataFrame,
    words: dict[str, float] = POLARITY,
    negations: list[str] = NEGATIONS,
    intensifiers: dict[str, float] = INTENSIFIERS,
    threshold: float = 0.05,
) -> DataFrame:
    """Add polarity and sentiment to every review; blank texts are neutral."""
    value = polarity(F.col("tokens"), words, negations, intensifiers)
    return (
        reviews.withColumn("tokens", word_tokens(F.col("text")))
        .withColumn("polarity", F.round(value, POLARITY_DIGITS))
        .drop("tokens")
        .withColumn("sentiment", sentiment_label(F.col("polarity"), threshold))
    )


def score_with_lexicon(
    reviews: DataFrame, lexicon: DataFrame, threshold: float = 0.05
) -> DataFrame:
    """Add polarity and sentiment by a lexicon table with phrases; see ``functions.lexicon``."""
    scored = with_polarity(reviews, lexicon)
    return scored.withColumn("polarity", F.round("polarity", POLARITY_DIGITS)).withColumn(
        "sentiment", sentiment_label(F.col("polarity"), threshold)
    )


def labelled(scored: DataFrame) -> DataFrame:
    return scored.where(F.col("true_sentiment").isNotNull())


def sentiment_counts(scored: DataFrame) -> DataFrame:
    return scored.groupBy("sentiment").agg(F.count(F.lit(1)).alias("n"))


def sentiment_accuracy(scored: DataFrame) -> DataFrame | None:
    """Share of labelled reviews predicted right; None without a label column."""
    if "true_sentiment" not in scored.columns:
        return None
    return accuracy(labelled(scored), "true_sentiment", "sentiment")


def sentiment_report(scored: DataFrame) -> DataFrame | None:
    if "true_sentiment" not in scored.columns:
        return None
    return classification_report(labelled(scored), "true_sentiment", "sentiment")
