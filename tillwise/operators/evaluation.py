"""Classification metrics as aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions.scan import RANGE_ROWS, in_ranges, prefix_sums
from tillwise.workspace import materialise


def confusion_matrix(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.groupBy(
        F.col(label).cast("string").alias("label"),
        F.col(prediction).cast("string").alias("prediction"),
    ).agg(F.count(F.lit(1)).alias("n"))


def accuracy(df: DataFrame, label: str, prediction: str) -> DataFrame:
    hit = (F.col(label) == F.col(prediction)).cast("int")
    return df.agg(F.avg(hit).alias("accuracy"), F.count(F.lit(1)).alias("n"))


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def classification_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision, recall, f1 and support per class, plus accuracy and both averages.

    One aggregate per row pair, then everything works on the confusion table.
    A division by zero counts as 0.
    """
    table = confusion_matrix(df, label, prediction)
    hit = F.col("label") == F.col("prediction")
    roles = table.select(
        F.explode(
            F.array(
                F.struct(
                    F.col("label").alias("class"),
                    F.col("n").alias("support"),
                    F.lit(0).cast("long").alias("predicted"),
                    F.when(hit, F.col("n")).otherwise(0).cast("long").alias("correct"),
                ),
                F.struct(
                    F.col("prediction").alias("class"),
                    F.lit(0).cast("long").alias("support"),
                    F.col("n").alias("predicted"),
                    F.lit(0).cast("long").alias("correct"),
                ),
            )
        ).alias("r")
    ).select("r.*")
    sums = roles.groupBy("class").agg(
        *[F.sum(c).alias(c) for c in ("support", "predicted", "correct")]
    )
    precision = _ratio(F.col("correct"), F.col("predicted"))
    recall = _ratio(F.col("correct"), F.col("support"))
    scored = sums.withColumns({"precision": precision, "recall": recall}).withColumn(
        "f1_score",
        _ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")),
    )
    names = ("precision", "recall", "f1_score")
    rolled = scored.rollup("class").agg(
        F.grouping("class").alias("is_total"),
        F.sum("support").alias("support"),
        F.sum("correct").alias("correct"),
        *[F.avg(c).alias(f"macro_{c}") for c in names],
        *[F.sum(F.col(c) * F.col("support")).alias(f"weighted_{c}") for c in names],
    )

    def line(name: Column, *values: Column) -> Column:
        return F.struct(
            name.alias("class"),
            *[v.cast("double").alias(c) for c, v in zip(names, values)],
            F.col("support").alias("support"),
        )

    hits = _ratio(F.col("correct"), F.col("support"))
    total_lines = F.array(
        line(F.lit("accuracy"), hits, hits, hits),
        line(F.lit("macro avg"), *[F.col(f"macro_{c}") for c in names]),
        line(
            F.lit("weighted avg"),
            *[_ratio(F.col(f"weighted_{c}"), F.col("support")) for c in names],
        ),
    )
    # A class row of the rollup holds one class, so its mean is its own value.
    class_line = F.array(line(F.col("class"), *[F.col(f"macro_{c}") for c in names]))
    return rolled.select(
        F.explode(F.when(F.col("is_total") == 1, total_lines).otherwise(class_line)).alias("l")
    ).select("l.*")


def roc_auc(
    df: DataFrame, score: str, label: str, rows_per_bin: int = RANGE_ROWS
) -> DataFrame:
    """Exact rank AUC of a 0/1 label, equal scores counting half.

    Rows are first reduced to counts per distinct score. Score ranges are then ranked
    side by side; what lies below a range comes from a prefix scan over the ranges.
    """
    per_score = df.where(F.col(score).isNotNull()).groupBy(F.col(score).alias("score")).agg(
        # Doubles: the products below exceed a long on very large inputs.
        F.count_if(F.col(label) == 1).cast("double").alias("pos"),
        F.count_if(F.col(label) == 0).cast("double").alias("neg"),
    )
    # Read several times below, and much smaller than the rows.
    ranged = in_ranges(materialise(per_score, "score-counts"), ["score"], rows_per_bin, "range_bin")
    lower = (
        Window.partitionBy("range_bin").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    )
    wins = F.col("pos") * (F.coalesce(F.sum("neg").over(lower), F.lit(0.0)) + F.col("neg") / 2)
    per_bin = (
        ranged.withColumn("wins", wins)
        .groupBy("range_bin")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum("wins").alias("wins"))
    )
    below = prefix_sums(materialise(per_bin, "score-ranges"), "range_bin", ["neg"])
    total = F.sum(F.col("wins") + F.col("pos") * F.col("before_neg"))
    both = F.sum("pos") * F.sum("neg")
    return below.agg(F.when(both > 0, total / both).alias("roc_auc"))


FINDING_HIGHER = "full model ranks fraud better than the amount-only baseline"
FINDING_LOWER = "amount-only baseline ranks fraud better than the full model"
FINDING_TIED = "full model and baseline are tied"


def compare_models(full: DataFrame, baseline: DataFrame) -> DataFrame:
    """Two one-row metric frames (roc_auc, accuracy) side by side with a verdict."""
    rows = full.withColumn("model", F.lit("full")).unionByName(
        baseline.withColumn("model", F.lit("baseline"))
    )
    both = rows.agg(
        *[
            F.max(F.when(F.col("model") == m, F.col(c))).alias(f"{m}_{c}")
            for m in ("full", "baseline")
            for c in ("roc_auc", "accuracy")
        ]
    )
    gap = F.col("full_roc_auc") - F.col("baseline_roc_auc")
    return both.withColumn(
        "finding",
        F.when(gap > 0, FINDING_HIGHER).when(gap < 0, FINDING_LOWER).when(gap == 0, FINDING_TIED),
    )
