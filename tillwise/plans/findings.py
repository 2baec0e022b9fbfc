"""The findings report as a table, and the metric table of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.functions.text import fixed_text, percent_text
from tillwise.operators.reporting import long_metrics

# Section order of the report.
SECTIONS = [
    "data_lake",
    "fraud_model_clean",
    "fraud_model_baseline",
    "transaction_anomalies",
    "sentiment",
    "churn",
    "market_basket",
    "collaborative_filtering",
]
#: Figures that count rows of tables, whatever a model learnt.
COUNTED = [
    "transactions_rows", "rollup_users", "n_reviews", "n_frequent_itemsets", "n_rules",
    "n_users_in_matrix", "n_products_in_matrix",
]
#: Flagged rows may miss the expected share by this much.
SHARE_MARGIN = 0.01
_SHARES = ["top_100_overlap_with_labeled_fraud", "accuracy"]
_COUNTS = "^(n_|transactions|rollup).*"


def metric_table(rows: dict[str, DataFrame]) -> DataFrame:
    """One-row frames per section as one long table (section, metric, value)."""
    out = None
    for section, row in rows.items():
        lines = long_metrics(section, row)
        out = lines if out is None else out.unionByName(lines)
    return out


def findings_table(metrics: DataFrame) -> DataFrame:
    """Every figure with its printed form and, beside one figure of each section, a verdict.

    Pass a written table: it is read twice.
    """
    value, metric = F.col("value"), F.col("metric")
    printed = (
        F.when(metric.isin(_SHARES), percent_text(value))
        .when(metric.rlike(_COUNTS), F.coalesce(value.cast("long").cast("string"), F.lit("—")))
        .otherwise(fixed_text(value))
    )

    # One row of all figures; the metrics are a written table of a few dozen lines.
    key = F.concat_ws(".", "section", "metric")
    figures = metrics.agg(F.map_from_entries(F.collect_list(F.struct(key, "value")))).scalar()

    def figure(name: str) -> Column:
        return F.try_element_at(figures, F.lit(name))

    gap = figure("fraud_model_clean.roc_auc") - figure("fraud_model_baseline.roc_auc")
    flagged = figure("transaction_anomalies.n_flagged_outliers") / figure("transaction_anomalies.n_rows")
    expected = figure("transaction_anomalies.contamination")

    def ranks(name: str) -> Column:
        return F.when(figure(name) > 0.5, "ranks better than chance").when(
            figure(name) <= 0.5, "ranks no better than chance")

    def found(name: str, some: str, none: str) -> Column:
        return F.when(figure(name) > 0, some).when(figure(name) == 0, none)

    # The figure of a section that its verdict stands beside.
    verdicts = {
        "data_lake.transactions_rows": found("data_lake.transactions_rows", "has transactions", "empty"),
        "fraud_model_clean.roc_auc": F.when(gap > 0, "higher than the baseline")
        .when(gap < 0, "lower than the baseline")
        .when(gap == 0, "tied with the baseline"),
        "fraud_model_baseline.roc_auc": ranks("fraud_model_baseline.roc_auc"),
        "transaction_anomalies.n_flagged_outliers": F.when(
            F.abs(flagged - expected) <= SHARE_MARGIN, "flags the expected share"
        ).when(flagged.isNotNull() & expected.isNotNull(), "flags another share than expected"),
        "sentiment.accuracy": F.when(figure("sentiment.accuracy") > 0.5, "mostly agrees with the labels")
        .when(figure("sentiment.accuracy") <= 0.5, "mostly disagrees with the labels"),
        "churn.roc_auc": ranks("churn.roc_auc"),
        "market_basket.n_rules": found("market_basket.n_rules", "has rules", "no rules at this support"),
        "collaborative_filtering.n_users_in_matrix": found(
            "collaborative_filtering.n_users_in_matrix", "has users to compare", "no ratings"),
    }
    verdict = F.lit(None).cast("string")
    for name, text in verdicts.items():
        verdict = F.when(key == name, text).otherwise(verdict)
    order = F.array_position(F.array(*[F.lit(s) for s in SECTIONS]), F.col("section"))
    return metrics.select(
        order.cast("int").alias("section_no"),
        "section",
        "metric",
        "value",
        printed.alias("printed"),
        verdict.alias("finding"),
    )
