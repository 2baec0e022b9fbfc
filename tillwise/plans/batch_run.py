"""The whole batch run: lake in, result tables, models and run records out."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.operators import (
    anomaly,
    baskets,
    cleaning,
    collaborative,
    features,
    models,
    rollups,
    sentiment,
)
from tillwise.plans import findings
from tillwise.sources import feeds, offsets, readers, writers
from tillwise.streaming import transactions as streams
from tillwise.workspace import materialise


# Rows of a streamed batch by mode.
BATCH_ROWS_FULL = 800
BATCH_ROWS_QUICK = 400


@dataclass(frozen=True)
class RunOptions:
    mode: str = "full"
    min_support: float = baskets.SUPPORT_FULL
    min_confidence: float = baskets.CONFIDENCE
    fraud_trees: int = 80
    churn_rounds: int = 100
    n_trees: int = anomaly.N_TREES
    #: Transactions of a logical batch of the stream.
    batch_rows: int = BATCH_ROWS_FULL
    stream: bool = True

    @staticmethod
    def quick() -> RunOptions:
        return RunOptions(
            mode="quick", min_support=baskets.SUPPORT_QUICK, batch_rows=BATCH_ROWS_QUICK
        )


def read_lake(spark: SparkSession, lake: str) -> dict[str, DataFrame]:
    schemas = {
        "transactions": feeds.TRANSACTIONS,
        "reviews": feeds.REVIEWS,
        "order_line_items": feeds.ORDER_LINES,
        "user_churn_features": feeds.CHURN,
        "user_product_ratings": feeds.RATINGS,
    }
    frames = {}
    for name, schema in schemas.items():
        if writers.LAKE_FORMATS[name] == "csv":
            key = "txn_id" if name == "transactions" else None
            frames[name] = readers.read_csv(spark, f"{lake}/{name}", schema, key)
        else:
            frames[name] = readers.read_json_lines(spark, f"{lake}/{name}", schema)
    return frames


def run(spark: SparkSession, lake: str, out: str, options: RunOptions = RunOptions()) -> str:
    """Run every step on the lake at ``lake``; returns the run id.

    Tables that several steps read are written once and read back.
    """
    run_id = uuid.uuid4().hex
    feed = read_lake(spark, lake)
    figures: dict[str, DataFrame] = {}
    n = F.count(F.lit(1))

    # Text feeds that are read more than once become columnar first.
    raw = materialise(feed["transactions"], "transactions")
    clean = materialise(cleaning.clean_transactions(raw), "clean-transactions")
    featured = materialise(features.engineer_fraud_features(clean), "featured")

    full = models.train_fraud_model(featured, n_trees=options.fraud_trees)
    base = models.train_fraud_baseline(raw, n_trees=options.fraud_trees)
    full.save(f"{out}/models/fraud_rf")
    base.save(f"{out}/models/fraud_rf_baseline")
    writers.write_table(full.score(featured), f"{out}/fraud_scored_transactions")

    forest = anomaly.fit_forest(featured, n_trees=options.n_trees)
    forest.save(f"{out}/models/anomaly_forest")
    anomalies = anomaly.flag_outliers(
        materialise(anomaly.anomaly_score(featured, forest), "anomaly-scores")
    )
    writers.write_table(
        features.existing_columns(anomalies, anomaly.SCORE_COLUMNS),
        f"{out}/transaction_anomaly_scores",
    )
    writers.write_table(anomaly.top_anomalies(anomalies), f"{out}/transaction_anomalies_top500")

    rollup = rollups.fraud_user_rollup(clean)
    writers.write_table(rollup, f"{out}/fraud_user_rollups")

    reviews = materialise(
        sentiment.score_reviews(cleaning.clean_reviews(feed["reviews"])), "scored-reviews"
    )
    writers.write_table(reviews, f"{out}/sentiment_reviews")

    support = baskets.basket_support(
        cleaning.clean_baskets(feed["order_line_items"]), options.min_support
    )
    itemsets = baskets.frequent_itemsets(support)
    rules = baskets.association_rules(itemsets, support.n_baskets, options.min_confidence)
    writers.write_table(itemsets, f"{out}/frequent_itemsets")
    writers.write_table(rules, f"{out}/association_rules")

    customers = materialise(feed["user_churn_features"], "customers")
    users = materialise(cleaning.clean_churn(customers), "churn-users")
    churn = models.train_churn_model(users, rounds=options.churn_rounds)
    churn.save(f"{out}/models/churn_gbt")
    writers.write_table(churn.score(users), f"{out}/churn_scores")

    centred = materialise(
        collaborative.centred_ratings(cleaning.clean_ratings(feed["user_product_ratings"])),
        "centred",
    )
    unit = materialise(collaborative.unit_ratings(centred), "unit")
    near = collaborative.neighbors(unit)
    writers.write_table(near, f"{out}/models/cf_neighbors")
    near = readers.read_table(spark, f"{out}/models/cf_neighbors")
    recs = collaborative.recommend(near, centred, k=5)
    writers.write_table(recs, f"{out}/recommendations")

    writers.write_json_summary(rollups.user_spend_top(raw), f"{out}/spend_summary")

    if options.stream:
        homes = materialise(cleaning.user_home_location(clean), "homes")
        path = offsets.folder_of(clean)
        batches = offsets.stream_rows(spark, path, feeds.TRANSACTIONS, options.batch_rows)
        writers.write_table(
            streams.score_micro_batches(batches, full), f"{out}/streaming_fraud_batches"
        )
        arriving = readers.stream_table(spark, path, feeds.TRANSACTIONS)
        writers.write_table(
            streams.run_available(streams.score_events(arriving, homes, full), "live"),
            f"{out}/streaming_fraud_events",
        )
    writers.write_table(
        collaborative.own_top_items(centred), f"{out}/streaming_recommendations"
    )

    def one(frame: DataFrame, name: str) -> DataFrame:
        return frame.agg(n.alias(name))

    figures["data_lake"] = one(raw, "transactions_rows").withColumn(
        "rollup_users", rollup.agg(n).scalar()
    )
    figures["fraud_model_clean"] = full.metrics()
    figures["fraud_model_baseline"] = base.metrics()
    figures["transaction_anomalies"] = anomaly.anomaly_summary(anomalies, forest=forest)
    figures["sentiment"] = sentiment.sentiment_accuracy(reviews).withColumnRenamed(
        "n", "n_labelled"
    ).withColumn("n_reviews", reviews.agg(n).scalar())
    figures["churn"] = churn.metrics()
    figures["market_basket"] = one(
        readers.read_table(spark, f"{out}/association_rules"), "n_rules"
    ).withColumn("n_frequent_itemsets", itemsets.agg(n).scalar())
    figures["collaborative_filtering"] = one(
        centred.select("user_id").distinct(), "n_users_in_matrix"
    ).withColumn(
        "n_products_in_matrix", centred.select("product_id").distinct().agg(n).scalar()
    )
    metrics = materialise(findings.metric_table(figures), "metrics")
    writers.write_metrics(metrics, run_id, f"{out}/metrics")
    writers.write_table(findings.findings_table(metrics), f"{out}/findings")
    writers.append_run_manifest(spark, f"{out}/run_manifest", run_id, options.mode)
    writers.append_history(metrics, f"{out}/metrics_history")
    return run_id
