"""Registered queries: each takes (session, data folder) and returns a frame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.functions import lexicon
from tillwise.functions.ordering import (
    exact_quantiles,
    group_order_window,
    group_quantile,
    occurrence_index,
)
from tillwise.functions.skew import HOT_ROWS
from tillwise.functions.text import yes_no
from tillwise.operators import (
    anomaly,
    baskets,
    cleaning,
    collaborative,
    evaluation,
    features,
    models,
    reporting,
    rollups,
    sentiment,
    whatif,
)
from tillwise.plans import findings, trained
from tillwise.sources import feeds, offsets, readers, writers
from tillwise.streaming import transactions as streams
from tillwise.workspace import materialise

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

DIGITS = 4
# For figures that are often short decimals themselves.
FINE_DIGITS = 6
SPLITS = 16
BATCH_SIZE = 800
RULE_CONFIDENCE = 0.05
THRESHOLDS = [round(i * 0.05, 2) for i in range(21)]


def query(make: Query) -> Query:
    REGISTRY[make.__name__] = make
    return make


def rounded(*names: str, digits: int = DIGITS) -> dict[str, Column]:
    # Adding zero turns a negative zero into zero.
    return {n: F.round(n, digits) + F.lit(0.0) for n in names}


def micros(df: DataFrame, name: str = "timestamp") -> DataFrame:
    return df.withColumn(f"{name}_us", F.unix_micros(F.col(name).cast("timestamp"))).drop(name)


def amount_score(df: DataFrame, name: str = "score") -> DataFrame:
    """A fixed score in [0, 1) from the amount alone, for checks without a model."""
    return df.withColumn(name, F.round(F.col("amount") / (F.col("amount") + 500.0), 6))


def joined(name: str) -> Column:
    return F.array_join(name, "|").alias(name)


# --- rollups --------------------------------------------------------------------


@query
def user_spend_top20(spark, folder):
    top = rollups.user_spend_top(feeds.transactions(spark, folder), 20)
    return top.withColumns(rounded("total_amount", "max_amount"))


@query
def user_spend_two_phase(spark, folder):
    split = rollups.with_split_id(feeds.transactions(spark, folder), "txn_id", SPLITS)
    merged = rollups.merge_user_spend(rollups.user_spend_partials(split, "split_id"))
    return merged.withColumns(rounded("total_amount", "max_amount"))


@query
def fraud_user_rollup_raw(spark, folder):
    return rollups.fraud_user_rollup(feeds.transactions(spark, folder)).orderBy("user_id")


@query
def fraud_user_rollup_clean(spark, folder):
    return rollups.fraud_user_rollup(trained.clean_transactions(spark, folder)).orderBy("user_id")


@query
def fraud_partial_rollup(spark, folder):
    split = rollups.with_split_id(feeds.transactions(spark, folder), "txn_id", SPLITS)
    return rollups.fraud_partial_rollup(split).withColumns(rounded("total_amount"))


@query
def fraud_merge_partials(spark, folder):
    split = rollups.with_split_id(feeds.transactions(spark, folder), "txn_id", SPLITS)
    return rollups.fraud_merge_partials(rollups.fraud_partial_rollup(split))


@query
def map_reduce_rollup(spark, folder):
    return rollups.fraud_rollup_map_reduce(feeds.transactions(spark, folder))


@query
def array_split_sizes(spark, folder):
    split = rollups.with_split_id(feeds.transactions(spark, folder), "txn_id", SPLITS)
    return split.groupBy("split_id").agg(F.count(F.lit(1)).alias("n"))


@query
def positional_batch_stats(spark, folder):
    batched = rollups.with_batch_number(
        trained.clean_transactions(spark, folder), "txn_id", BATCH_SIZE
    )
    # A group is a user within one batch: at most BATCH_SIZE rows.
    flagged = features.engineer_fraud_features(
        batched, by=("batch_no", "user_id"), hot_rows=None
    )
    flags = F.col("unusual_location") + F.col("high_spend") + F.col("new_device")
    scored = amount_score(flagged).withColumn("score", (F.col("score") + flags) / 4)
    stats = rollups.batch_score_stats(scored, "score")
    return stats.withColumns(rounded("mean_fraud_proba", "max_fraud_proba"))


# --- sources ----------------------------------------------------------------------


@query
def transactions_head(spark, folder):
    head = readers.head_sample(feeds.transactions(spark, folder), ["txn_id"], 5000)
    return micros(head.withColumn("is_fraud", yes_no(F.col("is_fraud"))))


@query
def coerce_numeric(spark, folder):
    events = feeds.table(spark, folder, "events")
    text = F.when(F.col("event_id") % 10 == 0, F.col("event_type")).otherwise(
        F.get_json_object("props", "$.k")
    )
    return events.select("event_id", text.alias("reading")).select(
        "event_id", cleaning.coerce_numeric("reading").alias("reading")
    )


# --- cleaning ---------------------------------------------------------------------


@query
def clean_transactions(spark, folder):
    cleaned = cleaning.clean_transactions(feeds.transactions(spark, folder))
    return micros(cleaned.withColumns(rounded("amount")))


@query
def clean_reviews(spark, folder):
    return cleaning.clean_reviews(feeds.reviews(spark, folder))


@query
def clean_baskets(spark, folder):
    return cleaning.clean_baskets(feeds.order_lines(spark, folder))


@query
def clean_churn(spark, folder):
    return cleaning.clean_churn(feeds.churn_features(spark, folder)).withColumns(
        rounded("monthly_spend", digits=FINE_DIGITS)
    )


@query
def clean_ratings(spark, folder):
    return cleaning.clean_ratings(feeds.ratings(spark, folder))


@query
def user_home_location(spark, folder):
    return cleaning.user_home_location(trained.clean_transactions(spark, folder))


# --- fraud features ---------------------------------------------------------------


@query
def engineer_fraud_features(spark, folder):
    flagged = features.engineer_fraud_features(trained.clean_transactions(spark, folder))
    return flagged.select(
        "txn_id", "user_id", "unusual_location", "high_spend", "new_device", "is_fraud"
    )


@query
def feat_high_spend_asof(spark, folder):
    flagged = features.high_spend_asof(trained.clean_transactions(spark, folder))
    return flagged.withColumns(rounded("spend_limit_asof")).select(
        "txn_id", "user_id", "spend_limit_asof", "high_spend_asof"
    )


@query
def device_occurrence(spark, folder):
    counted = occurrence_index(
        feeds.transactions(spark, folder),
        ["user_id", "device_id"],
        ["timestamp"],
        "txn_id",
        HOT_ROWS,
    )
    return counted.select("txn_id", "user_id", "device_id", F.col("occurrence").cast("long"))


@query
def user_amount_p95(spark, folder):
    amounts = trained.clean_transactions(spark, folder).select("user_id", "amount")
    near = group_order_window(amounts, ["user_id"], "amount", 0.95, HOT_ROWS)
    return group_quantile(near, ["user_id"], 0.95, "p95").withColumns(
        rounded("p95", digits=FINE_DIGITS)
    )


@query
def amount_quantiles(spark, folder):
    tx = feeds.transactions(spark, folder)
    found = exact_quantiles(tx, {"amount": [0.5, 0.95], "location_id": [0.5]})
    rows = [
        ("amount_median", found["amount"][0]),
        ("amount_p95", found["amount"][1]),
        ("location_median", found["location_id"][0]),
    ]
    return spark.createDataFrame(rows, "metric string, value double").withColumns(
        rounded("value", digits=FINE_DIGITS)
    )


# --- dashboard aggregates ---------------------------------------------------------


@query
def fraud_rate_by_decile(spark, folder):
    rates = reporting.rate_by_quantile_bin(
        feeds.transactions(spark, folder), "amount", "is_fraud"
    )
    return rates.withColumns(rounded("rate"))


@query
def hist_amount_by_fraud(spark, folder):
    return reporting.amount_histogram(feeds.transactions(spark, folder))


@query
def hist_polarity(spark, folder):
    return reporting.polarity_histogram(_scored_reviews(spark, folder))


@query
def hist_churn_score(spark, folder):
    users = trained.churn_users(spark, folder)
    score = F.lit(1.0) / (F.lit(1.0) + F.col("sessions_per_month"))
    return reporting.churn_histogram(users.withColumn("score", score), "score")


@query
def threshold_counts(spark, folder):
    scored = amount_score(trained.clean_transactions(spark, folder))
    return reporting.threshold_counts(scored, "score", THRESHOLDS)


@query
def model_threshold_counts(spark, folder):
    """Rows at or above each threshold, for the scores of both models."""
    fraud = trained.fraud_model(spark, folder).score(trained.featured_transactions(spark, folder))
    made = [
        reporting.threshold_counts(scored, name, THRESHOLDS).withColumn("score", F.lit(name))
        for scored, name in (
            (fraud, "fraud_proba"), (trained.anomaly_scores(spark, folder), "anomaly_score")
        )
    ]
    return made[0].unionByName(made[1])


@query
def lake_counts(spark, folder):
    return reporting.lake_counts(
        feeds.transactions(spark, folder),
        feeds.reviews(spark, folder),
        feeds.order_lines(spark, folder),
        feeds.churn_features(spark, folder),
        feeds.ratings(spark, folder),
        trained.itemsets(spark, folder),
        _rules(spark, folder, RULE_CONFIDENCE),
    )


@query
def alert_counts(spark, folder):
    scored = amount_score(trained.clean_transactions(spark, folder))
    return reporting.alert_counts(scored, "score", scored, "score")


@query
def model_alert_counts(spark, folder):
    fraud = trained.fraud_model(spark, folder).score(trained.featured_transactions(spark, folder))
    return reporting.alert_counts(
        fraud, "fraud_proba", trained.anomaly_scores(spark, folder), "anomaly_score"
    )


@query
def lake_manifest(spark, folder):
    names = ["events", "documents", "lineitem", "customer", "orders"]
    return writers.lake_manifest(
        {n: (f"{n}.parquet", "parquet", feeds.table(spark, folder, n)) for n in names}
    )


# --- sentiment --------------------------------------------------------------------


def _scored_reviews(spark, folder):
    return sentiment.score_reviews(cleaning.clean_reviews(feeds.reviews(spark, folder)))


@query
def sentiment_polarity(spark, folder):
    return _scored_reviews(spark, folder).select("review_id", "polarity", "sentiment")


@query
def sentiment_phrases(spark, folder):
    """Polarity by the default lexicon as a table, phrases and scopes included."""
    reviews = cleaning.clean_reviews(feeds.reviews(spark, folder)).select("review_id", "text")
    scored = sentiment.score_with_lexicon(reviews, lexicon.default_lexicon(spark))
    return scored.select("review_id", "polarity", "polarity_phrases", "sentiment")


@query
def sentiment_counts(spark, folder):
    return sentiment.sentiment_counts(_scored_reviews(spark, folder))


@query
def sentiment_report(spark, folder):
    report = sentiment.sentiment_report(_scored_reviews(spark, folder))
    return report.withColumns(rounded("precision", "recall", "f1_score"))


@query
def sentiment_accuracy(spark, folder):
    return sentiment.sentiment_accuracy(_scored_reviews(spark, folder)).withColumns(
        rounded("accuracy")
    )


# --- baskets ----------------------------------------------------------------------


@query
def basket_build(spark, folder):
    lines = cleaning.clean_baskets(feeds.order_lines(spark, folder))
    return baskets.baskets(lines).select("order_id", joined("items"))


@query
def item_support(spark, folder):
    return baskets.item_support(trained.basket_support(spark, folder)).select(
        joined("items"), "freq", rounded("support", digits=FINE_DIGITS)["support"].alias("support")
    )


@query
def pair_itemsets(spark, folder):
    return baskets.pair_itemsets(trained.basket_support(spark, folder)).select(
        joined("items"), "freq", rounded("support", digits=FINE_DIGITS)["support"].alias("support")
    )


@query
def frequent_itemsets(spark, folder):
    return trained.itemsets(spark, folder).select(
        joined("items"), "freq", rounded("support", digits=FINE_DIGITS)["support"].alias("support")
    )


@query
def pair_rules(spark, folder):
    rules = baskets.pair_rules(trained.basket_support(spark, folder))
    return rules.withColumns(rounded("support", "confidence", "lift", digits=FINE_DIGITS))


def _rules(spark, folder, confidence):
    found = baskets.association_rules(
        trained.itemsets(spark, folder),
        trained.basket_support(spark, folder).n_baskets,
        confidence,
    )
    return found.withColumns(
        {c: F.array_join(c, "|") for c in ("antecedents", "consequents")}
    )


@query
def association_rules(spark, folder):
    return _rules(spark, folder, RULE_CONFIDENCE).withColumns(
        rounded("support", "confidence", "lift", "leverage", "conviction", digits=FINE_DIGITS)
    )


@query
def rules_top25_lift(spark, folder):
    rules = _rules(spark, folder, baskets.CONFIDENCE).select(
        "antecedents", "consequents", "support", "confidence", "lift"
    )
    return baskets.rules_by_lift(rules, 25).withColumns(
        rounded("support", "confidence", "lift", digits=FINE_DIGITS)
    )


# --- collaborative filtering ------------------------------------------------------


@query
def cf_matrix(spark, folder):
    ratings = cleaning.clean_ratings(feeds.ratings(spark, folder))
    return collaborative.centred_ratings(ratings).withColumns(rounded("rating", "centred"))


@query
def cf_neighbors(spark, folder):
    return trained.neighbors(spark, folder).withColumns(rounded("sim"))


@query
def cf_recommend(spark, folder):
    return trained.recommendations(spark, folder).withColumns(rounded("score"))


@query
def first_15_users(spark, folder):
    centred = trained.centred(spark, folder)
    users = centred.select("user_id").distinct().orderBy("user_id").limit(15)
    near = collaborative.neighbors(trained.unit(spark, folder), users=users)
    found = collaborative.recommend(near, centred, users=users)
    return found.where(F.col("rank") <= 5).withColumns(rounded("score"))


@query
def own_top_items(spark, folder):
    return collaborative.own_top_items(trained.centred(spark, folder)).withColumns(
        rounded("score")
    )


@query
def cf_als(spark, folder):
    return trained.factor_lists(spark, folder).withColumns(rounded("score"))


@query
def cf_als_check(spark, folder):
    """What holds for any factors: every user has a whole list of products not rated."""
    lists = trained.factor_lists(spark, folder)
    rated = trained.centred(spark, folder).select("user_id", "product_id", F.lit(1).alias("hit"))
    users = lists.join(rated, ["user_id", "product_id"], "left").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.count("hit").alias("hits"), F.max("rank").cast("long").alias("last"),
        F.countDistinct("rank", "product_id").alias("different"),
    )
    return users.groupBy("n", "last", "different").agg(
        F.count(F.lit(1)).alias("users"), F.sum("hits").alias("rated")
    )


# --- evaluation -------------------------------------------------------------------


def _amount_alarm(spark, folder):
    rows = trained.clean_transactions(spark, folder)
    return rows.withColumn("prediction", (F.col("amount") > rollups.HIGH_AMOUNT).cast("int"))


@query
def confusion_matrix(spark, folder):
    return evaluation.confusion_matrix(_amount_alarm(spark, folder), "is_fraud", "prediction")


@query
def classification_report(spark, folder):
    report = evaluation.classification_report(
        _amount_alarm(spark, folder), "is_fraud", "prediction"
    )
    return report.withColumns(rounded("precision", "recall", "f1_score"))


@query
def roc_auc(spark, folder):
    scored = amount_score(trained.clean_transactions(spark, folder))
    return evaluation.roc_auc(scored, "score", "is_fraud").withColumns(rounded("roc_auc"))


@query
def stratified_split_counts(spark, folder):
    part = F.when(models.in_test_part("txn_id", models.FRAUD_SEED), "test").otherwise("train")
    rows = feeds.transactions(spark, folder).select("is_fraud", part.alias("part"))
    return rows.groupBy("is_fraud", "part").agg(F.count(F.lit(1)).alias("n"))


@query
def balanced_weights(spark, folder):
    rows = feeds.transactions(spark, folder)
    train = rows.where(~models.in_test_part("txn_id", models.FRAUD_SEED))
    return models.balanced_weights(train, "is_fraud").withColumns(rounded("weight"))


# --- anomalies on a fixed score ---------------------------------------------------


def _flagged(spark, folder):
    scored = amount_score(trained.featured_transactions(spark, folder))
    return anomaly.flag_outliers(scored, "score")


@query
def outlier_flag(spark, folder):
    return _flagged(spark, folder).select(
        "txn_id", "score", F.col("isolation_forest_outlier").cast("int").alias("outlier")
    )


@query
def anomalies_top500(spark, folder):
    top = anomaly.top_anomalies(_flagged(spark, folder), 500, "score")
    return top.select("txn_id", "user_id", "score", "unusual_location", "high_spend", "is_fraud")


@query
def anomaly_summary(spark, folder):
    summary = anomaly.anomaly_summary(_flagged(spark, folder), "score")
    return summary.withColumns(
        rounded("mean_anomaly_score", "std_anomaly_score", "top_100_overlap_with_labeled_fraud")
    )


# --- what-if ----------------------------------------------------------------------


@query
def whatif_features(spark, folder):
    made = whatif.whatif_features(
        feeds.scenarios(spark, folder), trained.order_summary(spark, folder)
    )
    return micros(made.withColumns(rounded("amount")))


@query
def whatif_without_history(spark, folder):
    return whatif.without_history(
        feeds.scenarios(spark, folder), feeds.transactions(spark, folder)
    ).select("scenario_id", "user_id")


@query
def whatif_score(spark, folder):
    made = whatif.whatif_features(
        feeds.scenarios(spark, folder), trained.order_summary(spark, folder)
    )
    return micros(
        whatif.whatif_score(made, trained.fraud_model(spark, folder), trained.forest(spark, folder))
    )


# --- models -----------------------------------------------------------------------


@query
def fraud_score(spark, folder):
    rows = trained.featured_transactions(spark, folder)
    return micros(trained.fraud_model(spark, folder).score(rows))


@query
def fraud_report(spark, folder):
    return trained.fraud_model(spark, folder).report()


@query
def fraud_baseline_comparison(spark, folder):
    return evaluation.compare_models(
        trained.fraud_model(spark, folder).metrics(),
        trained.fraud_baseline(spark, folder).metrics(),
    )


@query
def churn_score(spark, folder):
    return trained.churn_model(spark, folder).score(trained.churn_users(spark, folder))


@query
def anomaly_score(spark, folder):
    return micros(anomaly.flag_outliers(trained.anomaly_scores(spark, folder)))


def _score_check(scored: DataFrame, key: str, score: str) -> DataFrame:
    """What holds whatever the model learns: a row per key, every score from 0 to 1."""
    return scored.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(key).alias("n_keys"),
        F.count_if(F.col(score).between(0, 1)).alias("n_in_range"),
    )


@query
def fraud_score_check(spark, folder):
    return _score_check(fraud_score(spark, folder), "txn_id", "fraud_proba")


@query
def fraud_report_support(spark, folder):
    """Test rows of each class in the report of the fraud model."""
    report = trained.fraud_model(spark, folder).report().select("class", "support")
    return report.where(~F.col("class").isin("accuracy", "macro avg", "weighted avg"))


@query
def churn_report(spark, folder):
    return trained.churn_model(spark, folder).report()


@query
def churn_score_check(spark, folder):
    return _score_check(churn_score(spark, folder), "user_id", "churn_proba")


@query
def anomaly_score_check(spark, folder):
    return _score_check(trained.anomaly_scores(spark, folder), "txn_id", "anomaly_score")


@query
def whatif_score_check(spark, folder):
    return _score_check(whatif_score(spark, folder), "scenario_id", "fraud_proba")


def _metric_rows(spark, folder) -> dict[str, DataFrame]:
    tx = feeds.transactions(spark, folder)
    reviews = _scored_reviews(spark, folder)
    scored = anomaly.flag_outliers(trained.anomaly_scores(spark, folder))
    n = F.count(F.lit(1))
    rules = _rules(spark, folder, baskets.CONFIDENCE).agg(n.alias("n_rules"))
    itemsets = trained.itemsets(spark, folder).agg(n.alias("n_frequent_itemsets"))
    matrix = trained.centred(spark, folder)
    users = matrix.select("user_id").distinct().agg(n.alias("n_users_in_matrix"))
    products = matrix.select("product_id").distinct().agg(n.alias("n_products_in_matrix"))
    rollup_users = tx.select("user_id").distinct().agg(n)
    return {
        "data_lake": tx.agg(n.alias("transactions_rows")).withColumn(
            "rollup_users", rollup_users.scalar()
        ),
        "fraud_model_clean": trained.fraud_model(spark, folder).metrics(),
        "fraud_model_baseline": trained.fraud_baseline(spark, folder).metrics(),
        "transaction_anomalies": anomaly.anomaly_summary(scored, forest=trained.forest(spark, folder)),
        "sentiment": sentiment.sentiment_accuracy(reviews)
        .withColumnRenamed("n", "n_labelled")
        .withColumn("n_reviews", reviews.agg(n).scalar()),
        "churn": trained.churn_model(spark, folder).metrics(),
        "market_basket": rules.withColumn("n_frequent_itemsets", itemsets.scalar()),
        "collaborative_filtering": users.withColumn("n_products_in_matrix", products.scalar()),
    }


@query
def findings_table(spark, folder):
    return findings.findings_table(_metrics(spark, folder))


def _metrics(spark, folder) -> DataFrame:
    return trained.once(
        spark, folder, "metrics",
        lambda: materialise(findings.metric_table(_metric_rows(spark, folder)), "metrics"),
    )


@query
def findings_check(spark, folder):
    """The counted figures of the findings, and how many sections have a verdict."""
    table = materialise(findings.findings_table(_metrics(spark, folder)), "findings")
    counted = table.where(F.col("metric").isin(*findings.COUNTED)).select(
        "section", "metric", F.col("value").cast("long").alias("value")
    )
    judged = table.where(F.col("finding").isNotNull()).agg(
        F.lit("all").alias("section"), F.lit("verdicts").alias("metric"),
        F.countDistinct("section").alias("value"),
    )
    return counted.unionByName(judged)


# --- streaming --------------------------------------------------------------------


def _stream(spark, folder):
    events = readers.stream_table(spark, f"{folder}/events.parquet", feeds.EVENTS)
    return feeds.transactions_from_events(events)


@query
def stream_event_features(spark, folder):
    made = streams.event_features(_stream(spark, folder), trained.homes(spark, folder))
    return streams.run_available(made, "event-features").select(
        "txn_id", "user_id", "location_id", "unusual_location", "high_spend", "new_device"
    )


@query
def stream_event_score(spark, folder):
    model = trained.fraud_model(spark, folder)
    scored = streams.score_events(_stream(spark, folder), trained.homes(spark, folder), model)
    return streams.run_available(scored, "event-scores")


@query
def stream_batch_scores(spark, folder):
    """Cleaned transactions as a stream of logical batches of BATCH_SIZE rows."""
    path = offsets.folder_of(trained.clean_table(spark, folder))
    stream = offsets.stream_rows(spark, path, feeds.TRANSACTIONS, BATCH_SIZE)
    return streams.score_micro_batches(stream, trained.fraud_model(spark, folder))


@query
def stream_event_score_check(spark, folder):
    return _score_check(stream_event_score(spark, folder), "txn_id", "fraud_proba")


@query
def stream_batch_check(spark, folder):
    """Rows of all micro-batches, the end of the last one, and batches with means out of range."""
    return stream_batch_scores(spark, folder).agg(
        F.sum("batch_size").alias("n_rows"),
        F.max(F.col("batch_start_idx") + F.col("batch_size")).alias("n_positions"),
        F.count_if(~F.col("mean_fraud_proba").between(0, 1)).alias("n_out_of_range"),
    )


@query
def stream_dedup_devices(spark, folder):
    return streams.run_available(streams.first_devices(_stream(spark, folder)), "devices")


@query
def stream_user_recs(spark, folder):
    top = trained.stream_recommendations(spark, folder).where(F.col("rank") <= 6)
    made = streams.user_recommendations(_stream(spark, folder), top)
    return streams.run_available(made, "stream-recs").withColumns(rounded("score"))


@query
def stream_windowed_fraud(spark, folder):
    made = streams.windowed_fraud(_stream(spark, folder))
    table = streams.latest_windows(made).withColumns(rounded("total_amount"))
    return micros(table, "window_start")
