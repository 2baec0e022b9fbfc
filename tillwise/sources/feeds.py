"""Schemas of the five retail feeds and the views that derive them from the base tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TRANSACTIONS = T.StructType(
    [
        T.StructField("txn_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("location_id", T.LongType()),
        T.StructField("device_id", T.LongType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("is_fraud", T.IntegerType()),
    ]
)
REVIEWS = T.StructType(
    [
        T.StructField("review_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("true_sentiment", T.StringType()),
    ]
)
ORDER_LINES = T.StructType(
    [
        T.StructField("order_id", T.LongType()),
        T.StructField("product_id", T.StringType()),
    ]
)
CHURN = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("tenure_months", T.IntegerType()),
        T.StructField("monthly_spend", T.DoubleType()),
        T.StructField("sessions_per_month", T.LongType()),
        T.StructField("support_tickets", T.LongType()),
        T.StructField("churned", T.IntegerType()),
    ]
)
RATINGS = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("rating", T.DoubleType()),
    ]
)
SCENARIOS = T.StructType(
    [
        T.StructField("scenario_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("location_id", T.LongType()),
        T.StructField("device_id", T.LongType()),
    ]
)
EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)

# Phrase appended to a review's text, picked by doc_id % 5.
REVIEW_PHRASES = [
    "great quality and very fast",
    "not good at all",
    "terrible and broken",
    "it is okay",
    "never bad, always excellent",
]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def transactions_from_events(events: DataFrame) -> DataFrame:
    """Works on a static or a streaming events frame."""
    k = F.col("k")
    with_k = events.select(
        "event_id",
        "user_id",
        "value",
        "ts",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )
    away = k % 8 == 0
    amount = (
        F.when(F.col("event_id") % 500 == 3, F.lit(0.0))
        .when(F.col("event_id") % 100 == 7, -F.col("value") * 4)
        .otherwise(F.col("value") * 4)
    )
    location = F.when(F.col("event_id") % 50 != 11, F.when(away, k.cast("long") + 100).otherwise(F.col("user_id") % 20))
    fraud = (
        (away & (F.col("value") > 60))
        | ((F.col("value") > 120) & (F.col("event_id") % 3 == 0))
        | (F.col("event_id") % 41 == 0)
    )
    return with_k.select(
        F.col("event_id").alias("txn_id"),
        "user_id",
        amount.alias("amount"),
        location.alias("location_id"),
        (F.col("user_id") * 10 + k % 6).alias("device_id"),
        F.col("ts").alias("timestamp"),
        F.when(fraud, 1).otherwise(0).alias("is_fraud"),
    )


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    return transactions_from_events(table(spark, folder, "events"))


def _phrase(doc_id: Column) -> Column:
    return F.element_at(
        F.array(*[F.lit(p) for p in REVIEW_PHRASES]), (doc_id % 5 + 1).cast("int")
    )


def reviews(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").select("doc_id", "quality", "toxic")
    doc = F.col("doc_id")
    text = (
        F.when(doc % 67 == 5, F.lit(None).cast("string"))
        .when(doc % 50 == 9, F.concat(_phrase(doc), F.lit(" ###CORRUPT###")))
        .when(doc % 71 == 2, F.lit(" ###CORRUPT### "))
        .otherwise(F.concat(F.col("text"), F.lit(" "), _phrase(doc)))
    )
    sentiment = (
        F.when(F.col("toxic") == 1, "negative")
        .when(F.col("quality") == 1, "positive")
        .when(F.col("quality") == 0, "neutral")
    )
    return docs.join(labels, "doc_id", "left").select(
        doc.alias("review_id"),
        (doc % 97).alias("user_id"),
        (doc % 50).alias("product_id"),
        text.alias("text"),
        sentiment.alias("true_sentiment"),
    )


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    parts = table(spark, folder, "part").select("p_partkey", "p_type", "p_size")
    mark = F.col("l_orderkey") + F.col("l_linenumber")
    half = (F.col("p_size") % 2).cast("string")
    product = (
        F.when(mark % 200 == 0, F.lit(None).cast("string"))
        .when(
            mark % 97 == 0,
            F.concat(F.lit("  "), F.lower("p_type"), F.lit("-"), half, F.lit(" ")),
        )
        .when(mark % 193 == 0, F.lit("   "))
        .otherwise(F.concat(F.col("p_type"), F.lit("-"), half))
    )
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("order_id"), product.alias("product_id")
    )


def churn_features(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer").select("c_custkey")
    orders = table(spark, folder, "orders").select(
        "o_custkey", "o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    # Orders are summarised before the join, so a customer with very many
    # orders reaches the join as one row.
    per_customer = orders.groupBy("o_custkey").agg(
        F.min(F.year("o_orderdate") * 12 + F.month("o_orderdate")).alias("first_month"),
        F.max("o_totalprice").alias("largest"),
        F.count("o_orderkey").alias("n_orders"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("urgent"),
        F.max("o_orderdate").alias("last_order"),
    )
    active = F.col("last_order") >= F.lit("2001-02-01 00:00:00").cast("timestamp_ntz")
    return customers.join(per_customer, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        F.col("c_custkey").alias("user_id"),
        F.coalesce(F.lit(2001 * 12 + 8) - F.col("first_month"), F.lit(0))
        .cast("int")
        .alias("tenure_months"),
        F.when(F.col("c_custkey") % 33 != 0, F.col("largest") / 1000).alias("monthly_spend"),
        F.coalesce("n_orders", F.lit(0)).cast("long").alias("sessions_per_month"),
        F.coalesce("urgent", F.lit(0)).cast("long").alias("support_tickets"),
        F.when(active, 0).otherwise(1).alias("churned"),
    )


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity"
    )
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    rating = F.when(
        (F.col("l_orderkey") + F.col("l_linenumber")) % 50 != 0, F.col("l_quantity") / 8.0
    )
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("product_id"),
        rating.alias("rating"),
    )


def scenarios(spark: SparkSession, folder: str) -> DataFrame:
    """One hypothetical transaction per order; some of them for users without history."""
    user = F.col("o_custkey") % 200
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("scenario_id"),
        user.alias("user_id"),
        (F.col("o_totalprice") / 500).alias("amount"),
        F.when(F.col("o_orderkey") % 3 == 0, user % 20)
        .otherwise(F.col("o_orderkey") % 25)
        .alias("location_id"),
        (user * 10 + F.col("o_orderkey") % 9).alias("device_id"),
    )
