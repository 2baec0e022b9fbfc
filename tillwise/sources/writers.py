"""Writing result tables, summaries and run records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

METRICS_SCHEMA = "run_id string, section string, metric string, value double"
HISTORY_SCHEMA = (
    "at timestamp, fraud_roc_auc_full double, fraud_roc_auc_baseline double, churn_roc_auc double"
)


def write_table(df: DataFrame, path: str) -> None:
    """Replace a table; an empty result still leaves a readable schema."""
    df.write.mode("overwrite").parquet(path)


def write_json_summary(df: DataFrame, path: str, engine: str = "spark") -> None:
    df.withColumn("engine", F.lit(engine)).write.mode("overwrite").json(path)


def write_partitioned(tx: DataFrame, path: str, time: str = "timestamp") -> None:
    """Day-partitioned lake. Rows of a day are spread over several writers by key."""
    dated = tx.withColumns(
        {
            "year": F.year(time),
            "month": F.month(time),
            "day": F.dayofmonth(time),
        }
    )
    # The rebalance hint lets the engine split a large day and merge small ones.
    dated.hint("rebalance", "year", "month", "day").write.mode("overwrite").partitionBy(
        "year", "month", "day"
    ).parquet(path)


def lake_manifest(tables: dict[str, tuple[str, str, DataFrame]]) -> DataFrame:
    """One row per dataset: name, path, format, rows. Input: name -> (path, format, frame)."""
    out = None
    for name, (path, fmt, frame) in tables.items():
        line = frame.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("name"),
            F.lit(path).alias("path"),
            F.lit(fmt).alias("format"),
            "n_rows",
        )
        out = line if out is None else out.unionByName(line)
    return out


def write_metrics(metrics: DataFrame, run_id: str, path: str) -> None:
    """Long table (run_id, section, metric, value), one append per run."""
    metrics.select(F.lit(run_id).alias("run_id"), "section", "metric", "value").write.mode(
        "append"
    ).parquet(path)


def append_run_manifest(spark: SparkSession, path: str, run_id: str, mode: str) -> None:
    spark.range(1).select(
        F.lit(run_id).alias("run_id"),
        F.current_timestamp().alias("generated_at_utc"),
        F.lit(mode).alias("run_mode"),
        F.lit(mode == "quick").alias("quick_mode"),
    ).write.mode("append").parquet(path)


def append_history(metrics: DataFrame, path: str) -> None:
    """Append the run's three AUC figures from the long metric table."""

    def figure(section: str) -> Column:
        wanted = (F.col("section") == section) & (F.col("metric") == "roc_auc")
        return F.max(F.when(wanted, F.col("value")))

    metrics.agg(
        figure("fraud_model_clean").alias("fraud_roc_auc_full"),
        figure("fraud_model_baseline").alias("fraud_roc_auc_baseline"),
        figure("churn").alias("churn_roc_auc"),
    ).select(F.current_timestamp().alias("at"), "*").write.mode("append").parquet(path)


MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
# File format per feed of the lake.
LAKE_FORMATS = {
    "transactions": "csv",
    "reviews": "json",
    "order_line_items": "csv",
    "user_churn_features": "csv",
    "user_product_ratings": "csv",
}


def write_lake(frames: dict[str, DataFrame], path: str) -> DataFrame:
    """Write the feeds as headered CSV and JSON lines; returns the lake's manifest."""
    for name, frame in frames.items():
        # Text formats keep milliseconds by default; events are ordered by microseconds.
        frame.write.mode("overwrite").format(LAKE_FORMATS[name]).options(
            header=True, timestampNTZFormat=MICROS
        ).save(f"{path}/{name}")
    tables = {n: (f"{path}/{n}", LAKE_FORMATS[n], frame) for n, frame in frames.items()}
    return lake_manifest(tables)
