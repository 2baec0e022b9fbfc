"""Per-user rollups, including the two-phase and the user-code form."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.functions.ordering import global_row_index
from tillwise.functions.scan import RANGE_ROWS

HIGH_AMOUNT = 500.0


def user_spend(tx: DataFrame) -> DataFrame:
    return tx.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("txn_count"),
        F.sum("amount").alias("total_amount"),
        F.max("amount").alias("max_amount"),
    )


def user_spend_top(tx: DataFrame, n: int = 20) -> DataFrame:
    """The n users with the largest total; ties by user id."""
    return user_spend(tx).orderBy(F.desc("total_amount"), "user_id").limit(n)


def user_spend_partials(tx: DataFrame, split: str) -> DataFrame:
    return tx.groupBy(split, "user_id").agg(
        F.count(F.lit(1)).alias("txn_count"),
        F.sum("amount").alias("total_amount"),
        F.max("amount").alias("max_amount"),
    )


def merge_user_spend(*partials: DataFrame) -> DataFrame:
    """Combine partial aggregates: counts and sums add up, maxima keep the largest."""
    combined = partials[0]
    for part in partials[1:]:
        combined = combined.unionByName(part)
    return combined.groupBy("user_id").agg(
        F.sum("txn_count").alias("txn_count"),
        F.sum("total_amount").alias("total_amount"),
        F.max("max_amount").alias("max_amount"),
    )


def _fraud_stats() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("txn_count"),
        F.coalesce(F.sum("amount"), F.lit(0.0)).alias("total_amount"),
        F.count_if(F.col("location_id").isNull()).alias("rows_missing_location"),
        F.count_if(F.col("amount") > HIGH_AMOUNT).alias("high_amount_txns"),
    ]


def fraud_user_rollup(tx: DataFrame) -> DataFrame:
    return (
        tx.groupBy("user_id")
        .agg(*_fraud_stats())
        .withColumn("total_amount", F.round("total_amount", 2))
    )


def fraud_partial_rollup(tx: DataFrame, split: str = "split_id") -> DataFrame:
    return tx.groupBy(split, "user_id").agg(*_fraud_stats())


def fraud_merge_partials(partials: DataFrame) -> DataFrame:
    merged = partials.groupBy("user_id").agg(
        *[
            F.sum(c).alias(c)
            for c in ("txn_count", "total_amount", "rows_missing_location", "high_amount_txns")
        ]
    )
    return merged.withColumn("total_amount", F.round("total_amount", 2))


def with_batch_number(
    df: DataFrame, key: str, batch_size: int, rows_per_bin: int = RANGE_ROWS
) -> DataFrame:
    """Consecutive batches of ``batch_size`` rows in key order."""
    indexed, _ = global_row_index(df, key, rows_per_bin)
    return indexed.withColumn("batch_no", F.floor(F.col("row_index") / batch_size))


def with_split_id(
    df: DataFrame, key: str, n_splits: int, rows_per_bin: int = RANGE_ROWS
) -> DataFrame:
    """``n_splits`` near-equal contiguous splits; the first ones hold the extra rows."""
    indexed, total = global_row_index(df, key, rows_per_bin)
    size, extra = divmod(total, n_splits)
    position = F.col("row_index")
    boundary = extra * (size + 1)
    tail = F.lit(extra) + F.floor((position - boundary) / max(size, 1))
    split = F.when(position < boundary, F.floor(position / (size + 1))).otherwise(tail)
    return indexed.withColumn("split_id", split.cast("int")).drop("row_index")


def batch_score_stats(scored: DataFrame, score: str) -> DataFrame:
    """Start row, size, mean and maximum score of each batch."""
    return scored.groupBy("batch_no").agg(
        F.min("row_index").alias("batch_start_idx"),
        F.count(F.lit(1)).alias("batch_size"),
        F.avg(score).alias("mean_fraud_proba"),
        F.max(score).alias("max_fraud_proba"),
    )


def map_reduce(
    df: DataFrame,
    mapper: Callable[[pd.DataFrame], pd.DataFrame],
    combiner: Callable[[pd.DataFrame], pd.DataFrame],
    reducer: Callable[[pd.DataFrame], pd.DataFrame],
    key: str,
    pair_schema: T.StructType | str,
    result_schema: T.StructType | str,
    fan_in: int = 32,
) -> DataFrame:
    """User-code aggregation: map chunks, combine partials, reduce per key.

    ``mapper`` turns a chunk into keyed partial rows. ``combiner`` merges partial
    rows into fewer of the same schema and must be associative. ``reducer`` gets
    the remaining partials of one key. Partials are merged within every input
    partition and then within ``fan_in`` salted groups per key, so the reducer
    meets at most ``fan_in`` rows of a key however many rows the key had.
    """

    def merge(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        rows, limit = 0, 100_000
        for part in parts:
            held.append(part)
            rows += len(part)
            if rows > limit:
                held = [combiner(pd.concat(held))]
                rows = len(held[0])
                limit = max(limit, 2 * rows)
        if held:
            yield combiner(pd.concat(held))

    def map_partition(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from merge(mapper(chunk) for chunk in chunks)

    def combine_partition(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from merge(chunk.drop(columns="salt") for chunk in chunks)

    partials = df.mapInPandas(map_partition, pair_schema)
    salted = partials.withColumn("salt", F.spark_partition_id() % fan_in)
    return (
        salted.repartition(key, "salt")
        .mapInPandas(combine_partition, pair_schema)
        .groupBy(key)
        .applyInPandas(reducer, result_schema)
    )


FRAUD_PAIR_SCHEMA = (
    "user_id long, txn_count long, total_amount double, "
    "rows_missing_location long, high_amount_txns long"
)


def _sum_by_user(partials: pd.DataFrame) -> pd.DataFrame:
    return partials.groupby("user_id", as_index=False).sum()


def fraud_map_chunk(chunk: pd.DataFrame) -> pd.DataFrame:
    keyed = pd.DataFrame(
        {
            "user_id": chunk["user_id"],
            "txn_count": 1,
            "total_amount": chunk["amount"].fillna(0.0),
            "rows_missing_location": chunk["location_id"].isna().astype("int64"),
            "high_amount_txns": (chunk["amount"] > HIGH_AMOUNT).astype("int64"),
        }
    )
    return _sum_by_user(keyed)


def fraud_reduce_user(partials: pd.DataFrame) -> pd.DataFrame:
    merged = _sum_by_user(partials)
    merged["total_amount"] = merged["total_amount"].round(2)
    return merged


def fraud_rollup_map_reduce(tx: DataFrame) -> DataFrame:
    """The per-user rollup written as user code for :func:`map_reduce`."""
    return map_reduce(
        tx.select("user_id", "amount", "location_id"),
        fraud_map_chunk,
        _sum_by_user,
        fraud_reduce_user,
        "user_id",
        FRAUD_PAIR_SCHEMA,
        FRAUD_PAIR_SCHEMA,
    )
