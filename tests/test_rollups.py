import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwise.operators import rollups

ROWS = [(1, 100.0, 1, 1), (1, 200.0, 1, 1), (2, 50.0, None, 2), (2, 501.0, 3, 2), (3, 500.0, 1, 1)]
EXPECTED = [(1, 2, 300.0, 0, 0), (2, 2, 551.0, 1, 1), (3, 1, 500.0, 0, 0)]
COLUMNS = ["user_id", "txn_count", "total_amount", "rows_missing_location", "high_amount_txns"]


def table(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def test_reducer_sums_partials(spark):
    partials = spark.createDataFrame(
        [(1, 2, 10.0, 0, 1), (1, 1, 5.0, 1, 0)], rollups.FRAUD_PAIR_SCHEMA
    )
    assert table(rollups.fraud_merge_partials(partials)) == [(1, 3, 15.0, 1, 1)]


def test_rollup_forms_agree(make_tx):
    tx = make_tx(ROWS)
    split = rollups.with_split_id(tx, "txn_id", 2)
    assert table(rollups.fraud_user_rollup(tx)) == EXPECTED
    assert table(rollups.fraud_merge_partials(rollups.fraud_partial_rollup(split))) == EXPECTED
    assert table(rollups.fraud_rollup_map_reduce(tx.repartition(3))) == EXPECTED


def test_map_reduce_bounds_the_reducers_input(spark):
    """One key holds most rows; the reducer still meets at most fan_in partials."""
    df = spark.range(1, 20_001).select(
        F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id")).alias("key"), F.lit(1).alias("n")
    ).repartition(16)

    def total(part):
        return part.groupby("key", as_index=False)["n"].sum()

    def reduce(part):
        out = total(part)
        out["partials"] = len(part)
        return out

    made = rollups.map_reduce(
        df, total, total, reduce, "key", "key long, n long", "key long, n long, partials long",
        fan_in=4,
    )
    rows = {r.key: r for r in made.collect()}
    assert rows[0].n == 20_000 - 20_000 // 3 and rows[0].partials <= 4
    assert sum(r.n for r in rows.values()) == 20_000


def test_spend_merge_and_top(make_tx):
    tx = make_tx(ROWS)
    one = rollups.user_spend_partials(tx.where("txn_id < 3").withColumn("s", F.lit(0)), "s")
    two = rollups.user_spend_partials(tx.where("txn_id >= 3").withColumn("s", F.lit(1)), "s")
    merged = rollups.merge_user_spend(one, two)
    assert sorted(map(tuple, merged.collect())) == [
        (1, 2, 300.0, 200.0), (2, 2, 551.0, 501.0), (3, 1, 500.0, 500.0)
    ]
    assert [r.user_id for r in rollups.user_spend_top(tx, 2).collect()] == [2, 3]


@pytest.mark.parametrize("n, k", [(10, 3), (16, 16), (5, 8), (103, 16)])
@pytest.mark.parametrize("rows_per_bin", [6, 1000])
def test_array_split(spark, n, k, rows_per_bin):
    df = spark.range(n).withColumnRenamed("id", "key")
    got = rollups.with_split_id(df, "key", k, rows_per_bin).orderBy("key").collect()
    want = [i for i, part in enumerate(np.array_split(np.arange(n), k)) for _ in part]
    assert [r.split_id for r in got] == want


def test_batches(spark):
    df = spark.range(10).select(F.col("id").alias("key"), F.col("id").cast("double").alias("s"))
    batched = rollups.with_batch_number(df, "key", 4, rows_per_bin=3)
    stats = rollups.batch_score_stats(batched, "s").orderBy("batch_no")
    assert [tuple(r) for r in stats.collect()] == [
        (0, 0, 4, 1.5, 3.0), (1, 4, 4, 5.5, 7.0), (2, 8, 2, 8.5, 9.0)
    ]
