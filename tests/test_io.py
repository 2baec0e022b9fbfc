from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sample_data import SMALL
from tillwise import workspace
from tillwise.plans import batch_run
from tillwise.sources import feeds, readers, writers
from tillwise.workspace import fresh_path


@pytest.fixture(scope="module")
def lake(spark):
    path = fresh_path(spark, "lake")
    frames = {
        "transactions": feeds.transactions(spark, SMALL),
        "reviews": feeds.reviews(spark, SMALL),
        "order_line_items": feeds.order_lines(spark, SMALL),
        "user_churn_features": feeds.churn_features(spark, SMALL),
        "user_product_ratings": feeds.ratings(spark, SMALL),
    }
    return path, frames, writers.write_lake(frames, path)


def test_lake_round_trip(spark, lake):
    path, frames, manifest = lake
    listed = {r.name: r.n_rows for r in manifest.collect()}
    read = batch_run.read_lake(spark, path)
    for name, frame in frames.items():
        assert read[name].schema.simpleString() == frame.schema.simpleString()
        assert listed[name] == read[name].count() == frame.count()
    for name in ("transactions", "user_churn_features", "user_product_ratings"):
        assert read[name].exceptAll(frames[name]).count() == 0


def test_csv_fields_that_do_not_parse_become_null(spark):
    path = fresh_path(spark, "csv")
    spark.createDataFrame([("1", "x"), ("2", "3.5")], "a string, b string").coalesce(1).write.option(
        "header", True
    ).csv(path)
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.DoubleType())])
    assert [tuple(r) for r in readers.read_csv(spark, path, schema).orderBy("a").collect()] == [
        (1, None), (2, 3.5)
    ]


def test_csv_files_with_headers_of_their_own(spark):
    path = fresh_path(spark, "csv")
    for lines in (["a,b", "1,10"], ["b,a", "20,2"], ["b", "30"]):
        frame = spark.createDataFrame([(x,) for x in lines], "v string")
        frame.coalesce(1).write.mode("append").text(path)
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.DoubleType())])
    got = readers.read_csv(spark, path, schema).orderBy("b").collect()
    assert [tuple(r) for r in got] == [(1, 10.0), (2, 20.0), (None, 30.0)]


def test_csv_as_other_tools_write_it(spark):
    """No key column, another column order, whole numbers as 12.0, NaN for missing."""
    path = fresh_path(spark, "csv")
    lines = [
        "amount,user_id,location_id,device_id,timestamp,is_fraud",
        "10.5,1,12.0,7,2024-01-01 00:00:00,0",
        "NaN,2,,8,2024-01-01 00:00:01.250000,1",
    ]
    spark.createDataFrame([(x,) for x in lines], "v string").coalesce(1).write.text(path)
    rows = readers.read_csv(spark, path, feeds.TRANSACTIONS, key="txn_id").orderBy("txn_id").collect()
    assert [tuple(r) for r in rows] == [
        (0, 1, 10.5, 12, 7, datetime(2024, 1, 1), 0),
        (1, 2, None, None, 8, datetime(2024, 1, 1, 0, 0, 1, 250000), 1),
    ]


def test_nan_is_missing(spark):
    df = readers.nan_as_null(spark.createDataFrame([(float("nan"),), (1.0,)], "v double"))
    assert df.where("v is null").count() == 1


@pytest.mark.parametrize("source", ["parquet", "csv", "json"])
def test_missing_file_is_an_empty_table(spark, source):
    df = readers.read_or_empty(spark, fresh_path(spark, "none"), feeds.RATINGS, source)
    assert df.count() == 0 and df.schema == feeds.RATINGS


def test_empty_result_keeps_its_schema(spark):
    path = fresh_path(spark, "empty")
    writers.write_table(spark.createDataFrame([], "items array<string>, support double"), path)
    assert readers.read_table(spark, path).columns == ["items", "support"]


def test_partitioned_lake_prunes_days(spark):
    path = fresh_path(spark, "days")
    tx = feeds.transactions(spark, SMALL)
    writers.write_partitioned(tx, path)
    back = spark.read.parquet(path)
    assert back.count() == tx.count()
    day = back.where("year = 2024 and month = 1 and day = 1")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert day.count() == tx.where("to_date(timestamp) = '2024-01-01'").count()


def test_recent_runs_and_history(spark):
    path = fresh_path(spark, "history")
    for i in range(10):
        spark.createDataFrame(
            [(datetime(2024, 1, 1 + i), 0.1 * i, 0.2, 0.3)], writers.HISTORY_SCHEMA
        ).write.mode("append").parquet(path)
    got = readers.recent_runs(readers.read_table(spark, path)).collect()
    assert [r.at.day for r in got] == [10, 9, 8, 7, 6, 5, 4, 3]


def test_json_summary(spark):
    path = fresh_path(spark, "summary")
    writers.write_json_summary(spark.range(2), path)
    assert {r.engine for r in spark.read.json(path).collect()} == {"spark"}


def test_shared_dir_comes_from_the_session(spark):
    assert workspace.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_no_local_folder_on_a_cluster():
    class Conf:
        def get(self, name, default=None):
            return "yarn" if name == "spark.master" else default

    class Session:
        conf = Conf()

    with pytest.raises(RuntimeError):
        workspace.shared_dir(Session())


def test_whole_run(spark, lake):
    out = fresh_path(spark, "run")
    options = batch_run.RunOptions(mode="quick", fraud_trees=5, churn_rounds=2, n_trees=10)
    for _ in range(2):
        run_id = batch_run.run(spark, lake[0], out, options)
    tables = [
        "fraud_scored_transactions", "transaction_anomaly_scores", "transaction_anomalies_top500",
        "fraud_user_rollups", "sentiment_reviews", "frequent_itemsets", "association_rules",
        "churn_scores", "recommendations", "streaming_fraud_batches", "streaming_fraud_events",
        "streaming_recommendations", "findings",
    ]
    for name in tables:
        assert readers.read_table(spark, f"{out}/{name}").count() > 0, name
    assert readers.read_table(spark, f"{out}/transaction_anomalies_top500").count() == 500
    history = readers.read_table(spark, f"{out}/metrics_history")
    assert history.count() == 2 and history.where("churn_roc_auc is null").count() == 0
    assert readers.read_table(spark, f"{out}/run_manifest").where(F.col("run_id") == run_id).count() == 1
    metrics = readers.read_table(spark, f"{out}/metrics").where(F.col("run_id") == run_id)
    figures = {(r.section, r.metric): r.value for r in metrics.collect()}
    assert figures["data_lake", "transactions_rows"] == 1000
    printed = {(r.section, r.metric): r.printed for r in readers.read_table(spark, f"{out}/findings").collect()}
    assert printed["data_lake", "transactions_rows"] == "1000"
    batches = readers.read_table(spark, f"{out}/streaming_fraud_batches").orderBy("batch_no").collect()
    assert [b.batch_start_idx for b in batches] == [0, *[
        sum(x.batch_size for x in batches[: i + 1]) for i in range(len(batches) - 1)
    ]]
