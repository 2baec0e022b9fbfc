import numpy as np
import pytest
from pyspark.sql import functions as F

from sample_data import SMALL
from tillwise.operators import anomaly, evaluation, models
from tillwise.plans import trained
from tillwise.workspace import fresh_path


@pytest.fixture(scope="module")
def featured(spark):
    return trained.featured_transactions(spark, SMALL)


@pytest.fixture(scope="module")
def forest(featured):
    return anomaly.fit_forest(featured, n_trees=40)


def scores(df, name):
    return [r[name] for r in df.orderBy("txn_id").collect()]


def test_forest_does_not_depend_on_row_order(featured, forest):
    again = anomaly.fit_forest(featured.orderBy(F.desc("amount")).repartition(7), n_trees=40)
    key = ["tree", "node"]
    assert forest.nodes.orderBy(*key).collect() == again.nodes.orderBy(*key).collect()


def test_anomaly_scores(featured, forest):
    scored = anomaly.flag_outliers(anomaly.anomaly_score(featured, forest))
    values = np.array(scores(scored, "anomaly_score"))
    assert ((values > 0) & (values < 1)).all()
    flagged = np.array(scores(scored, "isolation_forest_outlier"))
    assert (flagged == (values > np.quantile(values, 0.97))).all()
    # Rows far out on every feature score higher than the bulk.
    far = scored.where("amount > 500 and unusual_location = 1").agg(F.avg("anomaly_score")).first()[0]
    assert far > values.mean() + values.std()
    summary = anomaly.anomaly_summary(scored).first()
    assert summary.n_rows == len(values)
    assert summary.std_anomaly_score == pytest.approx(values.std())
    few = anomaly.anomaly_summary(scored.limit(99)).first()
    assert few.top_100_overlap_with_labeled_fraud is None
    top = anomaly.top_anomalies(scored, 10).collect()
    assert [r.anomaly_score for r in top] == sorted(values, reverse=True)[:10]


def test_trees_draw_rows_in_generated_code(spark):
    rows = spark.range(400).select(F.col("id").alias("txn_id"), (F.col("id") % 7).cast("double").alias("amount"))
    drawn = anomaly._drawn(rows, "txn_id", ["amount"], 9, 42, -(2**62))
    hashes = rows.crossJoin(spark.range(9).select(F.col("id").cast("int").alias("tree"))).select(
        "tree", F.xxhash64("txn_id", "tree", F.lit(42)).alias("draw"), "txn_id", "amount")
    want = [tuple(r) for r in hashes.collect() if r.draw <= -(2**62)]
    assert sorted(map(tuple, drawn.collect())) == sorted(want) and want
    plan = drawn._jdf.queryExecution().toString()
    assert "lambda" not in plan and plan.count("ArrayTransform") == 0


def test_forest_shape(forest):
    rows = forest.nodes.toPandas()
    assert rows["depth"].max() <= 8
    assert (rows[rows.node == 0]["size"] == 256).all() and rows.tree.nunique() == 40
    leaves = rows[rows.feature < 0].groupby("tree")["size"].sum()
    assert (leaves == 256).all()


def test_forest_on_few_rows(featured):
    small = featured.limit(20)
    forest = anomaly.fit_forest(small, n_trees=5)
    assert forest.sample_size == 20
    assert anomaly.anomaly_score(small, forest).where("anomaly_score is null").count() == 0


def test_forest_save_and_load(spark, featured, forest):
    path = fresh_path(spark, "forest")
    forest.save(path)
    again = anomaly.Forest.load(spark, path)
    assert scores(anomaly.anomaly_score(featured, again), "anomaly_score") == scores(
        anomaly.anomaly_score(featured, forest), "anomaly_score"
    )


def test_average_path():
    assert list(anomaly.average_path(np.array([0, 1, 2]))) == [0.0, 0.0, 1.0]
    assert float(anomaly.average_path(np.array(256))) == pytest.approx(10.2447, abs=1e-3)


def test_split_is_disjoint_and_near_its_share(featured):
    by_label = (
        featured.groupBy("is_fraud")
        .agg(F.avg(models.in_test_part("txn_id", 42).cast("int")).alias("share"))
        .collect()
    )
    assert len(by_label) == 2 and all(0.15 < r.share < 0.35 for r in by_label)


def test_balanced_weights(spark):
    df = spark.createDataFrame([(0,)] * 9 + [(1,)] * 1, "y int")
    got = {r.y: r.weight for r in models.balanced_weights(df, "y").collect()}
    assert got == {0: pytest.approx(10 / 18), 1: pytest.approx(5.0)}


def test_fraud_model_is_repeatable_and_survives_saving(spark, featured):
    make = lambda rows: models.train_fraud_model(rows, n_trees=10, max_depth=6)
    model = make(featured)
    probabilities = scores(model.score(featured), "fraud_proba")
    assert all(0 <= p <= 1 for p in probabilities)
    assert probabilities == scores(make(featured.repartition(9)).score(featured), "fraud_proba")
    path = fresh_path(spark, "model")
    model.save(path)
    assert scores(models.Classifier.load(path).score(featured), "fraud_proba") == probabilities
    assert model.metrics().first().roc_auc > 0.6
    assert model.report().count() == 5


def test_full_model_beats_amount_only_baseline(spark):
    folder = SMALL.replace("0.001", "0.1")
    full = trained.fraud_model(spark, folder).metrics()
    base = trained.fraud_baseline(spark, folder).metrics()
    assert evaluation.compare_models(full, base).first().finding == evaluation.FINDING_HIGHER


def test_fit_partitions_grow_slower_than_rows(featured, monkeypatch):
    """Every partition sends the statistics of all nodes, so many rows must not mean many partitions."""
    assert [models.fit_partitions(n) for n in (0, 75_000, 600_000, 5_000_000)] == [1, 3, 24, 24]
    assert models.fit_partitions(30_000_000) == 30

    class Stop(Exception):
        pass

    class Estimator:
        def fit(self, ready):
            raise Stop(ready.rdd.getNumPartitions())

    monkeypatch.setattr(models, "RandomForestClassifier", lambda **options: Estimator())
    monkeypatch.setattr(models, "ROWS_PER_FIT_PARTITION", 5)
    with pytest.raises(Stop) as stopped:
        models.train_fraud_model(featured)
    assert stopped.value.args[0] <= models.FIT_PARTITIONS


def test_churn_scores(spark):
    users = trained.churn_users(spark, SMALL.replace("0.001", "0.01"))
    model = models.train_churn_model(users, rounds=5)
    low, high = model.score(users).agg(F.min("churn_proba"), F.max("churn_proba")).first()
    assert 0 <= low < high <= 1
    assert model.metrics().first().roc_auc > 0.5
