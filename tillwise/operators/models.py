"""Supervised fraud and churn models on MLlib."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.operators.cleaning import coerce_numeric
from tillwise.operators.evaluation import accuracy, classification_report, roc_auc
from tillwise.operators.features import BASELINE_FEATURES, FEATURES, feature_matrix, filled
from tillwise.workspace import materialise

FRAUD_SEED = 42
CHURN_SEED = 7
TEST_SHARE = 0.25
# Training rows are laid out by key in as many partitions as these give.
ROWS_PER_FIT_PARTITION = 25_000
#: Beyond this many partitions they get longer first, up to LONG_FIT_PARTITION rows: every
#: partition sends the statistics of all nodes of a level, however few rows it has.
FIT_PARTITIONS = 24
LONG_FIT_PARTITION = 1_000_000
CHURN_FEATURES = ["tenure_months", "monthly_spend", "sessions_per_month", "support_tickets"]


def split_hash(key: str, seed: int) -> Column:
    """A number in [0, 2^32) from a digest of seed and key; the same in any engine."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def in_test_part(key: str, seed: int, test_share: float = TEST_SHARE) -> Column:
    """Assign a fixed share of every label's rows to the test part.

    The hash knows nothing of the label, so each label is split at the same
    share without a pass over the data.
    """
    return split_hash(key, seed) < int(test_share * 2**32)


def balanced_weights(train: DataFrame, label: str) -> DataFrame:
    """Weight n / (classes x class rows) per label."""
    counts = train.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.agg((F.sum("n") / F.count(F.lit(1))).alias("mean_rows"))
    return counts.select(label, "n", (totals.scalar() / F.col("n")).alias("weight"))


def _weight_column(train: DataFrame, label: str) -> Column:
    # One row per label value of a binary label.
    weights = {r[label]: r["weight"] for r in balanced_weights(train, label).collect()}
    column = F.lit(1.0)
    for value, weight in weights.items():
        column = F.when(F.col(label) == value, F.lit(weight)).otherwise(column)
    return column


@dataclass(frozen=True)
class Classifier:
    """A fitted pipeline with its feature columns and its test-part predictions."""

    model: PipelineModel
    features: list[str]
    out: str
    test: DataFrame | None = None
    label: str | None = None

    def score(self, rows: DataFrame) -> DataFrame:
        """Add the probability of label 1; works on static and streaming frames."""
        ready = rows.withColumns(
            {f"f_{c}": filled(c) for c in self.features}
        )
        scored = self.model.transform(ready)
        return scored.withColumn(self.out, vector_to_array("probability")[1]).select(
            *[c for c in rows.columns if c != self.out], self.out
        )

    def predictions(self) -> DataFrame:
        """Test rows with their score and the 0/1 prediction at one half."""
        return self.score(self.test).withColumn("prediction", (F.col(self.out) > 0.5).cast("int"))

    @cached_property
    def written(self) -> DataFrame:
        """Labels, scores and predictions of the test rows, scored and written once."""
        return materialise(
            self.predictions().select(self.label, self.out, "prediction"), "predictions"
        )

    def accuracy(self) -> DataFrame:
        return accuracy(self.written, self.label, "prediction")

    def roc_auc(self) -> DataFrame:
        return roc_auc(self.written, self.out, self.label)

    def report(self) -> DataFrame:
        return classification_report(self.written, self.label, "prediction")

    def metrics(self) -> DataFrame:
        """One row: roc_auc, accuracy, and n_test, the rows they were taken on."""
        rows = self.accuracy()
        return self.roc_auc().withColumns({
            "accuracy": rows.select("accuracy").scalar(), "n_test": rows.select("n").scalar(),
        })

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/model")
        SparkSession.active().createDataFrame(
            [(self.features, self.out)], "features array<string>, out string"
        ).coalesce(1).write.mode("overwrite").parquet(f"{path}/columns")

    @staticmethod
    def load(path: str) -> Classifier:
        meta = SparkSession.active().read.parquet(f"{path}/columns").first()
        return Classifier(PipelineModel.load(f"{path}/model"), list(meta["features"]), meta["out"])


def fit_partitions(rows: int) -> int:
    """From the number of rows alone, so that no session setting changes the model."""
    few = min(-(-rows // ROWS_PER_FIT_PARTITION), FIT_PARTITIONS)
    return max(1, few, -(-rows // LONG_FIT_PARTITION))


def _fit(
    rows: DataFrame,
    estimator,
    features: Sequence[str],
    label: str,
    key: str,
    seed: int,
    out: str,
    balanced: bool,
    partitions: int | None,
) -> Classifier:
    columns = list(dict.fromkeys([key, *features, label]))
    data = rows.select(*columns)
    test = in_test_part(key, seed)
    partitions = partitions or fit_partitions(data.where(~test).count())
    train = feature_matrix(data.where(~test), features)
    # Row sampling inside the trees follows the partition layout: fixing the
    # layout by key makes the model the same in every run.
    laid_out = train.repartition(partitions, key).sortWithinPartitions(key).cache()
    try:
        weight = _weight_column(laid_out, label) if balanced else F.lit(1.0)
        ready = laid_out.select(
            *[F.col(c).alias(f"f_{c}") for c in features],
            F.col(label).cast("double").alias("label"),
            weight.alias("weight"),
        )
        assembler = VectorAssembler(inputCols=[f"f_{c}" for c in features], outputCol="features")
        fitted = estimator.fit(assembler.transform(ready))
    finally:
        laid_out.unpersist()
    return Classifier(
        PipelineModel(stages=[assembler, fitted]),
        list(features),
        out,
        data.where(test),
        label,
    )


def train_fraud_model(
    rows: DataFrame,
    features: Sequence[str] = FEATURES,
    n_trees: int = 80,
    max_depth: int = 12,
    partitions: int | None = None,
) -> Classifier:
    """Random forest with balanced classes on engineered transactions."""
    forest = RandomForestClassifier(
        numTrees=n_trees,
        maxDepth=max_depth,
        weightCol="weight",
        seed=FRAUD_SEED,
        maxMemoryInMB=1024,
    )
    return _fit(
        rows, forest, features, "is_fraud", "txn_id", FRAUD_SEED, "fraud_proba", True, partitions
    )


def train_fraud_baseline(raw: DataFrame, **options) -> Classifier:
    """The same model on the raw amount alone: no cleaning, no features."""
    rows = raw.withColumn("amount", coerce_numeric("amount"))
    return train_fraud_model(rows, BASELINE_FEATURES, **options)


def train_churn_model(
    users: DataFrame, rounds: int = 100, partitions: int | None = None
) -> Classifier:
    """Gradient boosting on tenure, spend, sessions and tickets."""
    boosted = GBTClassifier(
        maxIter=rounds, maxDepth=3, stepSize=0.1, seed=CHURN_SEED, maxMemoryInMB=1024
    )
    return _fit(
        users, boosted, CHURN_FEATURES, "churned", "user_id", CHURN_SEED, "churn_proba", False, partitions
    )
