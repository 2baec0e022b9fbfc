"""Isolation forest: hash-sampled trees, vectorised scoring, summaries."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwise.functions.ordering import exact_quantiles
from tillwise.operators.features import FEATURES, existing_columns, feature_matrix

N_TREES = 120
SAMPLE_SIZE = 256
CONTAMINATION = 0.03
SEED = 42
# Rows drawn per tree before the cut to the sample size; half as many again
# makes a shortfall practically impossible.
_OVERDRAW = 1.5
_NODE_SCHEMA = (
    "tree int, node int, feature int, threshold double, left int, right int, "
    "depth int, size long"
)
SCORE_COLUMNS = [
    "txn_id",
    "user_id",
    "amount",
    "location_id",
    "device_id",
    "timestamp",
    "unusual_location",
    "high_spend",
    "new_device",
    "anomaly_score",
    "isolation_forest_outlier",
    "is_fraud",
]


def average_path(n: np.ndarray) -> np.ndarray:
    """Mean depth of an unsuccessful search in a binary tree of n rows."""
    n = np.asarray(n, dtype=float)
    harmonic = np.log(np.maximum(n - 1, 1)) + 0.5772156649015329
    return np.where(n > 2, 2 * harmonic - 2 * (n - 1) / np.maximum(n, 1), (n == 2).astype(float))


@dataclass(frozen=True)
class Forest:
    """A fitted forest; its node table has at most trees x (2 x sample - 1) rows."""

    nodes: DataFrame
    features: list[str]
    sample_size: int
    contamination: float
    n_trees: int

    def save(self, path: str) -> None:
        meta = [(self.features, self.sample_size, self.contamination, self.n_trees)]
        self.nodes.write.mode("overwrite").parquet(f"{path}/nodes")
        self.nodes.sparkSession.createDataFrame(
            meta, "features array<string>, sample_size int, contamination double, n_trees int"
        ).coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Forest:
        meta = spark.read.parquet(f"{path}/meta").first()
        return Forest(
            spark.read.parquet(f"{path}/nodes"),
            list(meta["features"]),
            meta["sample_size"],
            meta["contamination"],
            meta["n_trees"],
        )


def fit_forest(
    rows: DataFrame,
    key: str = "txn_id",
    features: Sequence[str] = FEATURES,
    n_trees: int = N_TREES,
    contamination: float = CONTAMINATION,
    seed: int = SEED,
    sample_size: int = SAMPLE_SIZE,
) -> Forest:
    """Fit on a per-tree sample chosen by a hash of the key.

    The draw is one narrow pass: whatever the number of rows, about
    ``n_trees * sample_size * 1.5`` of them are shuffled. Labels are not used.
    """
    features = list(features)
    data = feature_matrix(rows.select(key, *features), features)
    n = data.count()
    size = min(sample_size, n)
    share = min(1.0, _OVERDRAW * size / max(n, 1))
    # Share of the signed 64-bit hash range.
    limit = min(2**63 - 1, int(-(2**63) + share * 2.0**64))
    drawn = _drawn(data, key, features, n_trees, seed, limit)
    order = Window.partitionBy("tree").orderBy("draw", key)
    sample = drawn.withColumn("r", F.row_number().over(order)).where(F.col("r") <= size)
    grow = _tree_grower(key, features, seed, max(1, math.ceil(math.log2(max(size, 2)))))
    nodes = sample.groupBy("tree").applyInPandas(grow, _NODE_SCHEMA)
    # At most n_trees * (2 * sample_size - 1) rows: brought back once, so that
    # scoring never grows the trees again.
    local = nodes.toPandas()
    return Forest(
        rows.sparkSession.createDataFrame(local, _NODE_SCHEMA),
        features,
        size,
        contamination,
        n_trees,
    )


def _drawn(
    data: DataFrame, key: str, features: Sequence[str], n_trees: int, seed: int, limit: int
) -> DataFrame:
    """``tree, draw, key`` and features of the rows that a tree draws, ``limit`` at most.

    A row a tree, kept or not on the spot in generated code: a lambda over an array of draws
    is interpreted element by element.
    """
    trees = F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1))).alias("tree")
    draw = F.xxhash64(F.col(key), "tree", F.lit(seed)).alias("draw")
    every = data.select(trees, key, *features).select("tree", draw, key, *features)
    return every.where(F.col("draw") <= F.lit(limit))


def _tree_grower(key: str, features: list[str], seed: int, max_depth: int):
    def grow(sample: pd.DataFrame) -> pd.DataFrame:
        tree = int(sample["tree"].iloc[0])
        rng = np.random.default_rng([seed, tree])
        x = sample.sort_values(key)[features].to_numpy(dtype=float)
        nodes: list[tuple] = []
        waiting = [(np.arange(len(x)), 0, 0)]
        next_id = 1
        while waiting:
            rows, node, depth = waiting.pop()
            part = x[rows]
            varying = np.flatnonzero(part.min(axis=0) < part.max(axis=0)) if len(rows) else []
            if depth >= max_depth or len(rows) <= 1 or len(varying) == 0:
                nodes.append((tree, node, -1, 0.0, -1, -1, depth, len(rows)))
                continue
            feature = int(rng.choice(varying))
            low, high = part[:, feature].min(), part[:, feature].max()
            threshold = float(rng.uniform(low, high))
            goes_left = part[:, feature] <= threshold
            left, right = next_id, next_id + 1
            next_id += 2
            nodes.append((tree, node, feature, threshold, left, right, depth, len(rows)))
            waiting.append((rows[~goes_left], right, depth + 1))
            waiting.append((rows[goes_left], left, depth + 1))
        names = [c.split()[0] for c in _NODE_SCHEMA.split(", ")]
        return pd.DataFrame(nodes, columns=names)

    return grow


def _flat_trees(nodes: pd.DataFrame) -> tuple[np.ndarray, ...]:
    """All trees in one line of nodes.

    A right child follows its left one. A leaf leads to itself: its threshold is
    infinite and its left child is the leaf, so a walk may overrun it.
    """
    width = int(nodes["node"].max()) + 1
    size = (int(nodes["tree"].max()) + 1) * width
    at = nodes["tree"].to_numpy() * width + nodes["node"].to_numpy()
    leaf = nodes["feature"].to_numpy() < 0
    feature = np.zeros(size, dtype=np.int32)
    threshold = np.full(size, np.inf)
    left = np.arange(size, dtype=np.int32)
    length = np.zeros(size)
    feature[at] = np.where(leaf, 0, nodes["feature"])
    threshold[at] = np.where(leaf, np.inf, nodes["threshold"])
    left[at] = np.where(leaf, at, nodes["tree"].to_numpy() * width + nodes["left"].to_numpy())
    length[at] = nodes["depth"] + average_path(nodes["size"].to_numpy())
    roots = np.sort(at[nodes["node"].to_numpy() == 0]).astype(np.int32)
    return feature, threshold, left, length, roots


def anomaly_score(rows: DataFrame, forest: Forest, out: str = "anomaly_score") -> DataFrame:
    """Add 2^(-mean path / expected path): in (0, 1), higher is rarer."""
    nodes = forest.nodes.toPandas()
    steps = int(nodes["depth"].max())
    expected = max(float(average_path(np.array(forest.sample_size))), 1e-12)
    shared = rows.sparkSession.sparkContext.broadcast(_flat_trees(nodes))

    def mean_path(x: np.ndarray) -> np.ndarray:
        feature, threshold, left, length, roots = shared.value
        values = x.ravel()
        row = (np.arange(len(x), dtype=np.int32) * x.shape[1])[:, None]
        node = np.repeat(roots[None, :], len(x), axis=0)
        for _ in range(steps):
            value = values.take(row + feature.take(node))
            node = left.take(node) + (value > threshold.take(node))
        return length.take(node).mean(axis=1)

    @F.pandas_udf("double")
    def score(chunks: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in chunks:
            x = np.column_stack([c.fillna(0.0).to_numpy(dtype=float) for c in columns])
            parts = [mean_path(x[i : i + 1024]) for i in range(0, len(x), 1024)]
            paths = np.concatenate(parts) if parts else np.zeros(0)
            yield pd.Series(2.0 ** (-paths / expected))

    return rows.withColumn(out, score(*[F.col(c).cast("double") for c in forest.features]))


def flag_outliers(
    scored: DataFrame,
    score: str = "anomaly_score",
    contamination: float = CONTAMINATION,
    out: str = "isolation_forest_outlier",
) -> DataFrame:
    """True strictly above the (1 - contamination) quantile of the scores.

    Reads the scores several times: pass a written table when they are costly.
    """
    limit = exact_quantiles(scored, {score: [1.0 - contamination]})[score][0]
    return scored.withColumn(out, F.col(score) > F.lit(limit))


def top_anomalies(scored: DataFrame, n: int = 500, score: str = "anomaly_score") -> DataFrame:
    """The n largest scores; ties by transaction id."""
    return existing_columns(
        scored.orderBy(F.desc(score), "txn_id").limit(n),
        [score if c == "anomaly_score" else c for c in SCORE_COLUMNS],
    )


def anomaly_summary(
    scored: DataFrame,
    score: str = "anomaly_score",
    flag: str = "isolation_forest_outlier",
    label: str = "is_fraud",
    top: int = 100,
    forest: Forest | None = None,
) -> DataFrame:
    """Rows, flagged rows, mean and population deviation, label share of the top rows.

    The label share is null with fewer than ``top`` rows or without a label. With
    ``forest`` its settings are in the row too: n_estimators, contamination, n_features
    and feature_cols, the features joined by commas.
    """
    summary = scored.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(flag)).alias("n_flagged_outliers"),
        F.avg(score).alias("mean_anomaly_score"),
        F.stddev_pop(score).alias("std_anomaly_score"),
    )
    overlap = F.lit(None).cast("double")
    if label in scored.columns:
        best = scored.orderBy(F.desc(score), "txn_id").limit(top)
        share = best.agg(F.avg(label).alias("share"))
        overlap = F.when(F.col("n_rows") >= top, share.scalar())
    summary = summary.withColumn("top_100_overlap_with_labeled_fraud", overlap)
    if forest is None:
        return summary
    return summary.withColumns({
        "n_estimators": F.lit(forest.n_trees),
        "contamination": F.lit(float(forest.contamination)),
        "n_features": F.lit(len(forest.features)),
        "feature_cols": F.lit(",".join(forest.features)),
    })
