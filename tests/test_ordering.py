import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwise.functions import ordering, scan
from tillwise.functions.skew import hot_groups


def frame(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "v double").repartition(5)


SAMPLES = {
    "spread": np.random.default_rng(1).normal(0, 100, 5000),
    "heavy tail": np.random.default_rng(2).pareto(1.0, 5000),
    "one third equal": np.r_[np.full(2000, 7.0), np.arange(4000)],
    "two values": np.r_[np.zeros(3000), np.ones(3001)],
    "all equal": np.full(500, 3.0),
    "single": np.array([4.0]),
    "between two masses": np.r_[np.zeros(3000), np.linspace(1, 2, 900), np.full(3000, 9.0)],
    "masses inside masses": np.r_[np.repeat([0.0, 1, 8, 9], 1000), np.linspace(2, 7, 901)],
}


@pytest.mark.parametrize("name", SAMPLES)
@pytest.mark.parametrize("limit", [100_000, 200])
def test_exact_quantiles(spark, name, limit):
    probs = [0.0, 0.05, 0.5, 0.95, 0.97, 1.0]
    df = frame(spark, SAMPLES[name])
    got = ordering.exact_quantiles(df, {"v": probs}, accuracy=200, slice_rows=limit)["v"]
    assert got == pytest.approx(list(np.quantile(SAMPLES[name], probs)), abs=1e-9)


def test_exact_quantiles_of_several_columns_skip_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, 5.0), (4, None)], "a int, b double")
    got = ordering.exact_quantiles(df, {"a": [0.5], "b": [0.5]})
    assert got == {"a": [2.0], "b": [5.0]}
    assert ordering.exact_quantiles(df.where("a > 9"), {"a": [0.5]}) == {"a": [None]}


@pytest.mark.parametrize("hot_rows", [None, 50])
@pytest.mark.parametrize("prob", [0.5, 0.95])
def test_group_order_window(spark, hot_rows, prob):
    rng = np.random.default_rng(3)
    groups = {1: rng.normal(size=1500), 2: rng.integers(0, 4, 400), 3: rng.normal(size=7), 4: [2.0]}
    rows = [(g, float(v)) for g, values in groups.items() for v in values]
    df = spark.createDataFrame(rows, "g int, v double").repartition(6)
    near = ordering.group_order_window(df, ["g"], "v", prob, hot_rows=hot_rows, accuracy=50)
    got = {r.g: r for r in near.collect()}
    limits = {
        r.g: r.q for r in ordering.group_quantile(near, ["g"], prob, "q").collect()
    }
    for g, values in groups.items():
        ordered = sorted(float(v) for v in values)
        rank = int(np.floor(prob * len(ordered)))
        at = lambda i: ordered[i] if 0 <= i < len(ordered) else None
        r = got[g]
        assert (r.n, r["rank"], r.prev, r.here, r.next) == (
            len(ordered), rank, at(rank - 1), at(rank), at(rank + 1)
        )
        assert limits[g] == pytest.approx(np.quantile(ordered, prob))


@pytest.mark.parametrize("rows_per_bin", [7, 40, 10_000])
def test_global_row_index(spark, rows_per_bin):
    keys = [int(k) for k in np.random.default_rng(4).permutation(300) ** 2]
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(7)
    indexed, total = ordering.global_row_index(df, "k", rows_per_bin)
    assert total == 300
    got = {r.k: r.row_index for r in indexed.collect()}
    assert got == {k: i for i, k in enumerate(sorted(keys))}


@pytest.mark.parametrize("hot_rows", [10, 10_000])
def test_occurrence_index(spark, make_tx, hot_rows):
    rows = [(1, 1.0, 1, 5)] * 120 + [(2, 1.0, 1, 6)] * 4 + [(None, 1.0, 1, 6)] * 30
    out = ordering.occurrence_index(
        make_tx(rows), ["user_id", "device_id"], ["timestamp"], "txn_id", hot_rows, 20
    )
    got = [(r.user_id, r.occurrence) for r in out.orderBy("txn_id").collect()]
    assert got == [(1, i) for i in range(120)] + [(2, i) for i in range(4)] + [
        (None, i) for i in range(30)
    ]


def test_hot_groups_are_few(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    hot = hot_groups(df, ["k"], hot_rows=100)
    assert [r.k for r in hot.collect()] == [0]
    assert hot_groups(df, ["k"], hot_rows=5000) is None
    # The limit is the same whatever else there is; only the join's hint depends on the keys.
    assert hot_groups(df, ["k"], hot_rows=0, max_keys=10).count() == 2001


def test_rows_of_one_timestamp_are_split(spark, make_tx, monkeypatch):
    """Ties on the order column are told apart by the id: no range grows with them."""
    monkeypatch.setattr(scan, "FAN", 3)
    tx = make_tx([(1, 1.0, 1, 5, 0)] * 230 + [(2, 1.0, 1, 5, 0)] * 45).repartition(5)
    ranged = scan.in_ranges(tx, ["user_id", "timestamp", "txn_id"], 10)
    assert ranged.groupBy("range").count().agg(F.max("count")).first()[0] <= 30
    out = ordering.occurrence_index(tx, ["user_id"], ["timestamp"], "txn_id", 10, rows_per_bin=10)
    got = [r.occurrence for r in out.orderBy("user_id", "txn_id").collect()]
    assert got == [*range(230), *range(45)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "element_at" not in plan and "array(" not in plan


@pytest.mark.parametrize("fan", [2, 7, 1000])
def test_prefix_sums_of_many_levels(spark, fan):
    rng = np.random.default_rng(fan)
    rows = [(g, k, int(rng.integers(0, 9)), float(k)) for g in (None, 1, 2) for k in range(0, 90, 1 if g else 7)]
    df = spark.createDataFrame(rows, "g long, k int, n long, x double").repartition(4)
    got = {(r.g, r.k): (r.before_n, r.before_x) for r in scan.prefix_sums(df, "k", ["n", "x"], ["g"], fan).collect()}
    for g, k, _, _ in rows:
        earlier = [r for r in rows if r[0] == g and r[1] < k]
        assert got[g, k] == (sum(r[2] for r in earlier), sum(r[3] for r in earlier))
    assert scan.prefix_sums(df.limit(0), "k", ["n"], ["g"], fan).count() == 0
