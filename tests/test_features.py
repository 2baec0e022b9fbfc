import numpy as np
import pytest

from tillwise.functions import running
from tillwise.operators import features


def flags(df):
    return [
        (r.unusual_location, r.high_spend, r.new_device) for r in df.orderBy("txn_id").collect()
    ]


TINY = [(1, 10.0, 1, 10), (1, 12.0, 1, 10), (1, 500.0, 1, 11), (1, 11.0, 2, 10)]
MIXED = (
    [(1, float(i % 97), i % 3, i % 5, i // 2) for i in range(400)]
    + [(2, 900.0, 4, 1, 3)]
    + [(3, 5.0, None, 1, 9), (3, 6.0, None, 1, 9), (3, 7.0, None, 2, 1)]
    + [(None, float(i), i % 2, i % 3) for i in range(30)]
    + [(4, None, 2, 1, 1), (4, 8.0, 2, 1, 1), (4, 8.0, 1, 1, 0)]
)


@pytest.mark.parametrize("hot_rows", [None, 0, 200_000])
def test_reference_case(make_tx, hot_rows):
    out = features.engineer_fraud_features(make_tx(TINY), hot_rows=hot_rows)
    assert flags(out) == [(0, 0, 1), (0, 0, 0), (0, 1, 1), (1, 0, 0)]


@pytest.mark.parametrize("hot_rows", [0, 3, 100])
def test_hot_path_equals_window_path(make_tx, hot_rows):
    tx = make_tx(MIXED).repartition(6)
    plain = features.engineer_fraud_features(tx, hot_rows=None)
    assert flags(features.engineer_fraud_features(tx, hot_rows=hot_rows)) == flags(plain)


def test_single_row_user_never_spends_high(make_tx):
    assert flags(features.engineer_fraud_features(make_tx([(1, 900.0, 1, 1)]))) == [(0, 0, 1)]


def test_null_location_is_unusual(make_tx):
    rows = [(1, 1.0, 1, 1), (1, 1.0, None, 1), (1, 1.0, 1, 1)]
    out = features.engineer_fraud_features(make_tx(rows))
    assert [f[0] for f in flags(out)] == [0, 1, 0]


def test_time_tie_on_device_takes_smaller_id(make_tx):
    rows = [(1, 1.0, 1, 1, 5), (1, 1.0, 1, 1, 5)]
    assert [f[2] for f in flags(features.engineer_fraud_features(make_tx(rows)))] == [1, 0]


def test_scope_within_batches(make_tx):
    from pyspark.sql import functions as F

    tx = make_tx([(1, 1.0, 1, 1), (1, 1.0, 1, 1), (1, 1.0, 2, 1)])
    batched = tx.withColumn("batch_no", F.floor(F.col("txn_id") / 2))
    out = features.engineer_fraud_features(batched, by=("batch_no", "user_id"), hot_rows=None)
    assert flags(out) == [(0, 0, 1), (0, 0, 0), (0, 0, 1)]


def test_partition_count_does_not_matter(spark, make_tx):
    results = []
    for n in ("1", "4", "17"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        results.append(flags(features.engineer_fraud_features(make_tx(MIXED), hot_rows=100)))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert results[0] == results[1] == results[2]


def test_feature_matrix_and_existing_columns(make_tx):
    tx = make_tx([(1, None, 1, 1)])
    assert features.feature_matrix(tx, ["amount"]).first()["amount"] == 0.0
    assert features.existing_columns(tx, ["amount", "missing", "user_id"]).columns == [
        "amount", "user_id"
    ]


def asof_limits(rows):
    """Brute force: numpy's quantile of every user's earlier amounts."""
    seen, out = {}, []
    for txn, user, amount in rows:
        past = seen.setdefault(user, [])
        out.append((txn, round(float(np.quantile(past, 0.95)), 9) if past else None))
        if amount is not None:
            past.append(amount)
    return out


@pytest.mark.parametrize("hot_rows, range_rows", [(10_000, 500), (0, 60), (100, 37), (100, 10_000)])
def test_asof_limit_equals_brute_force(make_tx, monkeypatch, hot_rows, range_rows):
    """Ordinary users, users above the hot limit, ties, gaps, a drift and a heavy value."""
    monkeypatch.setattr(running, "BATCH_ROWS", 90)
    rng = np.random.default_rng(3)
    rows = [(1, float(v), 1, 1, i // 3) for i, v in enumerate(np.arange(700) + rng.normal(0, 40, 700))]
    rows += [(2, float(rng.choice([5.0, 5.0, 5.0, 9.0, 100.0])), 1, 1, i) for i in range(400)]
    rows += [(3 + i % 9, float(rng.integers(0, 20)), 1, 1, i) for i in range(200)]
    rows += [(None, None if i % 4 == 0 else float(i % 50), 1, 1, i) for i in range(150)]
    rows += [(20, None, 1, 1, 0), (20, None, 1, 1, 1), (20, 3.0, 1, 1, 2), (20, 4.0, 1, 1, 3)]
    tx = make_tx(rows).repartition(6)
    out = features.high_spend_asof(tx, hot_rows=hot_rows, range_rows=range_rows)
    got = sorted((r.txn_id, None if r.spend_limit_asof is None else round(r.spend_limit_asof, 9), r.high_spend_asof)
                 for r in out.collect())
    ordered = sorted((r.user_id is not None, r.user_id or 0, r.timestamp, r.txn_id, r.amount) for r in tx.collect())
    want = dict(asof_limits([(o[3], o[:2], o[4]) for o in ordered]))
    amounts = {o[3]: o[4] for o in ordered}
    assert [(t, limit) for t, limit, _ in got] == sorted(want.items())
    for txn, limit, flag in got:
        above = limit is not None and amounts[txn] is not None and round(amounts[txn], 6) > round(limit, 6)
        assert flag == int(above)


def test_asof_of_nothing(make_tx):
    assert features.high_spend_asof(make_tx([])).count() == 0


def test_kth_smallest_descends_over_given_counts():
    rng = np.random.default_rng(1)
    for size in (1, 2, 5, 64):
        ranks, base = rng.integers(0, size, 50), rng.integers(0, 4, size)
        high = np.arange(51)
        for k in range(0, 40, 7):
            ask = high[high + base.sum() > k]
            found, left = running.kth_smallest(ranks, 0 * ask, ask, 0 * ask + k, base)
            for h, f, rest in zip(ask, found, left):
                whole = sorted(np.concatenate([np.repeat(np.arange(size), base), ranks[:h]]))
                assert whole[k] == f and whole.index(f) + rest == k
