from datetime import timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sample_data import START
from tillwise.operators import whatif
from tillwise.sources import feeds
from tillwise.workspace import fresh_path


def direct(history, scenario):
    """The rule read literally: append the row, clean, take its features."""
    _, user, amount, location, device = scenario
    rows = [r for r in history if r[0] == user]
    frame = pd.DataFrame(
        [r[:4] for r in rows] + [(user, amount, location, device)],
        columns=["user", "amount", "location", "device"],
    )
    frame["amount"] = frame["amount"].abs()
    frame["amount"] = frame["amount"].where(~(frame["amount"] <= 0), frame["amount"].median())
    mode = frame["location"].mode().iloc[0]
    frame["location"] = frame["location"].fillna(mode)
    last = frame.iloc[-1]
    limit = frame["amount"].quantile(0.95)
    return (
        round(float(last.amount), 9),
        int(last.location),
        int(last.location != frame["location"].mode().iloc[0]),
        int(round(last.amount, 6) > round(limit, 6)),
        int(last.device not in set(frame["device"].iloc[:-1])),
    )


@pytest.mark.parametrize("kind", ["history", "summary", "merged"])
def test_summaries_equal_copied_histories(spark, make_tx, kind):
    rng = np.random.default_rng(8)
    history = []
    for user, n in ((1, 1), (2, 2), (3, 3), (4, 7), (5, 21), (6, 60), (7, 4)):
        for _ in range(n):
            amount = float(rng.choice([0.0, -5.0, 10.0, 20.0, 35.5, 100.0, 7.25]))
            location = [None, 1, 2, 3][rng.integers(0, 4)]
            history.append((user, amount, location if user != 7 else None, int(rng.integers(0, 4))))
    scenarios = []
    for user in range(1, 9):
        for amount in (0.01, 0.0, 7.25, 20.0, 36.0, 1000.0, -50.0):
            for location in (1, 2, 9):
                scenarios.append((len(scenarios), user, amount, location, int(rng.integers(0, 6))))
    df = spark.createDataFrame(scenarios, feeds.SCENARIOS)
    tx = make_tx(history).repartition(4)
    known = tx
    if kind == "summary":
        known = whatif.OrderSummary.of(tx).write(fresh_path(spark, "summary"))
    elif kind == "merged":
        # Rows arrive in three parts, each merged into what was written before.
        first = whatif.OrderSummary.of(tx.where("txn_id % 3 = 0")).write(fresh_path(spark, "summary"))
        second = first.merge(tx.where("txn_id % 3 = 1")).write(fresh_path(spark, "summary"))
        known = second.merge(tx.where("txn_id % 3 = 2"))
    out = whatif.whatif_features(df, known).collect()
    got = {
        r.scenario_id: (
            round(r.amount, 9), r.location_id, r.unusual_location, r.high_spend, r.new_device
        )
        for r in out
    }
    assert got == {s[0]: direct(history, s) for s in scenarios if s[1] != 8}
    last = {u: max(i for i, h in enumerate(history) if h[0] == u) for u in range(1, 8)}
    for r in out:
        assert r.timestamp == START + timedelta(minutes=last[r.user_id] + 1)


def test_null_amount_is_no_high_spend(spark, make_tx):
    df = spark.createDataFrame([(1, 1, None, 1, 1)], feeds.SCENARIOS)
    row = whatif.whatif_features(df, make_tx([(1, 5.0, 1, 1), (2, 5.0, 1, 1)])).first()
    assert (row.amount, row.high_spend) == (None, 0)


def test_scenarios_read_the_summary_alone(spark, make_tx):
    """No window and no scan of the history; other users' parts are left out first."""
    df = spark.createDataFrame([(1, 1, 2.0, 1, 1)], feeds.SCENARIOS)
    tx = make_tx([(1, 5.0, 1, 1), (2, 5.0, 1, 1)])
    path = fresh_path(spark, "summary")
    made = whatif.whatif_features(df, whatif.OrderSummary.of(tx).write(path))
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "txn_id" not in plan and plan.count("LeftSemi") >= 4
    # Over the counts of blocks, which hold no row of the history.
    assert plan.count("Window [") <= 2
    built = whatif.OrderSummary.of(tx).amounts._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in built


def test_blocks_follow_the_amounts(spark):
    rng = np.random.default_rng(3)
    values = sorted({0.0, *(2.0**k for k in range(-20, 40)), *np.nextafter(2.0 ** np.arange(-20, 40), 0),
                     *rng.lognormal(3, 4, 500)})
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    blocks = [r[0] for r in df.orderBy("v").select(whatif._block(F.col("v"))).collect()]
    assert blocks == sorted(blocks) and len(set(blocks)) > 400
