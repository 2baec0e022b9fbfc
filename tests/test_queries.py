import pytest

import __spark_entry__ as entry
from sample_data import SMALL
from oracle_check import compare, duck
from tillwise.plans import oracle
from tillwise.plans.queries import REGISTRY

QUERIES, SQL = entry.queries(), entry.oracle_sql()
# Their results come from randomised or iterative training, or from the clock.
ROWS_ONLY = {
    "cf_als", "whatif_score", "fraud_score", "fraud_report", "fraud_baseline_comparison",
    "churn_score", "anomaly_score", "findings_table", "stream_event_score", "stream_batch_scores",
    "churn_report", "model_threshold_counts", "model_alert_counts",
}


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_every_query_is_checked_or_listed():
    assert set(REGISTRY) == set(oracle.statements()) | ROWS_ONLY and not set(SQL) & ROWS_ONLY


@pytest.mark.parametrize("name", sorted(SQL))
def test_equal_to_duckdb(spark, con, name):
    assert compare(spark, con, SMALL, name, QUERIES[name], SQL[name]) is None


@pytest.mark.parametrize("name", sorted(ROWS_ONLY - {"churn_score", "findings_table"}))
def test_rows_only(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_entry(spark):
    assert 0 < entry.entry(spark).count() <= 20


PLANNED = [
    "user_spend_top20", "fraud_user_rollup_raw", "clean_transactions", "engineer_fraud_features",
    "clean_reviews", "cf_matrix", "cf_neighbors", "cf_recommend", "basket_build", "pair_rules",
    "association_rules", "whatif_features", "positional_batch_stats", "roc_auc",
]


@pytest.mark.parametrize("name", PLANNED)
def test_plan_has_no_product_of_tables(spark, name):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_rollup_combines_before_the_shuffle(spark):
    frame = QUERIES["fraud_user_rollup_raw"](spark, SMALL)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "partial_sum" in plan
    scan = plan[plan.index("ReadSchema"):]
    assert "event_type" not in scan


def test_features_take_one_exchange_of_the_rows(spark):
    from tillwise.operators.features import engineer_fraud_features
    from tillwise.plans import trained

    rows = trained.featured_transactions(spark, SMALL).drop(
        "unusual_location", "high_spend", "new_device"
    )
    plan = engineer_fraud_features(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
