import pytest
from pyspark.sql import functions as F

from tillwise.operators.features import feature_matrix
from tillwise.functions.text import yes_no
from tillwise.operators import cleaning
from tillwise.sources import feeds


def column(df, name, key="txn_id"):
    return [r[name] for r in df.orderBy(key).collect()]


def test_negative_amounts_become_positive(make_tx):
    out = cleaning.clean_transactions(make_tx([(1, 10.0, 1, 1), (1, -5.0, 1, 1)]))
    assert column(out, "amount") == [10.0, 5.0]


def test_missing_location_takes_users_mode(make_tx):
    rows = [(1, 10.0, 5, 1), (1, 20.0, None, 1), (1, 15.0, 5, 1)]
    assert column(cleaning.clean_transactions(make_tx(rows)), "location_id") == [5, 5, 5]


def test_mode_tie_takes_smallest(make_tx):
    rows = [(1, 1.0, loc, 1) for loc in (5, 3, 5, 3, None)]
    assert column(cleaning.clean_transactions(make_tx(rows)), "location_id")[-1] == 3


def test_user_without_location_takes_truncated_global_median(make_tx):
    rows = [(1, 1.0, 4, 1), (1, 1.0, 5, 1), (2, 1.0, None, 1), (2, 1.0, None, 1)]
    assert column(cleaning.clean_transactions(make_tx(rows)), "location_id") == [4, 5, 4, 4]


def test_zero_amount_takes_median_after_abs(make_tx):
    rows = [(1, a, 1, 1) for a in (-10.0, 0.0, 30.0)]
    assert column(cleaning.clean_transactions(make_tx(rows)), "amount") == [10.0, 10.0, 30.0]


def test_rows_and_columns_are_kept(make_tx):
    tx = make_tx([(1, None, None, 1), (2, 3.0, 1, 1)])
    out = cleaning.clean_transactions(tx)
    assert out.columns == tx.columns and out.count() == 2
    assert column(out, "amount")[0] is None


def test_home_location_without_any_location(make_tx):
    out = cleaning.user_home_location(make_tx([(1, 1.0, None, 1), (2, 1.0, 7, 1)]))
    assert {r.user_id: r.home_location for r in out.collect()} == {1: None, 2: 7}


@pytest.mark.parametrize(
    "text, expected",
    [
        (None, "neutral review placeholder"),
        (" ###CORRUPT### ", "neutral review placeholder"),
        ("fine ###CORRUPT###", "fine"),
        ("\t\n two words  \n", "two words"),
        ("a###CORRUPT###b###CORRUPT###", "ab"),
    ],
)
def test_clean_reviews(spark, text, expected):
    df = spark.createDataFrame([(1, 1, 1, text, None)], feeds.REVIEWS)
    assert cleaning.clean_reviews(df).first()["text"] == expected


def test_clean_baskets(spark):
    rows = [(1, None), (1, "  tin-1 "), (2, "   "), (2, "A\t")]
    out = cleaning.clean_baskets(spark.createDataFrame(rows, feeds.ORDER_LINES))
    assert sorted(map(tuple, out.collect())) == [(1, "TIN-1"), (2, "A")]


def test_clean_churn_uses_exact_median(spark):
    rows = [(i, 1, s, 1, 0, 0) for i, s in enumerate([1.0, 2.0, 10.0, 20.0, None])]
    out = cleaning.clean_churn(spark.createDataFrame(rows, feeds.CHURN))
    assert column(out, "monthly_spend", "user_id")[-1] == 6.0


def test_clean_ratings_clips_and_truncates(spark):
    rows = [(1, i, r) for i, r in enumerate([0.125, 3.99, 6.25, None])]
    out = cleaning.clean_ratings(spark.createDataFrame(rows, feeds.RATINGS))
    assert column(out, "rating", "product_id") == [1, 3, 5]


def test_coerce_numeric(spark):
    df = spark.createDataFrame([("1.5",), ("x",), (None,), ("NaN",)], "v string")
    got = [r[0] for r in df.select(cleaning.coerce_numeric("v")).collect()]
    assert got == [1.5, 0.0, 0.0, 0.0]
    numbers = spark.createDataFrame([(2.0,), (float("nan"),)], "v double")
    assert [r[0] for r in numbers.select(cleaning.coerce_numeric("v")).collect()] == [2.0, 0.0]
    assert [r.v for r in feature_matrix(numbers, ["v"]).collect()] == [2.0, 0.0]


def test_yes_no(spark):
    df = spark.range(2).select(yes_no(F.col("id")).alias("v"))
    assert [r.v for r in df.orderBy("v").collect()] == ["No", "Yes"]
