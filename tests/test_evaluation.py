import numpy as np
import pytest

from tillwise.operators import evaluation


def brute_auc(scores, labels):
    pos = [s for s, y in zip(scores, labels) if y == 1]
    neg = [s for s, y in zip(scores, labels) if y == 0]
    return sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("rows_per_bin", [10, 1000])
@pytest.mark.parametrize("digits", [1, 6])
def test_roc_auc(spark, rows_per_bin, digits):
    rng = np.random.default_rng(5)
    labels = rng.integers(0, 2, 300)
    scores = np.round(rng.random(300) + 0.3 * labels, digits)
    df = spark.createDataFrame(
        [(float(s), int(y)) for s, y in zip(scores, labels)], "s double, y int"
    ).repartition(5)
    got = evaluation.roc_auc(df, "s", "y", rows_per_bin).first()["roc_auc"]
    assert got == pytest.approx(brute_auc(scores, labels), abs=1e-12)


def test_auc_of_ties_and_of_one_class(spark):
    tied = spark.createDataFrame([(0.5, 1), (0.5, 0)], "s double, y int")
    assert evaluation.roc_auc(tied, "s", "y").first()[0] == 0.5
    assert evaluation.roc_auc(tied.where("y = 1"), "s", "y").first()[0] is None


def test_report(spark):
    rows = [("a", "a")] * 3 + [("a", "b")] * 1 + [("b", "a")] * 2 + [("c", "a")] * 1
    df = spark.createDataFrame(rows, "y string, p string")
    got = {r["class"]: r for r in evaluation.classification_report(df, "y", "p").collect()}
    assert got["a"].precision == pytest.approx(0.5) and got["a"].recall == pytest.approx(0.75)
    assert got["a"].f1_score == pytest.approx(0.6) and got["a"].support == 4
    assert got["b"].precision == 0 and got["b"].f1_score == 0
    # Never predicted: precision is 0, not undefined.
    assert got["c"].precision == 0 and got["c"].support == 1
    assert got["accuracy"].precision == pytest.approx(3 / 7)
    assert got["macro avg"].recall == pytest.approx(0.25)
    assert got["weighted avg"].precision == pytest.approx(0.5 * 4 / 7)
    assert got["weighted avg"].support == 7


def test_compare_models(spark):
    def row(auc):
        return spark.createDataFrame([(auc, 0.9)], "roc_auc double, accuracy double")

    pick = lambda a, b: evaluation.compare_models(row(a), row(b)).first()["finding"]
    assert pick(0.8, 0.7) == evaluation.FINDING_HIGHER
    assert pick(0.7, 0.8) == evaluation.FINDING_LOWER
    assert pick(0.7, 0.7) == evaluation.FINDING_TIED
