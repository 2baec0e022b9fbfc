import pytest
from pyspark.sql import functions as F

from tillwise.functions import lexicon, text
from tillwise.operators import sentiment


@pytest.mark.parametrize(
    "words, polarity, label",
    [
        ("a good one", 0.7, "positive"),
        ("Very GOOD", 0.91, "positive"),
        ("not good", -0.35, "negative"),
        ("not very good", -0.455, "negative"),
        ("never bad, always excellent", (0.35 + 1.0) / 2, "positive"),
        ("extremely excellent", 1.0, "positive"),
        ("good bad", 0.0, "neutral"),
        ("goodness", 0.0, "neutral"),
        ("", 0.0, "neutral"),
        (None, 0.0, "neutral"),
        ("x " * 20_000 + "terrible", -1.0, "negative"),
    ],
)
def test_polarity(spark, words, polarity, label):
    df = spark.createDataFrame([(words,)], "text string")
    row = sentiment.score_reviews(df).first()
    assert row.polarity == pytest.approx(polarity, abs=1e-4) and row.sentiment == label


def test_threshold_is_strict(spark):
    df = spark.createDataFrame([(0.05,), (-0.05,), (0.051,), (-0.051,)], "p double")
    got = [r[0] for r in df.select(text.sentiment_label(F.col("p"))).collect()]
    assert got == ["neutral", "neutral", "positive", "negative"]


def test_own_word_list(spark):
    df = spark.createDataFrame([("gut",)], "text string")
    assert sentiment.score_reviews(df, words={"gut": 0.6}).first().sentiment == "positive"


def test_metrics_only_over_labelled_rows(spark):
    df = spark.createDataFrame(
        [("good", "positive"), ("bad", "positive"), ("bad", None)], "text string, true_sentiment string"
    )
    scored = sentiment.score_reviews(df)
    assert tuple(sentiment.sentiment_accuracy(scored).first()) == (0.5, 2)
    assert sentiment.sentiment_accuracy(scored.drop("true_sentiment")) is None
    assert sentiment.sentiment_report(scored.drop("true_sentiment")) is None
    lines = {r["class"] for r in sentiment.sentiment_report(scored).collect()}
    assert lines == {"positive", "negative", "accuracy", "macro avg", "weighted avg"}


def test_printed_numbers(spark):
    df = spark.createDataFrame([(0.1234,), (None,)], "v double")
    got = [tuple(r) for r in df.select(text.percent_text(F.col("v")), text.fixed_text(F.col("v"))).collect()]
    assert got == [("12.3%", "0.123"), ("—", "—")]


PHRASES = [
    ("good", "score", 0.7, 0), ("not good at all", "score", -0.9, 0), ("bad", "score", -0.7, 0),
    ("sehr schön", "score", 0.9, 0), ("schön", "score", 0.6, 0), ("not", "negation", -0.5, 3),
    ("anything but", "negation", -1.0, 2), ("very", "intensifier", 1.3, 1), ("a bit", "intensifier", 0.5, 2),
    ("好", "score", 0.8, 0), ("", "score", 1.0, 0), (None, "score", 1.0, 0), ("odd", "unknown", 1.0, 0),
]


@pytest.mark.parametrize(
    "words, polarity, hits",
    [
        ("good", 0.7, 1),
        ("It was not good at all, bad!", (-0.9 - 0.7) / 2, 2),  # the longest phrase, and its negation in it
        ("not good at", -0.35, 1),  # a phrase that does not end: the shorter ones count
        ("not the very good", -0.455, 1),  # the scope reaches three words on, past the intensifier
        ("not a b c good", 0.7, 1),
        ("not good good", (-0.35 + 0.7) / 2, 2),  # a scored phrase ends the scope
        ("anything but good", -0.7, 1),
        ("a bit so good", 0.35, 1),
        ("very so good", 0.7, 1),
        ("very not very good", -0.455, 1),
        ("Sehr SCHÖN, schön", 0.75, 2),
        ("好 好好", 0.8, 1),
        ("goodness odd", 0.0, 0),
        ("", 0.0, 0),
        (None, 0.0, 0),
    ],
)
def test_lexicon_with_phrases(spark, words, polarity, hits):
    table = spark.createDataFrame(
        [(*p, "a test", "none") for p in PHRASES], lexicon.LEXICON)
    df = spark.createDataFrame([(words, 7)], "text string, polarity_phrases int")
    row = lexicon.with_polarity(df, table).first()
    assert (round(row.polarity, 9), row.polarity_phrases) == (round(polarity, 9), hits)


def test_lexicon_is_bounded_and_states_its_source(spark, monkeypatch):
    table = lexicon.default_lexicon(spark)
    assert table.where("source is null or licence is null").count() == 0
    df = spark.createDataFrame([("great quality",)], "text string")
    assert sentiment.score_with_lexicon(df, table).first().polarity == 0.9
    monkeypatch.setattr(lexicon, "MAX_PHRASES", 10)
    with pytest.raises(ValueError):
        lexicon.with_polarity(df, table)
