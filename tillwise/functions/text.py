"""String expressions: whitespace, number formats, word-list polarity."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# The default word list. Scores are ours; callers may pass their own.
POLARITY = {
    "amazing": 0.8,
    "awesome": 1.0,
    "awful": -1.0,
    "bad": -0.7,
    "best": 1.0,
    "boring": -1.0,
    "broken": -0.4,
    "disappointed": -0.75,
    "disappointing": -0.6,
    "excellent": 1.0,
    "fantastic": 0.4,
    "fast": 0.2,
    "fine": 0.4,
    "good": 0.7,
    "great": 0.8,
    "happy": 0.8,
    "hate": -0.8,
    "horrible": -1.0,
    "love": 0.5,
    "nice": 0.6,
    "okay": 0.1,
    "perfect": 1.0,
    "poor": -0.4,
    "sad": -0.5,
    "slow": -0.3,
    "terrible": -1.0,
    "ugly": -0.7,
    "useless": -0.5,
    "wonderful": 1.0,
    "worst": -1.0,
}
NEGATIONS = ["not", "never", "no"]
INTENSIFIERS = {"very": 1.3, "really": 1.2, "extremely": 1.5, "slightly": 0.5, "absolutely": 1.2}
NEGATION_FACTOR = -0.5
WORD_PATTERN = "[a-z']+"


# Every character that counts as whitespace, up to the last one (U+3000).
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def strip_whitespace(text: Column) -> Column:
    """Remove all leading and trailing whitespace, not only spaces."""
    return F.btrim(text, F.lit(WHITESPACE))


def word_tokens(text: Column) -> Column:
    lowered = F.lower(F.coalesce(text, F.lit("")))
    return F.regexp_extract_all(lowered, F.lit(WORD_PATTERN), F.lit(0))


def polarity(
    tokens: Column,
    words: dict[str, float] = POLARITY,
    negations: list[str] = NEGATIONS,
    intensifiers: dict[str, float] = INTENSIFIERS,
) -> Column:
    """Mean score of the listed words among ``tokens``, in [-1, 1]; 0 without any.

    An intensifier directly before a word scales it; a negation before the word
    (or before its intensifier) turns it to the other side at half strength.
    Most tokens only meet the hashed membership test. Pass a column, not the
    extraction itself: the expression reads ``tokens`` several times.
    """
    scores = F.create_map(*[F.lit(x) for x in chain.from_iterable(words.items())])
    boosts = F.create_map(*[F.lit(x) for x in chain.from_iterable(intensifiers.items())])

    def strength(token: Column, position: Column) -> Column:
        before = F.get(tokens, position - 1)
        boost = F.try_element_at(boosts, before)
        negator = F.when(boost.isNull(), before).otherwise(F.get(tokens, position - 2))
        negated = F.coalesce(negator.isin(negations), F.lit(False))
        value = (
            F.try_element_at(scores, token)
            * F.coalesce(boost, F.lit(1.0))
            * F.when(negated, NEGATION_FACTOR).otherwise(1.0)
        )
        return F.when(
            token.isin(list(words)), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), value))
        )

    found = F.filter(F.transform(tokens, strength), lambda x: x.isNotNull())
    # Sum and count in one fold.
    return F.aggregate(
        found,
        F.struct(F.lit(0.0).alias("total"), F.lit(0).alias("n")),
        lambda acc, x: F.struct((acc["total"] + x).alias("total"), (acc["n"] + 1).alias("n")),
        lambda acc: F.when(acc["n"] > 0, acc["total"] / acc["n"]).otherwise(0.0),
    )


def sentiment_label(value: Column, threshold: float = 0.05) -> Column:
    """Strictly above / below the threshold; everything else is neutral."""
    return F.when(value > threshold, "positive").when(value < -threshold, "negative").otherwise(
        "neutral"
    )


def percent_text(value: Column) -> Column:
    return F.when(value.isNull(), "—").otherwise(F.format_string("%.1f%%", value * 100))


def fixed_text(value: Column, digits: int = 3) -> Column:
    return F.when(value.isNull(), "—").otherwise(F.format_string(f"%.{digits}f", value))


def yes_no(flag: Column) -> Column:
    """0/1 or boolean to No/Yes."""
    return F.when(flag.cast("int") == 1, "Yes").when(flag.cast("int") == 0, "No")
