"""Mixing sources to target weights by iterative proportional fitting.

Documents are summed into cells (one per combination of source, language and topic;
combined before the shuffle). Raking scales the cells' token weights to one target
marginal after another until all hold. A document's probability is its cell's ratio of
raked to natural weight, times the expected share of the tokens. Where a ratio is too
high for the asked share, raking goes on with the cells' weights bounded, so that others
of the same marginals take over; the share is then the largest that leaves every
probability at 1 or less. The expected marginals of the draw so meet the targets. The
draw hashes the id (the text where there is none), so a rerun keeps the same rows.

The work per round is on cells. Marginals are groupBy sums that Spark joins back by
their measured size; nothing but rows of totals reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.workspace import materialise

DIMENSIONS = ("source", "lang", "topic")
#: Targets: shares in proportion to tokens ** exponent, which damps dominant values.
EXPONENTS = {"source": 0.5, "lang": 0.7, "topic": 0.7}
KEPT_SHARE = 0.6
TOLERANCE = 1e-6
MAX_ROUNDS = 50
#: Part of the share that the marginals admit that bounded raking aims at, and its rounds.
#: At the full share it would need ever more rounds.
AIM, BOUNDED_ROUNDS = 0.98, 15


def token_count(text: Column) -> Column:
    """White-space separated words; null and empty texts have none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def topic_of(text: Column, tokens: Column) -> Column:
    """A content class for tables without a topic column: by length and share of symbols."""
    symbols = F.length(F.regexp_replace(text, r"[^#$%&*=<>{}|@\[\]\\^~`]+", ""))
    return (
        F.when(tokens == 0, "empty")
        .when(symbols * 25 > F.length(text), "symbols")
        .when(tokens < 150, "note")
        .when(tokens < 1000, "article")
        .otherwise("book")
    )


def _category(name: str) -> Column:
    """A value as text, null apart from every text."""
    return F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit(""))


def cells_of(docs: DataFrame, dimensions=DIMENSIONS, tokens_col: str = "tokens") -> DataFrame:
    """``docs`` summed by cell: one column per dimension, ``tokens`` and ``docs``."""
    return docs.groupBy(*[_category(d).alias(d) for d in dimensions]).agg(
        F.sum(F.col(tokens_col)).cast("double").alias("tokens"), F.count("*").alias("docs")
    )


def _targets(cells: DataFrame, dimension: str, asked: float | dict[str, float]) -> DataFrame:
    """Share of each value of a dimension that occurs with tokens; the shares add up to 1."""
    sums = cells.groupBy(dimension).agg(F.sum("tokens").alias("natural"))
    if isinstance(asked, dict):
        named = F.create_map(*[F.lit(x) for k, v in asked.items() for x in (f"={k}", float(v))])
        share = F.coalesce(F.try_element_at(named, F.col(dimension)), F.lit(0.0))
    else:
        share = F.pow("natural", F.lit(float(asked)))
    shares = materialise(sums.select(dimension, share.alias("share")), "mix-target")
    total = shares.agg(F.sum("share")).first()[0]
    return shares.select(dimension, (F.col("share") / F.lit(total or 1.0)).alias(f"t_{dimension}"))


def rake(
    cells: DataFrame,
    targets: dict[str, float | dict[str, float]],
    tolerance: float = TOLERANCE,
    max_rounds: int = MAX_ROUNDS,
    kept_share: float | None = None,
) -> DataFrame:
    """``cells`` (with tokens) plus ``weight``, whose marginals equal the targets.

    ``targets`` maps a dimension to shares by value, or to an exponent on the natural
    shares. Values without tokens have no part; values that a given table of shares
    leaves out get weight 0. Raking stops when no factor of a round is farther than
    ``tolerance`` from 1, or after ``max_rounds`` (targets that contradict each other
    have no solution; the last dimension's then hold). No cells: no rows.

    With ``kept_share``, ``BOUNDED_ROUNDS`` rounds more bring the weights towards what
    that share of the tokens can give, or the share that every value's tokens admit.
    """
    full = cells.where("tokens > 0")
    total = full.agg(F.sum("tokens")).first()[0] or 1.0
    current = full.withColumn("weight", F.col("tokens") / F.lit(total))
    for dimension, asked in targets.items():
        current = current.join(_targets(full, dimension, asked), dimension)
    current = materialise(current, "mix-cells")
    columns = current.columns

    def one_round(step: DataFrame) -> DataFrame:
        moved = F.lit(0.0)
        for dimension in targets:
            sums = step.groupBy(dimension).agg(F.sum("weight").alias("had"))
            factor = F.when(F.col("had") > 0, F.col(f"t_{dimension}") / F.col("had")).otherwise(0.0)
            step = step.join(sums, dimension).withColumn(f"f_{dimension}", factor)
            step = step.withColumn("weight", F.col("weight") * F.col(f"f_{dimension}")).drop("had")
            moved = F.greatest(
                moved, F.when(F.col("weight") > 0, F.abs(F.col(f"f_{dimension}") - 1)).otherwise(0.0)
            )
        return materialise(step.select(*columns, moved.alias("moved")), "mix-round")

    for _ in range(max_rounds):
        step = one_round(current)
        current = step.drop("moved")
        if (step.agg(F.max("moved")).first()[0] or 0.0) <= tolerance:
            break
    if kept_share is not None and _largest_share(current) < kept_share:
        admitted = [
            current.groupBy(d).agg(F.sum("tokens").alias("had"), F.first(f"t_{d}").alias("t"))
            .where("t > 0").agg(F.min(F.col("had") / F.col("t"))).first()[0] / total
            for d in targets
        ]
        share = min([kept_share, *[AIM * x for x in admitted]])
        most = F.col("tokens") / F.lit(total * share)
        for _ in range(BOUNDED_ROUNDS):
            current = one_round(current.withColumn("weight", F.least("weight", most))).drop("moved")
    return current.drop(*[f"t_{d}" for d in targets])


def _ratio(raked: DataFrame) -> Column:
    """Raked to natural weight of a cell, both as shares of their sums."""
    sums = raked.agg(F.sum("tokens"), F.sum("weight")).first()
    total, weight = sums[0] or 1.0, sums[1] or 1.0
    return (F.col("weight") / F.lit(weight)) / (F.col("tokens") / F.lit(total))


def _largest_share(raked: DataFrame) -> float:
    """The share of the tokens at which the first probability reaches 1."""
    return 1.0 / (raked.agg(F.max(_ratio(raked))).first()[0] or 1.0)


def calibrate(raked: DataFrame, kept_share: float = KEPT_SHARE) -> DataFrame:
    """``raked`` plus ``ratio`` and ``probability``, in proportion to each other.

    Expected tokens are ``kept_share`` of all, or the largest share that leaves every
    probability at 1 or less: a higher one would miss the marginals of the weights.
    """
    share = min(kept_share, _largest_share(raked))
    rated = raked.withColumn("ratio", _ratio(raked))
    return rated.withColumn("probability", F.least(F.lit(1.0), F.col("ratio") * F.lit(share)))


def features(docs: DataFrame, *keep: str) -> DataFrame:
    """Columns ``keep`` of ``docs``, source, lang, and ``tokens``, ``topic``, ``_text_hash`` of the text."""
    counted = docs.select(
        *keep, "source", "lang", "text", token_count(F.col("text")).alias("tokens"),
        F.xxhash64("text").alias("_text_hash"),
    )
    return counted.withColumn("topic", topic_of(F.col("text"), F.col("tokens"))).drop("text")


def draw(seed: int, *ids: str) -> Column:
    """A number in [0, 1) from ids; the same for the same ids and seed."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *ids), 11) / F.lit(float(1 << 53))


def mix(
    docs: DataFrame,
    cells: DataFrame,
    id_col: str = "doc_id",
    seed: int = 17,
    dimensions=DIMENSIONS,
) -> DataFrame:
    """``docs`` (with the dimensions' columns) plus ``probability``, ``ratio`` and ``selected``.

    Every row is kept, with its decision. A document without tokens has its cell's
    probability, and 0 where no document of the cell has tokens. Rows with equal ids
    share one draw; rows without an id are drawn by ``_text_hash``, if there is one.
    Columns of ``docs`` called like the three results, or ``_text_hash``, are left out;
    all others pass as they are.
    """
    number = draw(seed, id_col)
    if "_text_hash" in docs.columns:
        number = F.when(F.col(id_col).isNull(), draw(seed, id_col, "_text_hash")).otherwise(number)
    own = ("probability", "ratio", "selected", "_text_hash")
    # In a struct, so that no column of the documents can clash with those of the join.
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in own]).alias("row")
    keyed = docs.select(
        row, number.alias("number"), *[_category(d).alias(f"cell_{d}") for d in dimensions])
    side = cells.select(
        *[F.col(d).alias(f"at_{d}") for d in dimensions],
        F.col("ratio").alias("ratio"), F.col("probability").alias("probability"),
    )
    on = [F.col(f"cell_{d}") == F.col(f"at_{d}") for d in dimensions]
    probability = F.coalesce("probability", F.lit(0.0))
    return keyed.join(side, on, "left").select(
        "row.*",
        probability.alias("probability"),
        F.coalesce("ratio", F.lit(0.0)).alias("ratio"),
        (F.col("number") < probability).alias("selected"),
    )


def weights(counted: DataFrame, targets=None, kept_share: float = KEPT_SHARE) -> DataFrame:
    """Calibrated cells of a table with ``tokens`` and the dimensions, written."""
    cells = materialise(cells_of(counted), "mix-cells")
    raked = rake(cells, targets or EXPONENTS, kept_share=kept_share)
    return materialise(calibrate(raked, kept_share), "mix-weights")
