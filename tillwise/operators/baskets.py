"""Frequent itemsets and association rules."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.functions.text import strip_whitespace
from tillwise.workspace import materialise

SUPPORT_FULL = 0.006
SUPPORT_QUICK = 0.012
CONFIDENCE = 0.25


def basket_items(lines: DataFrame) -> DataFrame:
    """Distinct (order_id, product_id); blanks and nulls dropped.

    Repeats are removed before the shuffle and rows spread over both columns, so
    an order with very many lines is not gathered.
    """
    return (
        lines.where(F.length(strip_whitespace(F.col("product_id"))) > 0)
        .select("order_id", F.col("product_id").alias("item"))
        .distinct()
    )


def baskets(lines: DataFrame) -> DataFrame:
    """Sorted distinct items per order, whole: as long as the order has products.

    The miners do not use this form; they cut baskets first, see basket_support.
    """
    return basket_items(lines).groupBy("order_id").agg(
        F.sort_array(F.collect_list("item")).alias("items")
    )


@dataclass(frozen=True)
class BasketSupport:
    """What every miner needs: the basket count, item counts, and mined baskets."""

    n_baskets: int
    min_count: int
    item_counts: DataFrame  # item, n — frequent items only
    items: DataFrame  # order_id, item — distinct, all items

    @cached_property
    def baskets(self) -> DataFrame:
        """order_id, items — cut to frequent items, empty ones left out; written at first use."""
        cut = self.items.join(self.item_counts.select("item"), "item", "left_semi")
        kept = cut.groupBy("order_id").agg(F.sort_array(F.collect_list("item")).alias("items"))
        return materialise(kept, "baskets")


def _min_count(min_support: float, n: int) -> int:
    """Smallest count whose share of n reaches min_support."""
    count = max(1, math.ceil(min_support * n))
    if count > 1 and (count - 1) / n >= min_support:
        count -= 1
    while n and count / n < min_support:
        count += 1
    return count


def basket_support(lines: DataFrame, min_support: float) -> BasketSupport:
    """Count items; baskets are cut to the frequent ones when a miner asks for them.

    No set with an infrequent item can be frequent, so the cut loses nothing. It
    bounds every remaining basket: at most ``mean basket size / min_support``
    items are frequent, whatever the catalogue or the largest order.
    """
    items = materialise(basket_items(lines), "basket-items")
    n = items.agg(F.count_distinct("order_id")).first()[0]
    min_count = _min_count(min_support, n)
    item_counts = items.groupBy("item").agg(F.count(F.lit(1)).alias("n")).where(
        F.col("n") >= min_count
    )
    return BasketSupport(n, min_count, item_counts, items)


def item_support(support: BasketSupport) -> DataFrame:
    return support.item_counts.select(
        F.array("item").alias("items"), F.col("n").alias("freq"), _share(F.col("n"), support)
    )


def _share(count: Column, support: BasketSupport) -> Column:
    return (count / F.lit(float(support.n_baskets))).alias("support")


def _pair_counts(support: BasketSupport) -> DataFrame:
    """Counts of unordered item pairs (a < b).

    Equal baskets are merged first, so pairs are listed once per distinct basket.
    """
    patterns = support.baskets.groupBy("items").agg(F.count(F.lit(1)).alias("weight"))
    pairs = F.flatten(
        F.transform(
            "items",
            lambda a, i: F.transform(
                F.slice("items", i + 2, F.size("items")),
                lambda b: F.struct(a.alias("a"), b.alias("b")),
            ),
        )
    )
    return (
        patterns.select(F.explode(pairs).alias("p"), "weight")
        .groupBy("p.a", "p.b")
        .agg(F.sum("weight").alias("n"))
        .where(F.col("n") >= support.min_count)
    )


def pair_itemsets(support: BasketSupport) -> DataFrame:
    """Frequent single items and pairs."""
    n = F.col("n")
    pairs = _pair_counts(support).select(
        F.array("a", "b").alias("items"), n.alias("freq"), _share(n, support)
    )
    return item_support(support).unionByName(pairs)


def pair_rules(support: BasketSupport, min_confidence: float = CONFIDENCE) -> DataFrame:
    """One-item rules in both directions: support, confidence, lift."""
    total = F.lit(float(support.n_baskets))
    left = support.item_counts.select(F.col("item").alias("a"), F.col("n").alias("n_a"))
    right = support.item_counts.select(F.col("item").alias("b"), F.col("n").alias("n_b"))
    counted = _pair_counts(support).join(left, "a").join(right, "b")
    directed = counted.select(
        "n",
        F.explode(
            F.array(
                F.struct(
                    F.col("a").alias("antecedent"),
                    F.col("b").alias("consequent"),
                    F.col("n_a").alias("n_ante"),
                    F.col("n_b").alias("n_cons"),
                ),
                F.struct(
                    F.col("b").alias("antecedent"),
                    F.col("a").alias("consequent"),
                    F.col("n_b").alias("n_ante"),
                    F.col("n_a").alias("n_cons"),
                ),
            )
        ).alias("r"),
    )
    confidence = F.col("n") / F.col("r.n_ante")
    return directed.where(confidence >= min_confidence).select(
        "r.antecedent",
        "r.consequent",
        (F.col("n") / total).alias("support"),
        confidence.alias("confidence"),
        (confidence / (F.col("r.n_cons") / total)).alias("lift"),
    )


def frequent_itemsets(support: BasketSupport) -> DataFrame:
    """All itemsets of any size that reach the minimum support."""
    baskets_left = support.baskets.count()
    if baskets_left == 0:
        spark = support.baskets.sparkSession
        return spark.createDataFrame([], "items array<string>, freq long, support double")
    # The share is relative to the baskets that still hold a frequent item; half a
    # count below the limit keeps its rounding away from the limit itself.
    miner = FPGrowth(itemsCol="items", minSupport=(support.min_count - 0.5) / baskets_left)
    found = miner.fit(support.baskets).freqItemsets
    itemsets = found.select(
        F.sort_array("items").alias("items"), "freq", _share(F.col("freq"), support)
    )
    return materialise(itemsets, "itemsets")


def _held(rules: DataFrame, ante: DataFrame, min_confidence: float, label: str) -> DataFrame:
    """``rules`` (items, freq, ones, cons: positions of the consequent) that reach the confidence."""
    parted = rules.withColumn(
        "antecedents", F.filter("items", lambda _, i: ~F.array_contains("cons", i))
    )
    kept = parted.join(ante, "antecedents").where(F.col("freq") / F.col("n_ante") >= min_confidence)
    return materialise(kept, label)


def association_rules(
    itemsets: DataFrame, n_baskets: int, min_confidence: float = CONFIDENCE
) -> DataFrame:
    """Every split of every frequent itemset into antecedent and consequent.

    Includes consequents of several items, found level by level: a consequent that grows
    makes the antecedent smaller and more frequent, so the confidence can only fall, and
    a consequent is extended only while it holds, by items that hold on their own. The
    antecedent and consequent of a frequent set are frequent themselves, so both counts
    come from the same table by equi-joins on the sorted item arrays.
    """
    total = F.lit(float(n_baskets))
    ante = itemsets.select(F.col("items").alias("antecedents"), F.col("freq").alias("n_ante"))
    cons = itemsets.select(F.col("items").alias("consequents"), F.col("freq").alias("n_cons"))
    place = F.explode(F.sequence(F.lit(0), F.size("items") - 1))
    single = itemsets.where(F.size("items") >= 2).select("items", "freq", place.alias("at"))
    level = _held(single.withColumn("cons", F.array("at")), ante, min_confidence, "rules-1")
    ones = level.groupBy("items").agg(F.collect_list("at").alias("ones"))
    level = level.drop("at").join(ones, "items")
    columns = ["items", "freq", "n_ante", "antecedents", "cons"]
    levels = [level.select(*columns)]
    while not level.isEmpty():
        # The consequent's last position is its largest.
        more = F.filter("ones", lambda x: x > F.element_at("cons", -1))
        longer = (
            level.where(F.size("cons") < F.size("items") - 1)
            .withColumn("next", F.explode(more))
            .select("items", "freq", "ones", F.concat("cons", F.array("next")).alias("cons"))
        )
        level = _held(longer, ante, min_confidence, f"rules-{len(levels) + 1}")
        levels.append(level.select(*columns))
    kept = reduce(DataFrame.unionByName, levels).withColumn(
        "consequents", F.filter("items", lambda _, i: F.array_contains("cons", i))
    )
    confidence = F.col("freq") / F.col("n_ante")
    support = F.col("freq") / total
    p_ante, p_cons = F.col("n_ante") / total, F.col("n_cons") / total
    return kept.join(cons, "consequents").select(
        "antecedents",
        "consequents",
        support.alias("support"),
        confidence.alias("confidence"),
        (confidence / p_cons).alias("lift"),
        (support - p_ante * p_cons).alias("leverage"),
        F.when(confidence < 1, (1 - p_cons) / (1 - confidence))
        .otherwise(F.lit(float("inf")))
        .alias("conviction"),
    )


def rules_by_lift(rules: DataFrame, n: int = 25) -> DataFrame:
    names = [c for c in rules.columns if c.startswith(("antecedent", "consequent"))]
    return rules.orderBy(F.desc(F.round("lift", 9)), *names).limit(n)
