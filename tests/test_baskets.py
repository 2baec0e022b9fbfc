from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from tillwise.operators import baskets
from tillwise.sources import feeds

SUPPORT, CONFIDENCE = 0.15, 0.3


def lines():
    rng = np.random.default_rng(6)
    made = [(o, f"P{p}") for o in range(60) for p in rng.integers(0, 6, rng.integers(2, 9))]
    # One order with far more lines than any other, mostly of rare products.
    made += [(999, f"RARE{i}") for i in range(2000)] + [(999, "P1"), (999, "P2"), (999, "P1")]
    # Orders whose only products are infrequent still count as baskets.
    return made + [(2000, "ONCE"), (2001, " ")]


def brute():
    orders = {}
    for o, p in lines():
        if p.strip():
            orders.setdefault(o, set()).add(p)
    n = len(orders)
    counts = Counter(
        s
        for items in orders.values()
        for k in range(1, 7)
        for s in combinations(sorted(i for i in items if not i.startswith("RARE")), k)
    )
    return n, {s: c for s, c in counts.items() if c / n >= SUPPORT}


@pytest.fixture(scope="module")
def support(spark):
    df = spark.createDataFrame(lines(), feeds.ORDER_LINES).repartition(5)
    return baskets.basket_support(df, SUPPORT)


def test_itemsets(support):
    n, want = brute()
    assert support.n_baskets == n == 62
    got = {tuple(r["items"]): r.freq for r in baskets.frequent_itemsets(support).collect()}
    assert got == want and max(map(len, want)) >= 3


def test_hot_order_is_cut_to_frequent_items(support):
    sizes = {r.order_id: len(r["items"]) for r in support.baskets.collect()}
    assert sizes[999] == 2 and 2000 not in sizes


def test_pair_itemsets_and_rules(support):
    n, want = brute()
    got = {tuple(r["items"]): r.freq for r in baskets.pair_itemsets(support).collect()}
    assert got == {s: c for s, c in want.items() if len(s) <= 2}
    rules = {
        (r.antecedent, r.consequent): (r.support, r.confidence, r.lift)
        for r in baskets.pair_rules(support, CONFIDENCE).collect()
    }
    expected = {}
    for s, c in want.items():
        if len(s) == 2:
            for a, b in (s, s[::-1]):
                if c / want[(a,)] >= CONFIDENCE:
                    conf = c / want[(a,)]
                    expected[(a, b)] = (c / n, conf, conf / (want[(b,)] / n))
    assert rules.keys() == expected.keys() and rules
    for key in rules:
        assert rules[key] == pytest.approx(expected[key])


def test_general_rules(support):
    n, want = brute()
    found = baskets.association_rules(baskets.frequent_itemsets(support), n, CONFIDENCE)
    got = {(tuple(r.antecedents), tuple(r.consequents)): r for r in found.collect()}
    expected = {}
    for s, c in want.items():
        for k in range(1, len(s)):
            for a in combinations(s, k):
                b = tuple(i for i in s if i not in a)
                if c / want[a] >= CONFIDENCE:
                    expected[(a, b)] = (c / n, c / want[a], c / want[a] / (want[b] / n))
    assert got.keys() == expected.keys()
    assert any(len(b) > 1 for _, b in got)
    for key, r in got.items():
        assert (r.support, r.confidence, r.lift) == pytest.approx(expected[key])
    top = baskets.rules_by_lift(found, 5).collect()
    assert [r.lift for r in top] == sorted((r.lift for r in got.values()), reverse=True)[:5]


def test_consequents_grow_only_while_they_hold(spark, monkeypatch):
    """A set of twenty items costs its twenty splits, not two to the twentieth."""
    items = [f"i{k:02d}" for k in range(20)]
    sets = [(items, 10)] + [(items[:k] + items[k + 1 :], 100 if k else 12) for k in range(20)]
    sets += [([i], 500) for i in items]
    frame = spark.createDataFrame(sets, "items array<string>, freq long")
    tried = []
    original = baskets.materialise

    def spy(df, label):
        made = original(df, label)
        tried.append(made.count())
        return made

    monkeypatch.setattr(baskets, "materialise", spy)
    found = baskets.association_rules(frame, 1000, 0.5).collect()
    assert [(r.consequents, round(r.confidence, 3)) for r in found] == [(["i00"], 0.833)]
    assert tried == [1, 0]


def test_nothing_frequent(spark):
    df = spark.createDataFrame([(i, f"X{i}") for i in range(10)], feeds.ORDER_LINES)
    support = baskets.basket_support(df, 0.5)
    assert baskets.frequent_itemsets(support).count() == 0
    assert baskets.pair_rules(support).count() == 0
    assert baskets.association_rules(baskets.frequent_itemsets(support), 10).count() == 0


def test_min_count_matches_share():
    for n in (7, 100, 14_724, 333):
        for share in (0.006, 0.012, 0.1, 1 / 3, 0.5):
            c = baskets._min_count(share, n)
            assert c / n >= share and (c == 1 or (c - 1) / n < share)


def test_baskets_drop_repeats(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b")], feeds.ORDER_LINES)
    assert baskets.baskets(df).first()["items"] == ["a", "b"]
