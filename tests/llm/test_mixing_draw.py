"""The draw meets the target marginals also where cells are scarce."""

import random

import pytest

from tillwise.llm import mixing


def test_expected_draw_meets_the_targets(spark, rows):
    rng = random.Random(4)
    table = [(i, "a" if rng.random() < 0.9 else "b", "en" if rng.random() < 0.8 else "de", "x", 10)
             for i in range(400)]
    frame = rows(table, "doc_id long, source string, lang string, topic string, tokens long")
    targets = {"source": {"a": 0.8, "b": 0.2}, "lang": {"en": 0.7, "de": 0.3}}
    cells = mixing.weights(frame, targets, 0.6)
    expected = {}
    for r in cells.collect():
        assert r.probability <= 1
        for value in (r.source, r.lang):
            expected[value[1:]] = expected.get(value[1:], 0) + r.tokens * r.probability
    kept = expected["a"] + expected["b"]
    for shares in targets.values():
        assert {v: expected[v] / kept for v in shares} == pytest.approx(shares, abs=1e-3)
    # No more is given up than the scarcest value demands.
    admitted = min(sum(10 for t in table if t[k] == v) / 4000 / shares[v]
                   for k, shares in ((1, targets["source"]), (2, targets["lang"])) for v in shares)
    assert kept / 4000 >= min(0.6, admitted) * 0.95


def test_rows_without_an_id_are_drawn_by_their_text(spark, rows):
    frame = rows([(None, "s", "en", f"text {i}") for i in range(200)],
                 "doc_id long, source string, lang string, text string")
    counted = mixing.features(frame, "doc_id")
    mixed = mixing.mix(counted, mixing.weights(counted, {"lang": 1.0}, 0.5))
    assert "_text_hash" not in mixed.columns
    assert 60 < mixed.where("selected").count() < 140
