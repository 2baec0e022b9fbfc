"""The near-duplicate stage proposes by SimHash links; texts are moved once."""

import random

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from tillwise.llm import near_texts  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def jaccard(a, b):
    sets = [set(near_texts.shingles(near_texts.words_of(t.encode())).tolist()) for t in (a, b)]
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def bits(a, b):
    prints = [near_texts.simhash_of(near_texts.shingles(near_texts.words_of(t.encode()))) for t in (a, b)]
    return ((prints[0] ^ prints[1]) & (2**64 - 1)).bit_count()


def test_simhash_links_propose_near_copies(spark, rows, monkeypatch):
    # Without any candidate of MinHash.
    monkeypatch.setattr(near_texts, "_shared", lambda distinct: distinct.selectExpr("digest a", "digest b").limit(0))
    rng = random.Random(3)
    words = [f"w{i}" for i in range(900)]
    texts, gone = [], 0
    for i in range(30):
        base = [rng.choice(words) for _ in range(300)]
        near = list(base)
        near[rng.randrange(300)] = "other"
        texts += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(near))]
        linked = bits(texts[-1][1], texts[-2][1]) <= 4 and jaccard(texts[-1][1], texts[-2][1]) >= 0.8
        gone += linked
    frame = rows([(i, t, "en", "s", len(t)) for i, t in texts], SCHEMA)
    assert gone > 10
    assert corpus_pipeline.drop_near_duplicates(spark, frame, "").count() == 60 - gone


def test_linked_fingerprints_alone_drop_nothing(spark, rows, monkeypatch):
    # Every fingerprint is equal: all are one family, and the shingles decide.
    monkeypatch.setattr(near_texts, "simhash_of", lambda found: 7 if len(found) else None)
    frame = rows([(i, f"a{i} b{i} c{i} d{i} e{i} f{i}", "en", "s", 9) for i in range(20)], SCHEMA)
    assert corpus_pipeline.drop_near_duplicates(spark, frame, "").count() == 20
