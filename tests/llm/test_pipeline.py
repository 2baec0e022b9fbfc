"""Stages of the corpus pipeline against plain Python."""

import random

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from tillwise.llm import near_texts  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, row string"


def docs(rows, pairs):
    return rows([(i, t, "en", "s", len(t or ""), "d", "r") for i, t in pairs], SCHEMA)


def grams(text):
    words = (text or "").lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def linked(a, b):
    return a == b or len(a & b) / max(1, len(a | b)) >= 0.8


def brute_kept(pairs):
    """Ids that stay: the smallest of each group of linked texts."""
    sets = [grams(t) for _, t in pairs]
    group = list(range(len(pairs)))
    for i in range(len(pairs)):
        for j in range(i):
            if linked(sets[i], sets[j]) and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    best = {}
    for (i, _), g in zip(pairs, group):
        best[g] = min(best.get(g, (True, 0)), (i is None, i or 0))
    return sorted(None if none else i for none, i in best.values())


def changed(rng, words, base, share):
    out = list(base)
    for k in rng.sample(range(len(out)), max(1, round(share * len(out)))):
        out[k] = rng.choice(words)
    return out


@pytest.mark.parametrize("shingles", [4e6, 300])
def test_near_copies_leave_and_clean_documents_stay(spark, rows, monkeypatch, shingles):
    monkeypatch.setattr(near_texts, "BLOCK_SHINGLES", shingles)
    rng = random.Random(8)
    words = [f"w{i}" for i in range(500)]
    texts = []
    for _ in range(25):
        base = [rng.choice(words) for _ in range(rng.randint(8, 200))]
        # From near copies well above 0.8 to texts that only share much.
        texts += [" ".join(changed(rng, words, base, share)) for share in (0.005, 0.01, 0.015, 0.02, 0.05, 0.1)]
    texts += ["", None, " \n", "One two", "one  TWO", "one two three", "a b c d e f g h", "a b c d e f g h i"]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    pairs = list(zip(ids, texts))
    got = corpus_pipeline.drop_near_duplicates(spark, docs(rows, pairs), "")
    assert got.columns == docs(rows, []).columns
    want = brute_kept(pairs)
    assert sorted(r.doc_id for r in got.collect()) == want
    assert 30 < len(want) < 130


def test_near_copies_ties_nulls_and_nothing(spark, rows):
    long = "a b c d e f g h i j k l m n o p q r s t u v w x y z"
    frame = docs(rows, [(5, "q r s"), (5, long), (None, long), (5, long.upper()), (None, long + " end"), (None, "x")])
    got = corpus_pipeline.drop_near_duplicates(spark, frame, "")
    assert sorted((r.doc_id or 0, r.text) for r in got.collect()) == [(0, "x"), (5, long.upper()), (5, "q r s")]
    assert corpus_pipeline.drop_near_duplicates(spark, frame.limit(0), "").count() == 0
