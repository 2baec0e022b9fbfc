"""Exact and approximate vector search against brute force, and rows that take no part."""

import numpy as np
import pytest

from tillwise.llm import ann_graph, knn_join

SCHEMA = "vec_id long, embedding array<float>, rank int, cell string"


def table(rows, vectors):
    return rows([(i, v, 7, "x") for i, v in vectors], SCHEMA)


def products(vectors, queries, k):
    """Brute force over usable vectors, padding the shorter with zeros."""
    live = [(i, [float(x) for x in v]) for i, v in vectors
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = set()
    for q, a in {(i, tuple(v)) for i, v in live if i in queries}:
        scored = sorted(
            {(-sum(int(np.floor(256 * np.float64(x))) * int(np.floor(256 * np.float64(y)))
                   for x, y in zip(a, b)), i) for i, b in live if i != q})
        want |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])}
    return want


def sample(count, width, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, width))
    out = (centres[rng.integers(6, size=count)] + rng.normal(size=(count, width)) * 0.3)
    return [(i, np.float32(v).tolist()) for i, v in enumerate(out)]


def test_topk_equals_brute_force(spark, rows, monkeypatch):
    monkeypatch.setattr(knn_join, "CELL_ROWS", 20)
    monkeypatch.setattr(knn_join, "QUERY_BLOCK", 16)
    monkeypatch.setattr(knn_join, "DATA_BLOCK", 64)
    vectors = sample(400, 4, 1) + [(400 + i, [0.5, 0.5, 0.5, 0.5]) for i in range(120)]
    vectors += [(900, None), (901, [1.0, None, 0.0, 0.0]), (902, [float("nan")] * 4),
                (903, [float("inf"), 0.0, 0.0, 0.0]), (904, []), (905, [1.0]), (None, [1.0] * 4)]
    frame = table(rows, vectors)
    got = knn_join.top_k(frame, frame.where("vec_id % 5 = 0 or vec_id >= 900"))
    queries = {i for i, _ in vectors if i is not None and (i % 5 == 0 or i >= 900)}
    assert {tuple(r) for r in got.collect()} == products(vectors, queries, 5)


def test_groups_prune_what_is_far(spark, monkeypatch):
    """Well separated cells are not sent to each other's groups."""
    monkeypatch.setattr(knn_join, "QUERY_BLOCK", 1)
    rng = np.random.default_rng(0)
    corners = np.array([[100.0, 0, 0], [0, 100, 0], [0, 0, 100]])
    between = np.linalg.norm(corners[:, None] - corners[None], axis=2)
    cells = [(int(i), float(d)) for i in range(3) for d in rng.random(20)]
    frame = spark.createDataFrame(cells, "cell int, dist double")
    groups, limits = knn_join.plan_groups(frame, frame, between, 6)
    assert len(groups) == 3 and len(limits) == 3


def test_topk_of_few_and_none(spark, rows):
    assert knn_join.top_k(table(rows, []), table(rows, [])).count() == 0
    two = table(rows, [(0, [1.0, 2.0]), (3, [1.0, 2.0]), (3, [1.0, 2.0])])
    got = knn_join.top_k(two, two.where("vec_id = 0")).collect()
    assert [tuple(r) for r in got] == [(0, 1, 3, 256 * 256 * 5)]


def test_huge_components_stay_exact(spark, rows):
    big = table(rows, [(0, [3e9, 1.0]), (1, [-3e9, 1.0]), (2, [1e30, 0.0])])
    got = {tuple(r) for r in knn_join.top_k(big, big.where("vec_id = 0")).collect()}
    assert (0, 1, 2, 2**63 - 1) in got and (0, 2, 1, -(2**63)) in got


def products_by_id(vectors, asked, k):
    """Brute force, each query row on its own: the best score of every other id."""
    out = []
    for q, a in sorted({(i, tuple(v)) for i, v in vectors if i in asked}):
        best = {}
        for i, b in vectors:
            score = sum(int(np.floor(256 * np.float64(x))) * int(np.floor(256 * np.float64(y))) for x, y in zip(a, b))
            if i != q:
                best[i] = max(score, best.get(i, score))
        ranked = sorted((-s, i) for i, s in best.items())[:k]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(ranked, 1)]
    return sorted(out)


def test_topk_with_repeated_ids(spark, rows, monkeypatch):
    """Vectors that share an id neither hide others nor take their places."""
    monkeypatch.setattr(knn_join, "CELL_ROWS", 8)
    monkeypatch.setattr(knn_join, "QUERY_BLOCK", 4)
    monkeypatch.setattr(knn_join, "DATA_BLOCK", 16)
    vectors = [(50, v) for _, v in sample(40, 3, 5)] + [(i, v) for i, v in sample(30, 3, 6)]
    vectors += [(i % 7, v) for i, v in sample(60, 3, 7)] + [(100 + i, [1.0, 0.5, 0.25]) for i in range(9)]
    frame = table(rows, vectors)
    got = knn_join.top_k(frame, frame.where("vec_id in (0, 50, 100, 11)"))
    assert sorted(map(tuple, got.collect())) == products_by_id(vectors, {0, 50, 100, 11}, 5)
    few = [(50, [1.0 + i, 2.0]) for i in range(6)] + [(i, [0.5, i / 8]) for i in range(8)]
    got = knn_join.top_k(table(rows, few), table(rows, few).where("vec_id = 50"))
    assert sorted(map(tuple, got.collect())) == products_by_id(few, {50}, 5)


def test_graph_search_with_repeated_ids(spark, rows):
    few = [(50, [1.0 + i, 2.0]) for i in range(6)] + [(i, [0.5, (i + 1) / 8]) for i in range(8)]
    few += [(3, [4.0, 0.1]), (3, [0.5, 9.0])]
    got = ann_graph.nearest(table(rows, few), table(rows, few).where("vec_id = 50")).collect()
    want = []
    for _, a in few[:6]:
        best = {}
        for i, b in few[6:]:
            score = float(np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b))
            best[i] = max(score, best.get(i, -2.0))
        want += [(r, i, round(-s, 9)) for r, (s, i) in enumerate(sorted((-s, i) for i, s in best.items())[:5], 1)]
    assert sorted((r.rank, r.vec_id, round(r.score, 9)) for r in got) == sorted(want)


@pytest.mark.parametrize("leaf", [64, 2048])
def test_graph_search_recall(spark, rows, monkeypatch, leaf):
    monkeypatch.setattr(ann_graph, "LEAF", leaf)
    vectors = sample(900, 24, 3) + [(2000 + i, [0.1] * 24) for i in range(200)]
    vectors += [(5000, [0.0] * 24), (5001, None), (5002, [float("nan")] * 24), (None, [1.0] * 24)]
    frame = table(rows, vectors)
    got = ann_graph.nearest(frame, frame.where("vec_id % 10 = 0")).collect()
    live = [(i, np.array(v, dtype=np.float64)) for i, v in vectors if i is not None and i < 5000]
    ids = np.array([i for i, _ in live])
    unit = np.stack([v / np.linalg.norm(v) for _, v in live])
    hits, asked = 0, [i for i in ids.tolist() if i % 10 == 0]
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert sorted(by) == sorted(asked)
    for q in asked:
        s = unit @ unit[np.flatnonzero(ids == q)[0]]
        order = [j for j in np.lexsort((ids, -s.round(12))) if ids[j] != q][:5]
        found = sorted(by[q])
        assert [r for r, _, _ in found] == [1, 2, 3, 4, 5]
        assert all(abs(score - s[np.flatnonzero(ids == v)[0]]) < 1e-12 for _, v, score in found)
        hits += len({int(ids[j]) for j in order} & {v for _, v, _ in found})
    assert hits / (5 * len(asked)) >= 0.95
    # Equal vectors: ties go to the smallest ids.
    assert [v for _, v, _ in sorted(by[2000])] == [2001, 2002, 2003, 2004, 2005]


def test_graph_search_of_few_and_none(spark, rows):
    assert ann_graph.nearest(table(rows, []), table(rows, [])).count() == 0
    two = table(rows, [(0, [1.0, 0.0]), (4, [2.0, 0.0]), (4, [2.0, 0.0])])
    got = ann_graph.nearest(two, two.where("vec_id = 0")).collect()
    assert [tuple(r) for r in got] == [(0, 1, 4, 1.0)]
