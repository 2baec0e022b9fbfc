"""Scores of factors in single precision first: same lists, and floors are kept to."""

import math

import numpy as np
import pyarrow as pa
import pytest

from tillwise.operators import factors


def tables(users, length, items, rated, kth):
    made = pa.table({
        "id": pa.array(np.arange(len(users))), "features": pa.array(users.tolist(), pa.list_(pa.float32())),
        "length": length, "rated": pa.array(rated, pa.list_(pa.int64())), "kth": pa.array(kth, pa.float64()),
    })
    cuts = np.array_split(np.argsort(-np.linalg.norm(items, axis=1), kind="stable"), 3)
    kind = pa.list_(pa.struct([("id", pa.int64()), ("features", pa.list_(pa.float32()))]))
    packed = [[{"id": int(i), "features": items[i].tolist()} for i in cut] for cut in cuts]
    longest = [float(np.linalg.norm(items[cut], axis=1).max()) for cut in cuts]
    return made, pa.table({"longest": longest, "items": pa.array(packed, kind)})


@pytest.mark.parametrize("tile", [5, 1_024])
@pytest.mark.parametrize("known", [False, True])
def test_lists_equal_all_scores_down_to_the_floor(monkeypatch, tile, known):
    monkeypatch.setattr(factors, "TILE", tile, raising=False)
    rng = np.random.default_rng(5)
    users = rng.normal(size=(40, 4)).astype(np.float32).astype(float)
    items = rng.normal(size=(90, 4)).astype(np.float32).astype(float)
    items[50:60] = items[10:20]  # equal scores
    users[3] = 0
    rated = [rng.choice(120, rng.integers(0, 60), replace=False).tolist() for _ in users]
    score = users @ items.T
    for u, mine in enumerate(rated):
        score[u, [m for m in mine if m < 90]] = -math.inf
    kth = [float(np.sort(row)[-2]) for row in score] if known else [None] * 40
    got = factors._products(*tables(users, np.linalg.norm(users, axis=1), items, rated, kth), 6).to_pydict()
    want = set()
    for u, row in enumerate(score):
        order = sorted((-round(s, 9), i) for i, s in enumerate(row) if s > -math.inf)[:6]
        want |= {(u, i) for s, i in order if not known or -s >= kth[u] - 1e-5}
    pairs = set(zip(got["user_id"], got["product_id"]))
    assert want <= pairs if known else want == pairs
    if known:
        # Nothing far below a floor is returned.
        assert all(score[u, i] >= kth[u] - 1e-4 for u, i in pairs)
    assert got["score"] == pytest.approx([score[p] for p in zip(got["user_id"], got["product_id"])], abs=1e-12)
