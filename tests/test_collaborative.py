import numpy as np
import pytest

from tillwise.operators import collaborative as cf
from tillwise.operators import factors

K_NEAR = 5


def ratings_rows(n_users=80, n_products=40, popular=2, seed=7):
    """Two products hold a large part of all ratings, some users rate nothing else."""
    rng = np.random.default_rng(seed)
    rows = []
    for u in range(n_users):
        for p in range(popular):
            rows.append((u, p, int(rng.integers(1, 6))))
        if u % 3:
            for p in rng.choice(np.arange(popular, n_products), 6, replace=False):
                rows.append((u, int(p), int(rng.integers(1, 6))))
    rows.append((n_users, 5, 3))  # a single rating: no signal
    return rows


def dense(rows):
    users = sorted({r[0] for r in rows})
    products = sorted({r[1] for r in rows})
    total, count = (np.zeros((len(users), len(products))) for _ in range(2))
    for u, p, r in rows:
        total[users.index(u), products.index(p)] += r
        count[users.index(u), products.index(p)] += 1
    rated = count > 0
    mean = np.divide(total, count, out=np.zeros_like(total), where=rated)
    user_mean = mean.sum(1, keepdims=True) / rated.sum(1, keepdims=True)
    centred = np.where(rated, mean - user_mean, 0)
    centred[np.abs(centred) < 1e-12] = 0
    norm = np.linalg.norm(centred, axis=1, keepdims=True)
    unit = np.divide(centred, norm, out=np.zeros_like(centred), where=norm > 0)
    sim = unit @ unit.T
    np.fill_diagonal(sim, 0)
    return users, products, centred, sim


def near_lists(users, sim, k):
    out = {}
    for i, u in enumerate(users):
        order = sorted(
            (v for v in range(len(users)) if round(sim[i, v], 9) > 0),
            key=lambda v: (-round(sim[i, v], 9), users[v]),
        )
        out[u] = [users[v] for v in order[:k]]
    return out


@pytest.fixture(scope="module")
def centred(spark):
    df = spark.createDataFrame(ratings_rows(), "user_id long, product_id long, rating int")
    return cf.centred_ratings(df.repartition(5)).cache()


def lists(df):
    got = {}
    for r in df.orderBy("user_id", "rank").collect():
        got.setdefault(r.user_id, []).append(r.neighbor_id)
    return got


@pytest.mark.parametrize("segment, work", [(4096, 500_000), (30, 4000), (12, 900), (5, 900), (1, 50)])
def test_neighbors_match_dense_cosine(centred, segment, work):
    """Lists read whole, in part, or one rater at a time give the same neighbours."""
    users, _, _, sim = dense(ratings_rows())
    want = {u: v for u, v in near_lists(users, sim, K_NEAR).items() if v}
    found = cf.neighbors(cf.unit_ratings(centred), K_NEAR, segment, work)
    assert lists(found) == want
    for r in found.collect():
        assert r.sim == pytest.approx(sim[users.index(r.user_id), users.index(r.neighbor_id)])


def test_neighbors_of_some_users(spark, centred):
    unit = cf.unit_ratings(centred)
    users = spark.createDataFrame([(3,), (3,), (40,), (999,)], "user_id long")
    every = lists(cf.neighbors(unit, K_NEAR))
    for segment in (4096, 6):
        some = lists(cf.neighbors(unit, K_NEAR, segment, users=users))
        assert some == {u: every[u] for u in (3, 40)}


def twins_rows():
    """Popular products rated by all; most users fall into a few equal vectors."""
    rows = []
    for u in range(90):
        taste = [(5, 1, 3), (1, 5, 3), (5, 5, 1), (2, 4, 3)][u % 4]
        rows += [(u, p, r) for p, r in enumerate(taste)]
        if u % 9 == 0:
            rows += [(u, 10 + u % 7, 5), (u, 20 + u % 5, 1)]
    return rows


@pytest.mark.parametrize("segment", [4096, 8, 1])
def test_equal_vectors_are_one_profile(spark, segment):
    df = spark.createDataFrame(twins_rows(), "user_id long, product_id long, rating int")
    users, _, _, sim = dense(twins_rows())
    want = {u: v for u, v in near_lists(users, sim, K_NEAR).items() if v}
    assert lists(cf.neighbors(cf.unit_ratings(cf.centred_ratings(df)), K_NEAR, segment)) == want


def test_long_lists_are_not_read_to_the_end(spark, monkeypatch):
    """Raters of a popular product whose residual cannot reach the limit are not proposed."""
    rng = np.random.default_rng(2)
    rows = [(u, 0, int(rng.integers(1, 6))) for u in range(400)]
    for u in range(400):
        # Friends share four rare products with like ratings, so limits are high.
        rows += [(u, 1 + 4 * (u // 8) + j, 5 if (u // 8 + j) % 2 else 1) for j in range(4)]
    df = cf.centred_ratings(spark.createDataFrame(rows, "user_id long, product_id long, rating int"))
    read = []
    keep = cf._searched

    def spy(asked, profiles, segments, k):
        found = keep(asked, profiles, segments, k)
        read.append(segments.where("not first").count())
        return found

    monkeypatch.setattr(cf, "_searched", spy)
    proposed = []
    original = cf.materialise

    def count(frame, label):
        made = original(frame, label)
        if label == "cf-found":
            proposed.append(made.where("least is not null and other is not null").count())
        return made

    monkeypatch.setattr(cf, "materialise", count)
    users, _, _, sim = dense(rows)
    want = {u: v for u, v in near_lists(users, sim, 4).items() if v}
    assert lists(cf.neighbors(cf.unit_ratings(df), 4, 16)) == want
    assert read[0] >= 10 and proposed[0] < 400 * 400 / 8


@pytest.mark.parametrize("k", [3, 39, 60])
def test_recommendations_match_dense(spark, centred, k):
    users, products, matrix, sim = dense(ratings_rows())
    near = cf.neighbors(cf.unit_ratings(centred), K_NEAR)
    got = {}
    for r in cf.recommend(near, centred, k).orderBy("user_id", "rank").collect():
        got.setdefault(r.user_id, []).append((r.product_id, round(r.score, 6)))
    lists_ = near_lists(users, sim, K_NEAR)
    for i, u in enumerate(users):
        scores = np.zeros(len(products))
        for v in lists_[u]:
            scores += sim[i, users.index(v)] * matrix[users.index(v)]
        free = [j for j in range(len(products)) if matrix[i, j] == 0]
        order = sorted(free, key=lambda j: (-(round(scores[j], 9) + 0.0), products[j]))[:k]
        assert [p for p, _ in got[u]] == [products[j] for j in order], u
        assert [s for _, s in got[u]] == pytest.approx([scores[j] for j in order], abs=1e-6)


def test_without_padding_only_reached_products(centred):
    near = cf.neighbors(cf.unit_ratings(centred), K_NEAR)
    bare = cf.recommend(near, centred, 60, pad=False)
    assert bare.where("round(score, 9) = 0").count() == 0
    assert bare.where("user_id = 80").count() == 0


def test_rating_at_the_mean_counts_as_unrated(spark):
    rows = [(1, 1, 3), (1, 2, 3), (2, 1, 1), (2, 2, 5)]
    df = cf.centred_ratings(spark.createDataFrame(rows, "user_id long, product_id long, rating int"))
    near = cf.neighbors(cf.unit_ratings(df))
    assert near.count() == 0
    got = [(r.user_id, r.product_id) for r in cf.recommend(near, df, 2).collect()]
    assert sorted(got) == [(1, 1), (1, 2)]
    assert [(r.user_id, r.product_id) for r in cf.own_top_items(df).collect()] == [(2, 2)]


def test_first_users(spark):
    df = spark.createDataFrame([(u, 1, 1.0) for u in (5, 3, 9)], "user_id long, product_id long, score double")
    assert sorted(r.user_id for r in cf.first_users(df, 2).collect()) == [3, 5]


def test_factor_model(spark):
    df = spark.createDataFrame(ratings_rows(), "user_id long, product_id long, rating int")
    model = cf.factor_model(df, rank=4, iterations=4)
    scored = model.transform(cf.mean_ratings(df))
    assert scored.where("prediction is null").count() == 0 and scored.count() > 0


def test_blocks_of_the_factorisation_grow_with_the_ratings(spark, monkeypatch):
    df = spark.createDataFrame(ratings_rows(), "user_id long, product_id long, rating int")
    monkeypatch.setattr(cf, "FACTOR_BLOCK", 25, raising=False)
    model = cf.factor_model(df, rank=4, iterations=2)
    blocks = -(-df.count() // 25)
    assert blocks > 10
    assert model.userFactors.rdd.getNumPartitions() == model.itemFactors.rdd.getNumPartitions() == blocks
    assert cf.mean_ratings(df).count() == model.transform(cf.mean_ratings(df)).where("prediction is not null").count()


@pytest.mark.parametrize("pad", [True, False])
def test_requested_users_alone_have_the_same_lists(spark, centred, pad):
    near = cf.neighbors(cf.unit_ratings(centred), K_NEAR)
    users = spark.createDataFrame([(3,), (4,), (80,), (999,), (4,)], "user_id long")
    every = cf.for_users(cf.recommend(near, centred, 4, pad), users)
    some = cf.recommend(near, centred, 4, pad, users)
    assert sorted(map(tuple, some.collect())) == sorted(map(tuple, every.collect()))


def brute_products(users, items, rated, k):
    out = []
    for u, x in users:
        scored = [(-round(float(np.dot(np.float32(x).astype(float), np.float32(y).astype(float))), 9), i)
                  for i, y in items if (u, i) not in rated]
        out += [(u, r, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("item_block, user_block", [(4096, 2048), (16, 7), (5, 100), (1, 3)])
def test_factor_lists_equal_brute_force(spark, item_block, user_block):
    """Blocks in order of length, rated items left out, ties, null vectors and short lists."""
    rng = np.random.default_rng(4)
    users = [(u, rng.normal(size=3).round(2).tolist()) for u in range(30)] + [(50, [0.0, 0.0, 0.0])]
    items = [(i, (rng.normal(size=3) * rng.pareto(1.5)).round(1).tolist()) for i in range(70)]
    items += [(200 + i, items[i][1]) for i in range(5)]
    rated = {(u, int(i)) for u, _ in users for i in rng.choice(70, 20)} | {(7, i) for i, _ in items[3:]}
    factor = "id int, features array<float>"
    lists = factors.factor_recommendations(
        spark.createDataFrame(users, factor), spark.createDataFrame(items, factor).repartition(3),
        spark.createDataFrame([*rated, (999, 1), (1, 999), next(iter(rated))], "user_id long, product_id long"),
        6, item_block, user_block,
    )
    got = sorted((r.user_id, r.rank, r.product_id, round(r.score, 9) + 0.0) for r in lists.collect())
    want = brute_products(users, items, rated, 6)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in want])


def test_users_stop_at_the_blocks_that_matter(spark, monkeypatch):
    """With falling lengths, no user is compared with the short items."""
    compared = []
    original = factors.materialise

    def spy(frame, label):
        made = original(frame, label)
        if label == "als-open":
            compared.append(made.count())
        return made

    monkeypatch.setattr(factors, "materialise", spy)
    items = [(i, [100.0 / (1 + i) ** 2, 0.0]) for i in range(200)]
    users = [(u, [1.0 + u, 0.0]) for u in range(40)]
    factor, none = "id int, features array<float>", "user_id long, product_id long"
    lists = factors.factor_recommendations(
        spark.createDataFrame(users, factor), spark.createDataFrame(items, factor),
        spark.createDataFrame([], none), 5, 10, 16)
    assert lists.count() == 200 and compared == [0]
    none_left = factors.factor_recommendations(
        spark.createDataFrame(users, factor), spark.createDataFrame([], factor), spark.createDataFrame([], none))
    assert none_left.count() == 0


def test_open_users_alone_go_to_further_rounds(spark, monkeypatch):
    """They are dealt to as few blocks as they fill; lists that are settled are not written again."""
    lists, asked = [], []
    original, dealt = factors.materialise, factors._user_blocks

    def spy(frame, label):
        made = original(frame, label)
        if label == "als-best":
            lists.append({r.user_id for r in made.collect()})
        return made

    def blocks(n_users, user_block):
        asked.append((n_users, dealt(n_users, user_block)))
        return asked[-1][1]

    monkeypatch.setattr(factors, "materialise", spy)
    monkeypatch.setattr(factors, "_user_blocks", blocks)
    monkeypatch.setattr(factors, "HELD_BLOCKS", 2)
    # Users of the second direction find their items behind those of the first.
    items = [(i, [200.0 - i, 0.0]) for i in range(40)] + [(100 + i, [0.0, 50.0 - i]) for i in range(40)]
    users = [(u, [1.0 + u, 0.0]) for u in range(40)] + [(90 + u, [0.0, 1.0 + u]) for u in range(3)]
    factor = "id int, features array<float>"
    rated = {(0, 1), (0, 2), (91, 100)}
    got = factors.factor_recommendations(
        spark.createDataFrame(users, factor), spark.createDataFrame(items, factor),
        spark.createDataFrame([*rated], "user_id long, product_id long"), 4, 8, 16)
    got = sorted((r.user_id, r.rank, r.product_id, round(r.score, 9) + 0.0) for r in got.collect())
    assert got == brute_products(users, items, rated, 4)
    assert asked[0] == (43, 3) and asked[-1] == (3, 1) and len(asked) > 2
    assert lists[-1] == {90, 91, 92}


def test_fold_in_solves_the_least_squares(spark):
    rng = np.random.default_rng(9)
    items = [(i, rng.normal(size=3).tolist()) for i in range(20)]
    rows = [(u, int(i), float(rng.integers(1, 6))) for u in (1, 2) for i in rng.choice(20, 8, replace=False)]
    rows += [(1, 999, 5.0), (3, 999, 5.0)]
    got = {r.id: r.features for r in factors.fold_in(
        spark.createDataFrame(items, "id int, features array<float>"),
        spark.createDataFrame(rows, "user_id long, product_id long, rating double"), 0.1).collect()}
    assert sorted(got) == [1, 2]
    for u in got:
        mine = [(i, r) for v, i, r in rows if v == u and i < 20]
        v = np.array([np.float32(items[i][1]) for i, _ in mine], float)
        want = np.linalg.solve(v.T @ v + 0.1 * len(mine) * np.eye(3), v.T @ np.array([r for _, r in mine]))
        assert got[u] == pytest.approx(want, abs=1e-5)
