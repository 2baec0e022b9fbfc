import numpy as np
from pyspark.sql import functions as F

from tillwise.functions import scan
from tillwise.operators import collaborative as cf


def test_blocks_follow_the_order_and_hold_their_work(spark):
    rows = spark.createDataFrame([(i, (i * 37) % 500, 1 + i % 7) for i in range(500)], "id long, at long, w long")
    cut = scan.in_blocks(rows.repartition(7), ["at"], "w", 50, 1, 1)
    assert cut.columns == ["id", "at", "block"] and cut.count() == 500
    got = cut.join(rows.select("id", "w"), "id").groupBy("block").agg(
        F.min("at").alias("low"), F.max("at").alias("high"), F.sum("w").alias("work")).orderBy("low").collect()
    assert all(a.high < b.low for a, b in zip(got, got[1:]))
    assert all(r.work <= 50 + 7 for r in got) and len(got) > 30
    assert scan.in_blocks(rows.limit(0), ["at"], "w", 50, 1, 1).count() == 0


def test_users_with_common_products_share_blocks(spark, monkeypatch):
    """A product's raters go to the blocks of the few users that rated it, not to one a rater."""
    rng = np.random.default_rng(3)
    rows = [
        (u, g * 10 + p, float(rng.integers(1, 6)))
        for g in range(20) for u in range(g, 240, 20) for p in range(6)
    ]
    ratings = spark.createDataFrame(rows, "user_id long, product_id long, rating double")
    unit = cf.unit_ratings(cf.centred_ratings(ratings))
    needed = []
    original = scan.materialise

    def spy(frame, label):
        made = original(frame, label)
        if label == "blocks":
            needed.append(made.select("block", F.explode("products")).distinct().count())
        return made

    monkeypatch.setattr(scan, "materialise", spy)
    small = cf.neighbors(unit, 5, work=900).orderBy("user_id", "rank").collect()
    # 120 products; a group of users may be cut where blocks end.
    assert len(needed) == 1 and needed[0] <= 360
    whole = cf.neighbors(unit, 5).orderBy("user_id", "rank").collect()
    assert [r[:2] for r in small] == [r[:2] for r in whole]
