"""Counting items does not build the baskets."""

from tillwise.operators import baskets


def test_item_support_writes_no_baskets(spark, monkeypatch):
    written = []
    write = baskets.materialise
    monkeypatch.setattr(baskets, "materialise", lambda df, label: written.append(label) or write(df, label))
    rows = [(1, "a"), (1, "b"), (1, "b"), (2, "a"), (3, " "), (3, "c"), (4, "a"), (4, "b")]
    lines = spark.createDataFrame(rows, "order_id long, product_id string")
    support = baskets.basket_support(lines, 0.5)
    found = {r["items"][0]: (r["freq"], r["support"]) for r in baskets.item_support(support).collect()}
    assert found == {"a": (3, 0.75), "b": (2, 0.5)}
    assert written == ["basket-items"]
    assert sorted(r["items"] for r in support.baskets.collect()) == [["a"], ["a", "b"], ["a", "b"]]
    assert support.baskets is support.baskets and written == ["basket-items", "baskets"]
