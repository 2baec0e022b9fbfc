"""Hypothetical transactions evaluated against a summary of their users' histories.

A scenario asks what the features of one more transaction would be, one minute after the
user's last. Copying a history per scenario would cost scenarios x history rows. Instead
histories are kept as an order summary: distinct amounts with their counts, sorted, in
blocks of nearly equal amounts; location counts; devices; the last time. New rows are
merged into it, and scenarios read it alone. Inserting one amount x into a sorted list
moves rank j to clamp(x, list[j-1], list[j]), so a few ranks give the same features as the
copied histories.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwise.operators.anomaly import Forest, anomaly_score
from tillwise.operators.features import QUANTILE_DIGITS, SPEND_QUANTILE
from tillwise.operators.models import Classifier
from tillwise.workspace import materialise

_BY = ["user_id"]
#: A block holds amounts within this part of a power of two.
BLOCKS_PER_OCTAVE = 256
_ZERO_BLOCK = -(2**30)


def _block(amount: Column) -> Column:
    """A block number that never falls as the amount grows, whatever the rounding of log2."""
    octave = F.floor(F.log2(amount))
    part = F.floor((amount / F.pow(F.lit(2.0), octave) - 1) * BLOCKS_PER_OCTAVE)
    return F.when(amount > 0, octave * BLOCKS_PER_OCTAVE + part).otherwise(_ZERO_BLOCK).cast("long")


def _in_blocks(counts: DataFrame) -> DataFrame:
    """``user_id, block, n, items`` from ``user_id, amount, n``; amounts may repeat."""
    summed = counts.groupBy("user_id", "amount").agg(F.sum("n").alias("n"))
    return summed.groupBy("user_id", _block(F.col("amount")).alias("block")).agg(
        F.sum("n").alias("n"), F.sort_array(F.collect_list(F.struct("amount", "n"))).alias("items")
    )


@dataclass(frozen=True)
class OrderSummary:
    """What scenarios need of histories.

    ``amounts``: user_id, block, n, items (sorted distinct amounts without sign, with
    counts); ``places``: user_id, location_id, n; ``devices``: user_id, device_id;
    ``last``: user_id, last_time. Users with missing ids are left out: no scenario has them.
    """

    amounts: DataFrame
    places: DataFrame
    devices: DataFrame
    last: DataFrame

    @classmethod
    def of(cls, history: DataFrame) -> OrderSummary:
        rows = history.where(F.col("user_id").isNotNull())
        amount = F.abs(F.col("amount").cast("double"))
        known = rows.select("user_id", amount.alias("amount"), F.lit(1).cast("long").alias("n"))
        known = known.where(F.col("amount").isNotNull() & ~F.isnan("amount"))
        return cls(
            _in_blocks(known.groupBy("user_id", "amount").agg(F.sum("n").alias("n"))),
            location_counts(rows),
            rows.select("user_id", "device_id").distinct(),
            rows.groupBy("user_id").agg(F.max("timestamp").alias("last_time")),
        )

    def merge(self, history: DataFrame) -> OrderSummary:
        """The summary with new rows added; the old rows are not needed again."""
        new = OrderSummary.of(history)
        counts = self.amounts.unionByName(new.amounts).select("user_id", F.explode("items").alias("i"))
        return OrderSummary(
            _in_blocks(counts.select("user_id", "i.amount", "i.n")),
            self.places.unionByName(new.places).groupBy("user_id", "location_id").agg(F.sum("n").alias("n")),
            self.devices.unionByName(new.devices).distinct(),
            self.last.unionByName(new.last).groupBy("user_id").agg(F.max("last_time").alias("last_time")),
        )

    def of_users(self, users: DataFrame) -> OrderSummary:
        """The part that belongs to the users of a frame."""
        ids = users.select("user_id").distinct()
        return OrderSummary(*[
            getattr(self, f.name).join(ids, _BY, "left_semi") for f in fields(self)
        ])

    def write(self, path: str) -> OrderSummary:
        """Written below ``path``, one folder a part; returns the written summary."""
        for f in fields(self):
            getattr(self, f.name).write.mode("overwrite").parquet(f"{path}/{f.name}")
        return OrderSummary.read(self.last.sparkSession, path)

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> OrderSummary:
        return cls(*[spark.read.parquet(f"{path}/{f.name}") for f in fields(cls)])


def _ranks(amounts: DataFrame, probs: dict[str, float]) -> DataFrame:
    """Per user, structs ``n, rank, prev, here, next`` of the sorted amounts at each quantile.

    Blocks are counted first; only those with a wanted rank are looked into.
    """
    along = Window.partitionBy("user_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("user_id")
    placed = amounts.withColumns({
        "before": F.coalesce(F.sum("n").over(along), F.lit(0)), "total": F.sum("n").over(whole)})

    def value_at(position: Column) -> Column:
        """The amount at a position of the user's order, null where this block has not got it."""
        wanted = position - F.col("before")
        start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("double").alias("v"))
        walked = F.aggregate("items", start, lambda acc, i: F.struct(
            (acc["seen"] + i["n"]).alias("seen"),
            F.when((acc["seen"] <= wanted) & (wanted < acc["seen"] + i["n"]), i["amount"])
            .otherwise(acc["v"]).alias("v"),
        ))
        here = (wanted >= 0) & (wanted < F.col("n"))
        return F.when(here, walked["v"])

    made = []
    for name, prob in probs.items():
        rank = F.floor(F.lit(prob) * F.col("total"))
        around = [
            F.max(value_at(rank + o)).alias(c) for o, c in ((-1, "prev"), (0, "here"), (1, "next"))
        ]
        made.append(F.struct(F.max("total").alias("n"), F.max(rank).alias("rank"), *around).alias(name))
    return placed.groupBy("user_id").agg(*made)


def history_summary(summary: OrderSummary) -> DataFrame:
    """One row per user: last time, amount ranks for p95 and median, top location."""
    places = summary.places.groupBy("user_id").agg(
        F.max(F.struct("n", (-F.col("location_id")).alias("minus_location"))).alias("top"),
    )
    ranks = _ranks(summary.amounts, {"spend": SPEND_QUANTILE, "middle": 0.5})
    return summary.last.join(ranks, _BY, "left").join(places, _BY, "left")


def location_counts(history: DataFrame) -> DataFrame:
    return (
        history.where(F.col("location_id").isNotNull())
        .groupBy("user_id", "location_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _with_inserted(ranks: str, x: Column, prob: float) -> Column:
    """The quantile of a history with x inserted."""
    low, here, high = (F.col(f"{ranks}.{c}") for c in ("prev", "here", "next"))

    def clamp(below: Column, above: Column) -> Column:
        # A neighbour outside the list does not bound x.
        raised = F.greatest(x, below)
        return F.least(raised, above)

    first, second = clamp(low, here), clamp(here, high)
    position = F.lit(prob) * F.col(f"{ranks}.n")
    fraction = position - F.floor(position)
    return first + (F.coalesce(second, first) - first) * fraction


def whatif_features(scenarios: DataFrame, history: DataFrame | OrderSummary) -> DataFrame:
    """Features of each scenario's transaction; users without history drop out.

    The history is cleaned per user together with the new row, as if that user's rows were
    the whole feed. With an :class:`OrderSummary` no history is read at all; with a history
    its summary is built first, of the scenarios' users only.
    """
    if isinstance(history, OrderSummary):
        of_users = history.of_users(scenarios)
    else:
        users = scenarios.select("user_id").distinct()
        rows = history.join(users, _BY, "left_semi").select(
            "user_id", "amount", "location_id", "device_id", "timestamp")
        # Read by every part of the summary.
        of_users = OrderSummary.of(materialise(rows, "whatif-history"))
    summary = history_summary(of_users)
    places = of_users.places.withColumnRenamed("n", "visits")
    devices = of_users.devices.withColumn("known", F.lit(1))
    top_location = -F.col("top.minus_location")
    placed = (
        scenarios.join(summary, _BY)
        .withColumn("location_id", F.coalesce("location_id", top_location))
        .join(places, ["user_id", "location_id"], "left")
        .join(devices, ["user_id", "device_id"], "left")
    )
    # The new row counts towards the user's modal location; ties take the smaller.
    visits = F.coalesce("visits", F.lit(0)) + 1
    best = F.coalesce("top.n", F.lit(0))
    home = (
        F.when(visits > best, F.col("location_id"))
        .when(visits == best, F.least("location_id", top_location))
        .otherwise(top_location)
    )
    given = F.abs("amount")
    median = F.coalesce(_with_inserted("middle", given, 0.5), given)
    limit = F.coalesce(_with_inserted("spend", given, SPEND_QUANTILE), given)
    # Replacing zeros by the median moves values only up to the median, which
    # the 95 % rank is not below, so the limit can be read from unreplaced ranks.
    high = F.round(given, QUANTILE_DIGITS) > F.round(limit, QUANTILE_DIGITS)
    return placed.select(
        "scenario_id",
        "user_id",
        F.when(given <= 0, median).otherwise(given).alias("amount"),
        "location_id",
        "device_id",
        (F.col("last_time") + F.expr("INTERVAL 1 MINUTE")).alias("timestamp"),
        F.coalesce((F.col("location_id") != home).cast("int"), F.lit(1)).alias("unusual_location"),
        F.coalesce(high.cast("int"), F.lit(0)).alias("high_spend"),
        F.when(F.col("known").isNull(), 1).otherwise(0).alias("new_device"),
    )


def without_history(scenarios: DataFrame, history: DataFrame) -> DataFrame:
    """Scenarios that cannot be evaluated: their user has no transactions."""
    return scenarios.join(history.select("user_id").distinct(), _BY, "left_anti")


def whatif_score(features: DataFrame, fraud_model: Classifier, forest: Forest) -> DataFrame:
    """Both model scores for every scenario."""
    return anomaly_score(fraud_model.score(features), forest)
