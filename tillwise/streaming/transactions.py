"""Fraud features, scores and recommendations on transaction streams."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from tillwise.operators.features import engineer_fraud_features
from tillwise.operators.models import Classifier
from tillwise.operators.rollups import HIGH_AMOUNT
from tillwise.sources.readers import read_or_empty
from tillwise.workspace import fresh_path

#: Groups that the state of first sights is dealt to. Fixed for the life of a checkpoint.
BUCKETS = 256
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Run(NamedTuple):
    """What a run over the available data left: the result, and figures of its state.

    ``late_rows``: rows let go for being behind the watermark (groups of a micro-batch
    where the query aggregates); ``state_rows``: rows of state at the end.
    """

    table: DataFrame
    late_rows: int
    state_rows: int


@contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Queries started here keep their state in RocksDB, not on the heap."""
    before = spark.conf.get(_STORE, None)
    spark.conf.set(_STORE, _ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_STORE)
        else:
            spark.conf.set(_STORE, before)


def _finished(writer) -> tuple[int, int]:
    """Run a stream writer over what is available: late rows, and rows of state at the end."""
    query = writer.trigger(availableNow=True).start()
    late: dict[tuple, int] = {}
    state = 0
    ended = False
    while not ended:
        ended = query.awaitTermination(1)
        # Progress is kept for the latest batches only, so it is read as they go by.
        for progress in query.recentProgress:
            parts = progress["stateOperators"]
            state = sum(p["numRowsTotal"] for p in parts) if parts else state
            for i, part in enumerate(parts):
                late[progress["batchId"], i] = part["numRowsDroppedByWatermark"]
    return sum(late.values()), state


def run_reported(
    stream: DataFrame, label: str, mode: str = "append", checkpoint: str | None = None,
    out: str | None = None,
) -> Run:
    """Process what the source holds now and return the written result with its figures.

    With ``checkpoint`` and ``out`` of an earlier run the stream goes on where that run,
    or a lost one, stopped.
    """
    spark = stream.sparkSession
    out = out or fresh_path(spark, f"{label}-out")
    with _state_on_disk(spark):
        late, state = _finished(
            stream.writeStream.outputMode(mode)
            .format("parquet")
            .option("checkpointLocation", checkpoint or fresh_path(spark, f"{label}-state"))
            .option("path", out)
        )
    return Run(spark.read.schema(stream.schema).parquet(out), late, state)


def run_available(stream: DataFrame, label: str, mode: str = "append") -> DataFrame:
    """Process what the source holds now, then return the written result as a table."""
    return run_reported(stream, label, mode).table


def event_features(
    stream: DataFrame, homes: DataFrame, forget: str | None = None
) -> DataFrame:
    """Online features of each event.

    Location is compared with the user's home location (a static table, read again
    for every micro-batch: pass a written one), spend with a fixed amount, and a
    device is new when this stream has not seen it for
    the user before: see :func:`mark_first_sight` for the state and ``forget``.
    """
    joined = stream.join(homes.select("user_id", "home_location"), "user_id", "left")
    location, home = F.col("location_id"), F.coalesce("home_location", "location_id")
    flagged = joined.withColumns(
        {
            "unusual_location": F.when(location.isNull(), 1).otherwise(
                (location != home).cast("int")
            ),
            "high_spend": F.coalesce((F.col("amount") > HIGH_AMOUNT).cast("int"), F.lit(0)),
            "location_id": F.coalesce(location, home),
        }
    ).drop("home_location")
    return mark_first_sight(flagged, forget)


class FirstSight(StatefulProcessor):
    """Marks the earliest event of a (user, device) that the bucket's state does not hold.

    One call takes a bucket's events of a micro-batch, chunk by chunk. The state maps a pair
    to the time of its latest event in milliseconds. With ``forget_ms``, a pair whose latest
    event is that much earlier counts as unknown, and once the watermark is as far beyond it
    a timer of the bucket lets it go.
    """

    def __init__(self, columns: list[str], forget_ms: int | None):
        self.columns, self.forget_ms = columns, forget_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.seen = handle.getMapState("seen", "pair string", "latest bigint")

    def handleInputRows(
        self, key: tuple, rows: Iterator[pd.DataFrame], timerValues
    ) -> Iterator[pd.DataFrame]:
        latest: dict[str, int] = {}
        # The earliest event so far of each pair waits; the others go on.
        waiting = None
        for chunk in rows:
            chunk = chunk[[*self.columns, "pair", "millis"]].assign(new_device=0)
            for pair, at in chunk.groupby("pair")["millis"].max().items():
                latest[pair] = max(latest.get(pair, at), at)
            if waiting is not None:
                chunk = pd.concat([waiting, chunk], ignore_index=True)
            chunk = chunk.sort_values(["pair", "timestamp", "txn_id"], kind="stable")
            first = ~chunk["pair"].duplicated()
            waiting = chunk[first]
            yield chunk[~first].drop(columns=["pair", "millis"])
        if waiting is None:
            return
        new = []
        for pair, at in zip(waiting["pair"], waiting["millis"]):
            held = self.seen.getValue((pair,)) if self.seen.containsKey((pair,)) else None
            new.append(held is None or (self.forget_ms is not None and at - held[0] > self.forget_ms))
            if held is None or (self.forget_ms is not None and latest[pair] > held[0]):
                self.seen.updateValue((pair,), (int(latest[pair]),))
        if self.forget_ms is not None:
            self.handle.registerTimer(int(max(latest.values())) + self.forget_ms + 1)
        yield waiting.drop(columns=["pair", "millis"]).assign(new_device=[int(n) for n in new])

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        behind = timerValues.getCurrentWatermarkInMs() - self.forget_ms
        for pair in [k for k, v in self.seen.iterator() if v[0] < behind]:
            self.seen.removeKey(pair)
        return iter(())

    def close(self) -> None:
        pass


def mark_first_sight(
    stream: DataFrame, forget: str | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """Add new_device: 1 for the earliest event of a (user, device) never seen before.

    Pairs are dealt to ``buckets`` by hash, so a heavy user's devices spread, and a call of
    Python serves a bucket, not a pair. Without ``forget`` a pair is remembered for ever.
    With it, a duration of event time, a pair whose earlier micro-batches end more than that
    before its next event is new again, and its state goes after twice as long; events that
    much behind the latest are let go and counted as late (``run_reported``). Missing users
    and devices are pairs like others.
    """
    schema = T.StructType([*stream.schema.fields, T.StructField("new_device", T.IntegerType())])
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    at = F.col("timestamp").cast("timestamp")
    dealt = stream.withColumns({
        "pair": F.concat_ws("|", part("user_id"), part("device_id")),
        "millis": F.coalesce(F.unix_millis(at), F.lit(0)),
    }).withColumn("bucket", F.pmod(F.xxhash64("pair"), F.lit(buckets)).cast("int"))
    forget_ms = None
    if forget is not None:
        dealt = dealt.withColumn("seen_at", at).withWatermark("seen_at", forget)
        span = F.unix_millis(F.timestamp_millis(F.lit(0)) + F.expr(f"interval {forget}"))
        forget_ms = stream.sparkSession.range(1).select(span).first()[0]
    return dealt.groupBy("bucket").transformWithStateInPandas(
        FirstSight(stream.columns, forget_ms), schema, "append",
        "None" if forget is None else "EventTime",
    )


def first_devices(stream: DataFrame, expire: str | None = None) -> DataFrame:
    """Each (user, device) once, when it first appears.

    Without ``expire`` the state keeps every pair. With it, a duration of event time, a
    pair's state goes that long after its first event has been passed by the watermark:
    a pair that appears again later is reported again, and events that much behind the
    latest are let go and counted as late (``run_reported``).
    """
    pairs = stream.select("user_id", "device_id", F.col("timestamp").cast("timestamp").alias("event_time"))
    if expire is None:
        return pairs.select("user_id", "device_id").dropDuplicates(["user_id", "device_id"])
    return (
        pairs.withWatermark("event_time", expire)
        .dropDuplicatesWithinWatermark(["user_id", "device_id"])
        .select("user_id", "device_id")
    )


def score_events(stream: DataFrame, homes: DataFrame, model: Classifier) -> DataFrame:
    return model.score(event_features(stream, homes)).select(
        "txn_id", "user_id", "amount", "fraud_proba"
    )


def user_recommendations(stream: DataFrame, top_items: DataFrame) -> DataFrame:
    """The precomputed top list of the user of every arriving event."""
    events = stream.select("txn_id", "user_id")
    return events.join(top_items.select("user_id", "product_id", "score", "rank"), "user_id")


_BATCH_STATS = (
    "batch_no long, batch_start_idx long, batch_size long, mean_fraud_proba double, "
    "max_fraud_proba double"
)


def score_micro_batches(stream: DataFrame, model: Classifier, label: str = "batch-scores") -> DataFrame:
    """Mean and largest fraud score of every logical batch of a stream with ``row_no`` and
    ``batch_no`` (``offsets.stream_rows``).

    Features see their logical batch alone. A micro-batch may hold any number of them:
    their statistics come from one job, grouped by number, so the driver's steps follow
    the micro-batches, not the rows. Every micro-batch writes its own folder, so a replayed
    one replaces its earlier result.
    """
    spark = stream.sparkSession
    out = fresh_path(spark, f"{label}-out")

    def score(batch: DataFrame, epoch: int) -> None:
        # A group is a user within one logical batch, whose size is fixed.
        features = engineer_fraud_features(batch, by=("batch_no", "user_id"), hot_rows=None)
        stats = model.score(features).groupBy("batch_no").agg(
            F.min("row_no").alias("batch_start_idx"),
            F.count(F.lit(1)).alias("batch_size"),
            F.avg("fraud_proba").alias("mean_fraud_proba"),
            F.max("fraud_proba").alias("max_fraud_proba"),
        )
        stats.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    _finished(
        stream.writeStream.foreachBatch(score)
        .option("checkpointLocation", fresh_path(spark, f"{label}-state"))
    )
    schema = T.StructType.fromDDL(_BATCH_STATS)
    return read_or_empty(spark, out, schema).select(*schema.names)


def windowed_fraud(stream: DataFrame, width: str = "1 hour", late: str | None = None) -> DataFrame:
    """Events, amount and fraud labels per tumbling window of event time.

    Without ``late`` every event counts, however late; the state is a row per window.
    With it, state behind the watermark is let go, and so are events that late, which
    :func:`windows_reported` counts.
    """
    timed = stream.withColumn("event_time", F.col("timestamp").cast("timestamp"))
    return (
        (timed if late is None else timed.withWatermark("event_time", late))
        .groupBy(F.window("event_time", width))
        .agg(
            F.count(F.lit(1)).alias("txn_count"),
            F.sum("amount").alias("total_amount"),
            F.sum("is_fraud").alias("fraud_count"),
        )
        .select(F.col("window.start").alias("window_start"), "txn_count", "total_amount", "fraud_count")
    )


def latest_windows(windows: DataFrame, label: str = "windows") -> DataFrame:
    """The table of :func:`windows_reported`."""
    return windows_reported(windows, label).table


def windows_reported(windows: DataFrame, label: str = "windows") -> Run:
    """Run a stream of windows over all that is available; every window, as last updated.

    Windows still open at the end are in the result too. A replayed batch replaces its
    earlier output. ``late_rows`` counts, per micro-batch, the windows that late events
    would have changed.
    """
    spark = windows.sparkSession
    out = fresh_path(spark, f"{label}-out")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_no={batch_id}")

    with _state_on_disk(spark):
        late, state = _finished(
            windows.writeStream.foreachBatch(write)
            .outputMode("update")
            .option("checkpointLocation", fresh_path(spark, f"{label}-state"))
        )
    numbered = T.StructType([*windows.schema.fields, T.StructField("batch_no", T.IntegerType())])
    updates = read_or_empty(spark, out, numbered)
    values = [c for c in windows.columns if c != "window_start"]
    table = updates.groupBy("window_start").agg(
        F.max_by(F.struct(*values), "batch_no").alias("last")
    ).select("window_start", "last.*")
    return Run(table, late, state)
