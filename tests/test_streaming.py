import time

import pytest
from pyspark.sql import functions as F

from tillwise.operators import cleaning
from tillwise.sources import feeds, offsets, readers
from tillwise.streaming import transactions as streams
from tillwise.workspace import fresh_path

ROWS = [
    (1, 600.0, 1, 10), (1, 700.0, 1, 10), (1, 5.0, 2, 11), (2, 5.0, None, 10),
    (1, 5.0, 1, 10), (2, 501.0, 3, 10), (2, 500.0, 3, 12), (9, 1.0, 4, 1),
] * 3


def staged(spark, tx, files):
    """The rows as that many files, written one after the other."""
    path = fresh_path(spark, "source")
    size = -(-len(ROWS) // files)
    for i in range(files):
        part = tx.where(F.floor(F.col("txn_id") / size) == i)
        part.coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)
    return path


@pytest.mark.parametrize("files", [1, 4])
def test_event_features_over_batches(spark, make_tx, files):
    tx = make_tx(ROWS)
    homes = cleaning.user_home_location(tx.where("user_id < 9"))
    path = staged(spark, tx, files)
    stream = readers.stream_table(spark, path, feeds.TRANSACTIONS, files_per_batch=1)
    made = streams.run_available(streams.event_features(stream, homes), "features")
    got = {r.txn_id: (r.unusual_location, r.high_spend, r.new_device) for r in made.collect()}
    home, seen, want = {1: 1, 2: 3}, set(), {}
    for i, (user, amount, location, device) in enumerate(ROWS):
        unusual = 1 if location is None else int(location != home.get(user, location))
        want[i] = (unusual, int(amount > 500), int((user, device) not in seen))
        seen.add((user, device))
    assert got == want
    filled = {r.txn_id: r.location_id for r in made.collect()}
    assert filled[3] == 3


def test_first_devices_equal_the_stateful_result(spark, make_tx):
    path = staged(spark, make_tx(ROWS), 3)
    stream = readers.stream_table(spark, path, feeds.TRANSACTIONS, files_per_batch=1)
    got = streams.run_available(streams.first_devices(stream), "devices")
    assert sorted(map(tuple, got.collect())) == sorted({(r[0], r[3]) for r in ROWS})


def test_large_group_is_handed_on_in_chunks(spark, make_tx):
    """Many events of one device in one batch: exactly the earliest is new."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        tx = make_tx([(1, 1.0, 1, 5, 1000 - i) for i in range(400)] + [(2, 1.0, 1, 5)])
        path = fresh_path(spark, "source")
        tx.repartition(5).write.parquet(path)
        stream = readers.stream_table(spark, path, feeds.TRANSACTIONS)
        made = streams.run_available(streams.mark_first_sight(stream), "chunks")
        assert made.count() == 401
        assert sorted(r.txn_id for r in made.where("new_device = 1").collect()) == [399, 400]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_every_window_is_reported_whatever_the_order(spark, make_tx):
    """Files out of order, events hours late, and windows still open at the end."""
    path = fresh_path(spark, "source")
    for minutes in ((400, 125), (0, 61), (30, 401)):
        tx = make_tx([(1, 2.0, 1, 1, m) for m in minutes])
        tx.coalesce(1).write.mode("append").parquet(path)
    stream = readers.stream_table(spark, path, feeds.TRANSACTIONS, files_per_batch=1)
    got = streams.latest_windows(streams.windowed_fraud(stream)).orderBy("window_start")
    assert [(r.window_start.hour, r.txn_count, r.total_amount) for r in got.collect()] == [
        (0, 2, 4.0), (1, 1, 2.0), (2, 1, 2.0), (6, 2, 4.0)
    ]


def test_recommendations_on_arrival(spark, make_tx):
    path = staged(spark, make_tx(ROWS), 1)
    top = spark.createDataFrame(
        [(1, 7, 0.5, 1), (1, 8, 0.4, 2)], "user_id long, product_id long, score double, rank int"
    )
    stream = readers.stream_table(spark, path, feeds.TRANSACTIONS)
    got = streams.run_available(streams.user_recommendations(stream, top), "recs")
    assert got.count() == 2 * sum(r[0] == 1 for r in ROWS)


def test_features_go_on_from_a_checkpoint(spark, make_tx):
    """A stopped stream remembers its devices when it is started again on new files."""
    tx = make_tx(ROWS)
    homes = cleaning.user_home_location(tx)
    path, state, out = (fresh_path(spark, x) for x in ("source", "state", "out"))
    for low, high in ((0, 7), (7, 9), (9, 24)):
        tx.where(F.col("txn_id").between(low, high - 1)).coalesce(1).write.mode("append").parquet(path)
        stream = readers.stream_table(spark, path, feeds.TRANSACTIONS, files_per_batch=1)
        made = streams.run_reported(streams.event_features(stream, homes), "again", checkpoint=state, out=out)
    seen, want = set(), {}
    for i, (user, _, _, device) in enumerate(ROWS):
        want[i] = int((user, device) not in seen)
        seen.add((user, device))
    assert {r.txn_id: r.new_device for r in made.table.collect()} == want
    assert made.state_rows >= len(seen) and made.late_rows == 0


def test_pairs_are_new_again_once_forgotten(spark, make_tx):
    """Without an event for the duration a pair is new again, and the state stays bounded."""
    path = fresh_path(spark, "source")
    minutes = [0, 30, 300, 310, 600, 900, 1200, 20]
    for txn, minute in enumerate(minutes):
        tx = make_tx([(1, 1.0, 1, 5, minute), (2, 1.0, 1, 100 + txn, minute)])
        tx.withColumn("txn_id", F.col("txn_id") + 10 * txn).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)
    stream = readers.stream_table(spark, path, feeds.TRANSACTIONS, files_per_batch=1)
    made = streams.run_reported(streams.mark_first_sight(stream, "2 hours", buckets=2), "forget")
    got = {r.txn_id // 10: r.new_device for r in made.table.where("user_id = 1").collect()}
    assert got == {0: 1, 1: 0, 2: 1, 3: 0, 4: 1, 5: 1, 6: 1}
    assert made.late_rows == 2 and made.state_rows < 12


def test_missing_users_and_devices_are_pairs(spark, make_tx):
    path = fresh_path(spark, "source")
    make_tx([(None, 1.0, 1, 5), (None, 1.0, 1, 5), (1, 1.0, 1, None), (None, 1.0, 1, None)]).write.parquet(path)
    stream = readers.stream_table(spark, path, feeds.TRANSACTIONS)
    made = streams.run_available(streams.mark_first_sight(stream), "missing")
    assert [r.new_device for r in made.orderBy("txn_id").collect()] == [1, 0, 1, 1]


def hourly(spark, make_tx, hours):
    """One file an hour, each with a device of its own, then one event of the first hour."""
    path = fresh_path(spark, "source")
    for h in [*range(hours), 0]:
        tx = make_tx([(1, 2.0, 1, 100 + h, 60 * h + m) for m in (0, 5)])
        tx.coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)
    return readers.stream_table(spark, path, feeds.TRANSACTIONS, files_per_batch=1)


def test_expiry_bounds_the_state_and_counts_what_is_late(spark, make_tx):
    kept = streams.run_reported(streams.first_devices(hourly(spark, make_tx, 8)), "all")
    assert kept.table.count() == 8 and kept.state_rows == 8 and kept.late_rows == 0
    short = streams.run_reported(streams.first_devices(hourly(spark, make_tx, 8), "2 hours"), "short")
    assert short.table.count() == 8 and short.state_rows <= 5 and short.late_rows == 2


def test_late_events_of_windows_are_counted(spark, make_tx):
    every = streams.windows_reported(streams.windowed_fraud(hourly(spark, make_tx, 6)))
    assert every.late_rows == 0 and every.state_rows == 6
    assert {r.txn_count for r in every.table.collect()} == {2, 4}
    some = streams.windows_reported(streams.windowed_fraud(hourly(spark, make_tx, 6), late="90 minutes"))
    assert some.late_rows == 1 and some.state_rows < 6
    assert [r.txn_count for r in some.table.collect()] == [2] * 6


def test_rows_are_admitted_by_position(spark, make_tx):
    path = fresh_path(spark, "source")
    tx = make_tx([(i % 3, float(i), 1, 1) for i in range(47)])
    for low, high in ((0, 20), (20, 47)):
        tx.where(F.col("txn_id").between(low, high - 1)).coalesce(1).sortWithinPartitions("txn_id").write.mode("append").parquet(path)
    reader = offsets.RowOffsetReader({"path": path, "rows_per_batch": "10", "flush": "false", "part_rows": "7"}, feeds.TRANSACTIONS)
    assert reader.latestOffset() == {"row": 40}
    parts = reader.partitions({"row": 5}, {"row": 40})
    assert sum(p.rows for p in parts) == 35 and max(p.rows for p in parts) == 7
    stream = offsets.stream_rows(spark, path, feeds.TRANSACTIONS, 10)
    got = streams.run_available(stream, "rows").orderBy("row_no").collect()
    assert [r.row_no for r in got] == list(range(47)) and [r.batch_no for r in got] == [i // 10 for i in range(47)]
    files = {r.txn_id // 20 if r.txn_id < 40 else 1 for r in got[:20]}
    assert len(files) == 1 and sorted(r.txn_id for r in got) == list(range(47))
    assert {r.timestamp.minute for r in got} == set(range(47))


class Constant:
    """Scores every row by its flags; stands in for a trained model."""

    def score(self, df):
        return df.withColumn("fraud_proba", (F.col("new_device") + F.col("high_spend")) / 2.0)


def test_batches_are_scored_in_one_job_and_replaced_when_replayed(spark, make_tx):
    path = fresh_path(spark, "source")
    tx = make_tx([(i % 4, float(i % 9), 1, i % 5) for i in range(95)])
    tx.coalesce(1).sortWithinPartitions("txn_id").write.parquet(path)
    stream = offsets.stream_rows(spark, path, feeds.TRANSACTIONS, 20)
    got = streams.score_micro_batches(stream, Constant()).orderBy("batch_no").collect()
    assert [(r.batch_no, r.batch_start_idx, r.batch_size) for r in got] == [
        (0, 0, 20), (1, 20, 20), (2, 40, 20), (3, 60, 20), (4, 80, 15)
    ]
    from tillwise.operators.features import engineer_fraud_features

    for r in got:
        one = tx.where(F.floor(F.col("txn_id") / 20) == r.batch_no)
        mean = Constant().score(engineer_fraud_features(one)).agg(F.avg("fraud_proba")).first()[0]
        assert r.mean_fraud_proba == pytest.approx(mean)


def test_streams_that_never_had_rows(spark):
    path = fresh_path(spark, "source")
    spark.createDataFrame([], feeds.TRANSACTIONS).write.parquet(path)
    stream = readers.stream_table(spark, path, feeds.TRANSACTIONS)
    assert streams.latest_windows(streams.windowed_fraud(stream)).count() == 0
    rows = offsets.stream_rows(spark, path, feeds.TRANSACTIONS, 10)
    assert streams.score_micro_batches(rows, Constant()).count() == 0
