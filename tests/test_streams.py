"""Streams fed file by file: equal to batch, late rows, restart, sinks."""

import random
import time
from datetime import datetime, timedelta
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from orderpulse.operators import running, serving, windows
from orderpulse.operators.files import process_files
from orderpulse.schemas import TOPIC
from orderpulse.session import use_defaults
from orderpulse.sources import files, results, topics
from orderpulse.streaming import queries, sinks

START = datetime(2024, 1, 1)
EVENT = ("order_id string, user_id string, price decimal(10,2), quantity int, "
         "timestamp timestamp, arrival long")


class Feed:
    """A folder that gets one file per ``add``, read one file per micro-batch."""

    def __init__(self, spark, path):
        self.spark, self.path, self.arrival = spark, str(path), 0

    def add(self, *rows):
        """Rows of (user, second) or (user, second, price)."""
        events = []
        for user, second, *price in rows:
            events.append((str(self.arrival), user, D(price[0] if price else 1), 1,
                           START + timedelta(seconds=second), self.arrival))
            self.arrival += 1
        self.spark.createDataFrame(events, EVENT).coalesce(1).write.mode("append").parquet(
            self.path)

    def stream(self):
        return (self.spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1)
                .parquet(self.path))

    def table(self):
        return self.spark.read.schema(EVENT).parquet(self.path)


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path / "events")


def run(spark, df, out, checkpoint):
    query = sinks.append_files(df, str(out), checkpoint=str(checkpoint))
    query.awaitTermination()
    return query, spark.read.schema(df.schema).parquet(str(out))


@pytest.mark.parametrize("size,slide", [("1 minute", None), ("5 minutes", "1 minute")])
def test_stream_equals_batch_on_closed_windows(spark, feed, tmp_path, size, slide):
    rng = random.Random(1)
    second = 0
    for _ in range(4):
        rows = []
        for _ in range(80):
            second += rng.randrange(20)
            # At most 5 seconds out of order, which the watermark allows.
            rows.append((rng.choice("abcd"), max(0, second - rng.randrange(5)), rng.randrange(9)))
        feed.add(*rows)
    _, got = run(spark, queries.stream_window_totals(feed.stream(), size, slide),
                 tmp_path / "out", tmp_path / "cp")
    newest = feed.table().agg(F.max("timestamp")).first()[0]
    batch = windows.window_totals(feed.table(), size, slide).filter(
        F.col("window_end") <= F.lit(newest - timedelta(seconds=5)))
    assert got.count() == batch.count() > 10
    assert got.exceptAll(batch).count() == 0


def test_late_rows_are_dropped_and_counted(spark, feed, tmp_path):
    feed.add(("a", 10), ("a", 130))
    feed.add(("b", 200))
    feed.add(("late", 50), ("c", 210))
    feed.add(("d", 400))
    totals = sinks.watch(spark)
    query, got = run(spark, queries.stream_window_totals(feed.stream()),
                     tmp_path / "out", tmp_path / "cp")
    rows = {r.window_start: r.total_orders for r in got.collect()}
    assert rows == {START: 1, START + timedelta(minutes=2): 1, START + timedelta(minutes=3): 2}
    assert totals.dropped_late(query) == 1


def test_restart_goes_on_from_checkpoint(spark, feed, tmp_path):
    def once():
        return run(spark, queries.count_windows(queries.stream_window_totals(feed.stream())),
                   tmp_path / "out", tmp_path / "cp")

    feed.add(("a", 10), ("b", 20))
    _, got = once()
    assert got.count() == 0
    feed.add(("a", 30), ("c", 90))
    totals = sinks.watch(spark)
    query, got = once()
    first = got.collect()
    assert [(r.unique_users, r.total_orders) for r in first] == [(2, 3)]
    assert totals.observed(query) == 1
    feed.add(("d", 300))
    _, got = once()
    assert got.count() == 2


def test_user_counts_by_arrival(spark, feed, tmp_path):
    feed.add(("a", 10), ("a", 20), (None, 30))
    feed.add(("a", 59), ("a", 60))
    feed.add(("b", 200))
    keyed = feed.stream().fillna("unknown", "user_id")
    _, got = run(spark, queries.stream_user_window_counts(keyed, ts="timestamp", delay="0 seconds"),
                 tmp_path / "out", tmp_path / "cp")
    rows = {(r.user_id, (r.window_start - START).total_seconds()): r.order_count
            for r in got.collect()}
    assert rows == {("a", 0.0): 3, ("unknown", 0.0): 1, ("a", 60.0): 1}


def test_user_counts_by_batch_time(spark, feed, tmp_path):
    feed.add(("a", 1))
    counts = queries.stream_user_window_counts(feed.stream())
    assert counts.columns == ["user_id", "order_count", "window_start", "window_end"]
    query, _ = run(spark, counts, tmp_path / "out", tmp_path / "cp")
    assert query.exception() is None


def test_heartbeat_closes_a_window_without_new_rows(spark, feed, tmp_path):
    feed.add(("a", 1), ("a", 2), (None, 3))
    counts = queries.stream_user_window_counts(feed.stream(), "2 seconds", heartbeat=True)
    out = str(tmp_path / "out")
    query = sinks.append_files(counts, out, checkpoint=str(tmp_path / "cp"), every="1 second")
    try:
        found, deadline = [], time.monotonic() + 60
        while not found and time.monotonic() < deadline:
            time.sleep(1)
            if query.recentProgress:
                found = spark.read.schema(counts.schema).parquet(out).collect()
    finally:
        query.stop()
    assert {(r.user_id, r.order_count) for r in found} == {("a", 2), (None, 1)}


@pytest.mark.parametrize("mode", ["update", "complete"])
def test_running_stats_survive_a_restart(spark, feed, tmp_path, mode):
    out = str(tmp_path / "stats")

    def once():
        stats = queries.stream_user_running_stats(feed.stream())
        sinks.publish_user_stats(stats, out, mode=mode, checkpoint=str(tmp_path / "cp"),
                                 every=None).awaitTermination()
        return sinks.read_batches(spark, out)

    feed.add(("a", 10, 6000), ("b", 5, 1))
    assert once().count() == 2
    feed.add(("a", 3, 5000))
    batches = once()
    assert batches.filter("batch_id = 1").count() == (1 if mode == "update" else 2)
    latest = {r.user_id: r for r in sinks.newest_by_key(batches, "user_id").collect()}
    a = latest["a"]
    assert (a.total_orders, a.total_spent, a.customer_tier) == (2, 11000, "VIP")
    assert (a.first_order, a.last_order) == ("2024-01-01T00:00:10Z", "2024-01-01T00:00:03Z")
    want = running.user_running_stats(feed.table()).select("user_id", "total_spent").collect()
    assert {(r.user_id, r.total_spent) for r in want} == {
        (k, r.total_spent) for k, r in latest.items()}


@pytest.mark.parametrize("spread", [1, 4])
def test_duplicates_are_dropped_across_batches(spark, feed, tmp_path, spread):
    feed.add(*[("a", second) for second in range(10, 40)])
    feed.add(("a", 12), ("b", 13), ("b", 13))
    feed.add(("a", 50), ("b", 60))
    kept = queries.deduplicate_stream(feed.stream(), "user_id", spread=spread)
    _, got = run(spark, kept, tmp_path / "out", tmp_path / "cp")
    assert sorted(r.user_id for r in got.collect()) == ["a", "b"]


def test_batch_that_runs_again_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = spark.createDataFrame([("w1", 1), ("w2", 1)], "window_id string, n int")
    sinks.replace_batch(rows, 0, path)
    sinks.replace_batch(rows.withColumn("n", F.lit(2)).limit(1), 1, path)
    sinks.replace_batch(rows.filter("window_id = 'w1'").withColumn("n", F.lit(3)), 1, path)
    now = {r.window_id: r.n for r in sinks.newest_by_key(
        sinks.read_batches(spark, path), "window_id").collect()}
    assert now == {"w1": 3, "w2": 1}
    sinks.compact(spark, path, str(tmp_path / "compact"), "window_id")
    assert sinks.read_batches(spark, str(tmp_path / "compact")).count() == 2


def land(spark, path, topic, *texts):
    rows = [(t, 0, i, START + timedelta(seconds=i)) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, TOPIC).coalesce(1).write.mode("append").parquet(f"{path}/{topic}")


def test_mixed_results_topic(spark, tmp_path):
    land(spark, tmp_path, "analytics-results",
         '{"user_id":"1","total_spent":5,"window_end":"2024-01-01T00:01:00"}',
         '{"user_id":"1","order_count":3,"window_end":1704067260000}',
         '{"user_id":"1","total_spent":7.5,"window_end":"2024-01-01T00:02:00"}',
         '{"window_start":"2024-01-01T00:00:00","window_end":"2024-01-01T00:01:00"}',
         '{"user_id":2,"total_spent":"6"}', "nope")
    read = results.read_results_bounded(spark, path=str(tmp_path))
    top = serving.top_users(read).collect()
    assert [(r.user_id, r.total_spent) for r in top] == [("1", D("7.50")), ("2", D("6.00"))]
    late = results.read_results_from_latest(
        spark, START + timedelta(seconds=3), path=str(tmp_path))
    assert [r.user_id for r in serving.has_user_id(late).collect()] == ["2"]


def test_topic_needs_one_place(spark):
    with pytest.raises(ValueError):
        topics.read_topic(spark)
    with pytest.raises(ValueError):
        topics.read_topic(spark, servers="b:1", path="/x")
    with pytest.raises(ValueError):
        topics.read_topic(spark, servers="b:1")


def test_kafka_options():
    assert topics.kafka_options("a:1,b:2", kafka_security_protocol="SSL") == {
        "kafka.bootstrap.servers": "a:1,b:2", "kafka.security.protocol": "SSL"}


def test_broker_seeks_to_a_time():
    assert topics.start_options("earliest") == {"startingOffsets": "earliest"}
    assert topics.start_options("latest", START) == {
        "startingTimestamp": "1704067200000", "startingOffsetsByTimestampStrategy": "latest"}


def test_arrival_follows_the_offset(spark):
    later = START + timedelta(milliseconds=1)
    rows = [(START, 0, 9), (START, 3, 1), (START, 3, 2), (START, 4097, 0), (later, 0, 0),
            (later, 0, 2 ** 63 - 1), (later, 1, 0)]
    df = spark.createDataFrame(rows, "t timestamp, p int, o long")
    got = [r[0] for r in df.select(topics.arrival(F.col("t"), F.col("p"), F.col("o"))).collect()]
    assert got == sorted(got) and len(set(got)) == len(rows)


@pytest.mark.parametrize("place", [(4096, 0), (0, 2 ** 51)])
def test_positions_do_not_clash(spark, place):
    df = spark.createDataFrame([place], "p int, o long")
    with pytest.raises(Exception, match="too large"):
        df.select(topics.position(F.col("p"), F.col("o"))).collect()


def test_positions_do_not_clash_over_appends(spark, tmp_path):
    def append(n, tasks):
        topics.write_topic(spark.range(n).repartition(tasks).select(
            F.col("id").cast("string").alias("value")), "t", path=str(tmp_path))

    for _ in range(3):
        append(40, 3)
    append(1, 1)
    read = topics.read_topic(spark, "t", path=str(tmp_path), start="earliest", positions=True)
    assert read.count() == read.select("position").distinct().count() == 121
    newest = read.orderBy(F.desc("arrival")).first()
    assert newest.value == "0" and read.filter(F.col("timestamp") == newest.timestamp).count() == 1


def test_counts_go_on_after_old_progress_is_gone(spark, feed, tmp_path):
    held = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    totals = sinks.watch(spark)
    try:
        for k in range(6):
            feed.add(("a", 100 * k))
        query, got = run(spark, queries.count_windows(queries.stream_window_totals(feed.stream())),
                         tmp_path / "out", tmp_path / "cp")
        assert totals.observed(query) == got.count() == 5
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", held)
        spark.streams.removeListener(totals)


def test_lagging_partitions_lose_nothing(spark, feed, tmp_path):
    for second in (10, 130, 20, 140, 30, 400):
        feed.add(("u", second))
    keyed = feed.stream().select("user_id", "timestamp")
    _, got = run(spark, queries.stream_user_window_counts(keyed, ts="timestamp", delay="3 minutes"),
                 tmp_path / "out", tmp_path / "cp")
    assert sorted(r.order_count for r in got.collect()) == [2, 3]
    with pytest.raises(ValueError):
        queries.stream_user_window_counts(keyed, ts="timestamp")


def test_file_stream_keeps_bytes_and_odd_names(spark, tmp_path):
    folder = tmp_path / "in" / "uploads" / "a b+c%"
    folder.mkdir(parents=True)
    (folder / "ü.txt").write_text("one\r\ntwo\n\nthree", encoding="utf-8")
    read = files.read_text_files(spark, str(tmp_path / "in"))
    assert [(r.path, r.content) for r in read.collect()] == [
        ("uploads/a b+c%/ü.txt", "one\r\ntwo\n\nthree")]
    found = files.read_text_files(spark, str(tmp_path / "in"), stream=True)
    _, got = run(spark, process_files(found), tmp_path / "out", tmp_path / "cp")
    assert [r.processed_path for r in got.collect()] == ["processed/a b+c%/ü.txt"]


def test_object_sink_keeps_text(spark, tmp_path):
    rows = [("processed/x/1.txt", "\nA\r\nB\n\n"), ("processed/2.txt", "\n\n")]
    processed = spark.createDataFrame(rows, "processed_path string, processed_content string")
    files.write_processed_files(processed, str(tmp_path / "o"), objects=True, tasks=2)
    got = files.read_text_files(spark, str(tmp_path / "o"), "processed/")
    assert {(r.path, r.content) for r in got.collect()} == set(rows)


def test_the_state_store_reads_no_row_to_count_rows(spark):
    use_defaults(spark)
    assert spark.conf.get(
        "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows") == "false"
