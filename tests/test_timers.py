"""Windows of processing time close by their timers, over batches and restarts."""

import time

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from orderpulse.session import use_defaults
from orderpulse.streaming import timers

ROWS = "user_id string, arrival long"


def land(spark, path, *rows):
    spark.createDataFrame(list(rows), ROWS).coalesce(1).write.mode("append").parquet(path)


def start(spark, path, out, checkpoint, seconds):
    stream = spark.readStream.schema(ROWS).parquet(path)
    return timers.append_timed_counts(stream, out, seconds=seconds, spread=3, checkpoint=checkpoint)


def test_windows_close_without_a_later_row(spark, tmp_path):
    use_defaults(spark)
    landed, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    land(spark, landed, *(("a", n) for n in range(50)), ("b", 50), (None, 51))
    timers.run_until(spark, start(spark, landed, out, checkpoint, 3), out, 52)
    rows = timers.read_timed_counts(spark, out).collect()
    assert {r.user_id: r.order_count for r in rows} == {"a": 50, "b": 1, None: 1}
    assert {(r.window_end - r.window_start).total_seconds() for r in rows} == {3.0}

    # A second batch, stopped while its windows are open: they end after the restart, at the
    # latest with the first batch that has rows.
    land(spark, landed, *(("a", n) for n in range(100, 107)))
    query = start(spark, landed, out, checkpoint, 3)
    before = time.monotonic()
    while not any(p["numInputRows"] for p in query.recentProgress):
        assert time.monotonic() - before < 60 and query.exception() is None
        time.sleep(0.05)
    query.stop()
    land(spark, landed, ("c", 200))
    timers.run_until(spark, start(spark, landed, out, checkpoint, 3), out, 60, seconds=60)
    rows = timers.read_timed_counts(spark, out).filter("user_id is not null").collect()
    assert sorted((r.user_id, r.order_count) for r in rows) == [
        ("a", 7), ("a", 50), ("b", 1), ("c", 1)]


def test_parts_are_merged(spark):
    parts = spark.range(8).select(F.lit("a").alias("user_id"), F.col("id").alias("order_count"),
                                  F.timestamp_seconds(F.lit(0)).alias("window_start"),
                                  F.timestamp_seconds(F.lit(60)).alias("window_end"))
    assert [r.order_count for r in timers.merged(parts).collect()] == [28]


class Held:
    """A state of one key that counts the calls made to it."""

    def __init__(self):
        self.maps, self.calls = {}, 0

    def getMapState(self, name, key, value):
        held, rows = self, self.maps.setdefault(name, {})

        class Map:
            def containsKey(self, key):
                held.calls += 1
                return key in rows

            def getValue(self, key):
                held.calls += 1
                return rows[key]

            def updateValue(self, key, value):
                held.calls += 1
                rows[key] = value

            def removeKey(self, key):
                held.calls += 1
                del rows[key]
        return Map()

    def registerTimer(self, at):
        self.calls += 1


class At:
    def __init__(self, millis):
        self.millis = millis

    def getCurrentProcessingTimeInMs(self):
        return self.millis

    def getExpiryTimeInMs(self):
        return self.millis


def test_calls_to_the_state_do_not_grow_with_users():
    held, window = Held(), timers.WindowCounts(1000)
    window.init(held)
    rows = pd.DataFrame({"user_id": [None, *map(str, range(9000))], "orders": 2})
    for now in (5100, 5900):
        assert list(window.handleInputRows((1,), iter([rows, rows[:1]]), At(now))) == []
    (out,) = window.handleExpiredTimer((1,), At(6001), At(6000))
    assert held.calls < 40 and not any(held.maps.values())
    counts = dict(zip(out["user_id"], out["order_count"]))
    assert len(counts) == 9001 and counts[None] == 8 and set(map(counts.get, map(str, range(9000)))) == {4}
    assert {(s.value // 10 ** 6, e.value // 10 ** 6)
            for s, e in zip(out["window_start"], out["window_end"])} == {(5000, 6000)}


def test_a_busy_user_is_counted_before_the_shuffle():
    batch = pa.RecordBatch.from_pydict({"user_id": pa.array(["a"] * 5000 + [None, "b"])})
    (counted,) = timers.count_users(iter([batch]))
    assert sorted(map(str, counted.to_pylist())) == sorted(map(str, [
        {"user_id": "a", "orders": 5000}, {"user_id": None, "orders": 1}, {"user_id": "b", "orders": 1}]))
