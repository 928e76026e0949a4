"""Windows of processing time that close by a timer.

The users are dealt to ``spread`` groups, and a group is a key of the state: it holds the counts
of its users in each open window, some thousands in a row, and one timer for the end of each. So
the calls to the state, which cost the most, do not grow with the users. When the time has come
the window is given out and forgotten, whether or not another row comes; no clock source
stands in for missing rows. (After a restart Spark runs no batch before it has rows; windows
that were open end with that batch at the latest.) A row belongs to the window in which its
micro-batch runs, as its time of arrival, so no row is late and none is lost.

Rows are counted per user in each task before they are dealt, so a busy user sends few.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery

from orderpulse.streaming.sinks import append_files

PARTS = "user_id string, order_count long, window_start timestamp, window_end timestamp"
#: Users in a row of the state.
USERS_AT_ONCE = 4096


def count_users(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (user_id) to the counts of each user in them."""
    for batch in batches:
        counted = pa.Table.from_batches([batch]).group_by("user_id").aggregate([([], "count_all")])
        yield from counted.rename_columns(["user_id", "orders"]).combine_chunks().to_batches()


class WindowCounts(StatefulProcessor):
    """Counts the orders of a group of users in windows of ``size`` milliseconds, each given out
    at its end."""

    def __init__(self, size: int):
        self.size = size

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "start long", "rows long")
        self.counts = handle.getMapState("counts", "start long, nth long",
                                         "users array<string>, orders array<long>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        start = now - now % self.size
        counts: Counter = Counter()
        for part in rows:
            for user, orders in zip(part["user_id"].tolist(), part["orders"].tolist()):
                counts[user] += orders
        held = 0
        if self.open.containsKey((start,)):
            held = self.open.getValue((start,))[0]
        else:
            self.handle.registerTimer(start + self.size)
        users = list(counts)
        for at in range(0, len(users), USERS_AT_ONCE):
            some = users[at:at + USERS_AT_ONCE]
            self.counts.updateValue((start, held), (some, [counts[user] for user in some]))
            held += 1
        self.open.updateValue((start,), (held,))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        end = expiredTimerInfo.getExpiryTimeInMs()
        start = end - self.size
        if not self.open.containsKey((start,)):
            return
        counts: Counter = Counter()
        for nth in range(self.open.getValue((start,))[0]):
            for user, orders in zip(*self.counts.getValue((start, nth))):
                counts[user] += orders
            self.counts.removeKey((start, nth))
        self.open.removeKey((start,))
        yield pd.DataFrame({"user_id": pd.Series(list(counts), dtype=object),
                            "order_count": list(counts.values()),
                            "window_start": pd.to_datetime(start, unit="ms"),
                            "window_end": pd.to_datetime(end, unit="ms")})

    def close(self) -> None:
        pass


def timed_window_counts(keyed: DataFrame, seconds: int = 60, spread: int = 1024) -> DataFrame:
    """Orders per user and window of processing time, given out as the window ends.

    The users are dealt to ``spread`` groups, which must stay the same over restarts; a group
    must fit into a task. The query must have a trigger interval: it runs also without new rows.
    """
    counted = keyed.select(F.col("user_id").cast("string")).mapInArrow(
        count_users, "user_id string, orders long")
    group = F.pmod(F.xxhash64("user_id"), F.lit(spread)).alias("group")
    return counted.select("user_id", "orders", group).groupBy("group").transformWithStateInPandas(
        WindowCounts(seconds * 1000), PARTS, "append", "ProcessingTime")


def merged(parts: DataFrame) -> DataFrame:
    """The windows, where a user may have several parts of one."""
    return parts.groupBy("user_id", "window_start", "window_end").agg(
        F.sum("order_count").alias("order_count"))


def append_timed_counts(keyed: DataFrame, path: str, *, seconds: int = 60, spread: int = 1024,
                        checkpoint: str | None = None, every: str = "1 second") -> StreamingQuery:
    """Write each window once, in the batch that follows its end."""
    parts = timed_window_counts(keyed, seconds, spread)
    return append_files(parts, path, checkpoint=checkpoint, every=every)


def read_timed_counts(spark: SparkSession, path: str) -> DataFrame:
    """The windows that have ended. A batch is read whole or not at all, so are its windows."""
    return merged(spark.read.schema(PARTS).parquet(path))


def run_until(spark: SparkSession, query: StreamingQuery, path: str, orders: int,
              seconds: float = 300.0) -> None:
    """Wait until the windows below ``path`` hold so many orders, and stop the query.

    It is an error if for so many ``seconds`` no batch ends that takes rows or closes windows.
    """
    until, seen, found = time.monotonic() + seconds, None, 0
    try:
        while True:
            if query.exception() is not None:
                raise query.exception()
            progress = query.lastProgress
            if progress and progress["batchId"] != seen:
                seen, before = progress["batchId"], found
                found = read_timed_counts(spark, path).agg(F.sum("order_count")).first()[0] or 0
                if found >= orders:
                    return
                if found > before or progress["numInputRows"]:
                    until = time.monotonic() + seconds
            if time.monotonic() > until:
                raise TimeoutError(f"windows of {orders} orders did not end: none did in the "
                                   f"last {seconds} s")
            time.sleep(0.5)
    finally:
        query.stop()
