"""Streaming transformations; each returns a streaming DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderpulse.functions.jsontext import to_json_result
from orderpulse.operators.running import user_running_stats
from orderpulse.operators.windows import user_window_counts, window_totals

LATENESS = "5 seconds"  # fixed value: how far event time may run behind


def with_event_time(events: DataFrame, ts: str = "timestamp",
                    delay: str = LATENESS) -> DataFrame:
    """Declare event time; rows further behind than ``delay`` are dropped by the
    aggregate that follows."""
    return events.withWatermark(ts, delay)


def stream_window_totals(events: DataFrame, size: str = "1 minute", slide: str | None = None,
                         delay: str = LATENESS) -> DataFrame:
    """Window totals, each window once, after the watermark has passed its end.

    State is one small row per window and user, spread over all keys, and goes
    away with its window.
    """
    return window_totals(with_event_time(events, delay=delay), size, slide)


def stream_user_window_counts(keyed: DataFrame, size: str = "1 minute",
                              ts: str | None = None, heartbeat: bool = False,
                              delay: str | None = None) -> DataFrame:
    """Orders per user and window of processing time.

    The time of arrival is the time of the micro-batch, which never runs late, so the
    watermark has no slack and bounds the state. Or it is the column ``ts``, such as the
    broker's; partitions then lag behind each other, and ``delay`` must say by how much
    at most: rows later than that are dropped. A window is given out by the first batch with rows after its end;
    with ``heartbeat`` a clock row each second stands in for them; it moves the
    watermark and is not counted.
    """
    if (ts is None) != (delay is None):
        raise ValueError("ts and delay go together")
    when = F.col(ts) if ts else F.current_timestamp()
    arrived = keyed.select("user_id", when.alias("ingest_ts"), F.lit(False).alias("beat"))
    if heartbeat:
        clock = (keyed.sparkSession.readStream.format("rate")
                 .option("rowsPerSecond", 1).option("numPartitions", 1).load())
        arrived = arrived.unionByName(clock.select(
            F.lit(None).cast("string").alias("user_id"),
            F.current_timestamp().alias("ingest_ts"), F.lit(True).alias("beat")))
    timed = arrived.withWatermark("ingest_ts", delay or "0 seconds")
    counts = user_window_counts(timed, size, count=F.count_if(~F.col("beat")))
    return counts.filter("order_count > 0") if heartbeat else counts


def stream_user_running_stats(events: DataFrame, on_bad_value: str = "drop") -> DataFrame:
    """Lifetime statistics per user. State is one row per user and stays for ever.

    In ``complete`` mode every batch gives out all users; ``update`` gives out only
    those that changed, which is what a large number of users calls for.
    """
    return user_running_stats(events, on_bad_value)


def deduplicate_stream(events: DataFrame, key: str = "order_id", ts: str = "timestamp",
                       within: str = "10 minutes", spread: int = 16,
                       position: str = "arrival") -> DataFrame:
    """Each key once; copies that come within the delay are dropped.

    The copies of one key are first spread over ``spread`` tasks by their
    ``position``, each of which lets one through, so that a key with very many
    copies does not load one task with all of them. With ``spread`` 1 there is
    one stage, which halves the state where copies are known to be few.
    """
    timed = events.withWatermark(ts, within)
    if spread > 1:
        salt = F.pmod(F.xxhash64(position), F.lit(spread))
        timed = (timed.withColumn("_salt", salt)
                 .dropDuplicatesWithinWatermark([key, "_salt"]).drop("_salt"))
    return timed.dropDuplicatesWithinWatermark([key])


def count_windows(df: DataFrame, name: str = "windows") -> DataFrame:
    """Count rows on the way; the number is in the query progress under ``name``."""
    return df.observe(name, F.count(F.lit(1)).alias(name))


def notifications(events: DataFrame) -> DataFrame:
    """One outbox row per order event."""
    return events.select(
        "order_id", "user_id",
        F.concat(F.lit("Notification sent for order "),
                 F.coalesce("order_id", F.lit("None"))).alias("message"))


def user_count_messages(counts: DataFrame) -> DataFrame:
    """Per-user window counts as JSON text, the window bounds in epoch milliseconds."""
    return counts.select(to_json_result(
        "user_id", "order_count",
        F.unix_millis("window_start").alias("window_start"),
        F.unix_millis("window_end").alias("window_end"),
        F.unix_millis(F.current_timestamp()).alias("processing_time")).alias("value"))
