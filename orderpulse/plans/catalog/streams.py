"""Streaming queries over the whole events table, run to its end.

A stream stays open at its end, so windows that the watermark has not passed are
not given out; the SQL leaves them out too.
"""

from pyspark.sql import functions as F

from orderpulse.operators import events as ev
from orderpulse.operators import windows as wi
from orderpulse.operators.running import published
from orderpulse.operators.serving import top_users
from orderpulse.plans.catalog.common import (EV, ITEMS, STATS_COLUMNS, iso, mean_money, money,
                                             query, window_sql, with_)
from orderpulse.plans.catalog.sources import land, offsets
from orderpulse.session import fresh_path
from orderpulse.sources import fixtures as fx
from orderpulse.sources import results, topics
from orderpulse.sources.snapshots import Snapshots
from orderpulse.streaming import queries as op
from orderpulse.streaming import sinks, state, timers

CLOSED = "window_end + INTERVAL 5 SECOND <= (SELECT max(ts) FROM events)"


def appended(spark, df):
    """Run an append query over all there is, and read what it wrote."""
    path = fresh_path(spark, "stream")
    sinks.append_files(df, path).awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


@query("stream_window_totals_1m", with_(EV) + f"""
SELECT * FROM ({window_sql(1)}) WHERE {CLOSED}""")
def stream_window_totals_1m(spark, d):
    return appended(spark, op.stream_window_totals(fx.order_events_stream(spark, d)))


@query("stream_window_totals_sliding", with_(EV, """slid AS (
  SELECT ev.*, time_bucket(INTERVAL 1 MINUTE, ts) - k * INTERVAL 1 MINUTE AS starts
  FROM ev, range(5) AS r(k))""") + f"""
SELECT * FROM (
  SELECT starts AS window_start, starts + INTERVAL 5 MINUTE AS window_end,
         count(DISTINCT user_id) AS unique_users, count(*) AS total_orders,
         {money('sum(cents)')} AS total_revenue,
         {mean_money('sum(cents)', 'count(*)')} AS avg_order_value
  FROM slid GROUP BY 1, 2) WHERE {CLOSED}""")
def stream_window_totals_sliding(spark, d):
    return appended(spark, op.stream_window_totals(
        fx.order_events_stream(spark, d), "5 minutes", "1 minute"))


@query("stream_order_events_json", with_(EV) + f"""
SELECT * FROM ({window_sql(1)}) WHERE {CLOSED}""")
def stream_order_events_json(spark, d):
    path = land(spark, fx.order_messages(spark, d), topics.ORDERS_TOPIC)
    events = topics.read_order_events(spark, path=path, stream=True)
    return appended(spark, op.stream_window_totals(events))


HALF = "2024-01-16 00:00:00"
THIRDS = ("2024-01-11 00:00:00", "2024-01-21 00:00:00")


@query("stream_late_rows_and_restart", with_(EV, f"""late AS (
  SELECT ts FROM ev WHERE event_type = 'error' AND ts < TIMESTAMP '{HALF}'
    AND time_bucket(INTERVAL 1 MINUTE, ts) + INTERVAL 65 SECOND <=
        (SELECT max(ts) FROM ev WHERE event_type <> 'error' AND ts < TIMESTAMP '{HALF}')),
timely AS (SELECT * FROM ev WHERE ts NOT IN (SELECT ts FROM late))""") + f"""
SELECT * FROM ({window_sql(1, 'timely')}) WHERE {CLOSED}""")
def stream_late_rows_and_restart(spark, d):
    # The errors of the first half come with the second, after a restart from the
    # checkpoint: those behind the watermark of the first run are dropped.
    events = fx.order_events(spark, d)
    kinds = fx.table(spark, d, "events").select(F.col("event_id").alias("arrival"), "event_type")
    first = (F.col("timestamp") < F.lit(HALF).cast("timestamp")) & (F.col("event_type") != "error")
    tagged = events.join(kinds, "arrival").withColumn("first", first).select(
        *events.columns, "first")
    landed, out = fresh_path(spark, "events"), fresh_path(spark, "stream")
    checkpoint = fresh_path(spark, "checkpoint")
    for part in (F.col("first"), ~F.col("first")):
        tagged.filter(part).drop("first").write.mode("append").parquet(landed)
        stream = spark.readStream.schema(events.schema).parquet(landed)
        totals = op.stream_window_totals(stream)
        sinks.append_files(totals, out, checkpoint=checkpoint).awaitTermination()
    return spark.read.schema(totals.schema).parquet(out)


@query("stream_user_window_counts_1m", with_(EV) + """
SELECT * FROM (
  SELECT user_id, count(*) AS order_count, time_bucket(INTERVAL 1 MINUTE, ts) AS window_start,
         time_bucket(INTERVAL 1 MINUTE, ts) + INTERVAL 1 MINUTE AS window_end
  FROM ev GROUP BY ALL) WHERE window_end <= (SELECT max(ts) FROM events)""")
def stream_user_window_counts_1m(spark, d):
    events = fx.order_events_stream(spark, d)
    return appended(spark, op.stream_user_window_counts(events, ts="timestamp",
                                                         delay="0 seconds"))


@query("stream_timed_window_counts", with_(EV) + """
SELECT user_id, count(*) AS order_count, true AS each_window_once FROM ev GROUP BY user_id""")
def stream_timed_window_counts(spark, d):
    # Three writes, a batch each; the last windows close by their timers, as no row follows.
    events = fx.order_events(spark, d)
    landed, path = fresh_path(spark, "events"), fresh_path(spark, "timed")
    files = spark.sparkContext.defaultParallelism
    for k in range(3):
        (events.filter(F.col("arrival") % 3 == k).repartition(files)
         .write.mode("append").parquet(landed))
    stream = (spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files)
              .parquet(landed))
    query_ = timers.append_timed_counts(stream, path, seconds=2)
    timers.run_until(spark, query_, path, events.count())
    windows = timers.read_timed_counts(spark, path)
    length = F.unix_seconds("window_end") - F.unix_seconds("window_start")
    return windows.groupBy("user_id").agg(
        F.sum("order_count").alias("order_count"),
        ((F.count(F.lit(1)) == F.countDistinct("window_start")) & (F.max(length) == 2)
         & (F.min(length) == 2)).alias("each_window_once"))


@query("stream_user_running_stats", with_(EV) + f"""
SELECT {STATS_COLUMNS}, {iso('arg_min(ts, arrival)')} AS first_order,
       {iso('arg_max(ts, arrival)')} AS last_order,
       '2024-02-01T00:00:00+00:00' AS window_end FROM ev GROUP BY user_id""")
def stream_user_running_stats(spark, d):
    path = fresh_path(spark, "published")
    stats = op.stream_user_running_stats(fx.order_events_stream(spark, d))
    sinks.publish_user_stats(stats, path, window_end=F.lit("2024-02-01").cast("timestamp"),
                             every=None).awaitTermination()
    return sinks.newest_by_key(sinks.read_batches(spark, path), "user_id")


@query("running_totals_from_state", with_(EV) + f"""
SELECT {STATS_COLUMNS}, arg_min(ts, arrival) AS first_order, arg_max(ts, arrival) AS last_order
FROM ev GROUP BY user_id""")
def running_totals_from_state(spark, d):
    # Three batches; nothing that was published is read.
    events = fx.order_events(spark, d)
    landed, checkpoint = fresh_path(spark, "events"), fresh_path(spark, "checkpoint")
    for k in range(3):
        events.filter(F.col("arrival") % 3 == k).write.mode("append").parquet(landed)
        stream = spark.readStream.schema(events.schema).parquet(landed)
        sinks.publish_user_stats(op.stream_user_running_stats(stream), fresh_path(spark, "published"),
                                 checkpoint=checkpoint, every=None).awaitTermination()
    return state.running_totals(spark, checkpoint)


@query("stream_user_running_stats_complete", with_(EV) + f"""
SELECT {STATS_COLUMNS}, {iso('arg_min(ts, arrival)')} AS first_order,
       {iso('arg_max(ts, arrival)')} AS last_order,
       '2024-02-01T00:00:00+00:00' AS window_end FROM ev GROUP BY user_id""")
def stream_user_running_stats_complete(spark, d):
    path = fresh_path(spark, "published")
    stats = op.stream_user_running_stats(fx.order_events_stream(spark, d))
    sinks.publish_user_stats(stats, path, mode="complete",
                             window_end=F.lit("2024-02-01").cast("timestamp"),
                             every=None).awaitTermination()
    return sinks.newest_by_key(sinks.read_batches(spark, path), "user_id")


@query("stream_upsert_window_items", with_(EV, ITEMS) + """
SELECT * EXCLUDE (user_id) FROM items
WHERE CAST("timestamp" AS TIMESTAMP) + INTERVAL 5 SECOND <= (SELECT max(ts) FROM events)""")
def stream_upsert_window_items(spark, d):
    path = fresh_path(spark, "upserts")
    items = wi.analytics_items(op.stream_window_totals(fx.order_events_stream(spark, d)))
    sinks.upsert_window_items(items, path).awaitTermination()
    return sinks.newest_by_key(sinks.read_batches(spark, path), "window_id").drop("user_id")


@query("stream_upsert_snapshots", with_(EV, ITEMS) + """
SELECT * EXCLUDE (user_id) FROM items
WHERE CAST("timestamp" AS TIMESTAMP) + INTERVAL 5 SECOND <= (SELECT max(ts) FROM events)""")
def stream_upsert_snapshots(spark, d):
    # Three batches of one query; the table is folded after the first and the second, so
    # the last read meets base files and an open delta.
    events = fx.order_events(spark, d)
    landed, checkpoint = fresh_path(spark, "events"), fresh_path(spark, "checkpoint")
    schema = wi.analytics_items(wi.window_totals(events)).schema
    table = Snapshots(spark, fresh_path(spark, "items"), schema, "window_id")
    cuts = [F.lit(cut).cast("timestamp") for cut in THIRDS]
    time = F.col("timestamp")
    for n, part in enumerate((time < cuts[0], (time >= cuts[0]) & (time < cuts[1]),
                              time >= cuts[1])):
        events.filter(part).write.mode("append").parquet(landed)
        stream = spark.readStream.schema(events.schema).parquet(landed)
        items = wi.analytics_items(op.stream_window_totals(stream))
        sinks.upsert_snapshots(items, table, checkpoint=checkpoint).awaitTermination()
        if n < 2:
            table.fold()
    return table.read().drop("user_id")


@query("stream_windows_counter", with_(EV) + f"""
SELECT count(*) AS windows FROM ({window_sql(1)}) WHERE {CLOSED}""")
def stream_windows_counter(spark, d):
    totals = sinks.watch(spark)
    counted = op.count_windows(op.stream_window_totals(fx.order_events_stream(spark, d)))
    query_ = sinks.append_files(counted, fresh_path(spark, "stream"))
    query_.awaitTermination()
    return spark.range(1).select(F.lit(totals.observed(query_)).cast("bigint").alias("windows"))


@query("stream_deduplicate", with_(EV) + """
SELECT user_id AS order_id, min(ts) AS first_seen, 1::BIGINT AS copies
FROM ev GROUP BY user_id""")
def stream_deduplicate(spark, d):
    # Users stand for order ids, so that every id has copies all over the table.
    events = fx.order_events_stream(spark, d).withColumn("order_id", F.col("user_id"))
    kept = appended(spark, op.deduplicate_stream(events, within="60 days"))
    seen = fx.order_events(spark, d).groupBy(F.col("user_id").alias("order_id")).agg(
        F.min("timestamp").alias("first_seen"))
    copies = kept.groupBy("order_id").agg(F.count(F.lit(1)).alias("copies"))
    return seen.join(copies, "order_id")


@query("stream_rejects", """
SELECT 'no json ' || CAST(user_id AS VARCHAR) AS value, event_id AS arrival,
       ts AS "timestamp", 'malformed json' AS reason FROM events
WHERE event_type = 'error'""")
def stream_rejects(spark, d):
    path = land(spark, fx.faulty_messages(spark, d), topics.ORDERS_TOPIC)
    raw = topics.read_topic(spark, path=path, stream=True)
    return offsets(appended(spark, ev.rejects(raw)))


@query("notify_orders", with_(EV) + """
SELECT order_id, user_id, 'Notification sent for order ' || order_id AS message FROM ev""")
def notify_orders(spark, d):
    return appended(spark, op.notifications(fx.order_events_stream(spark, d)))


@query("stream_topic_sink", with_(EV) + f"""
SELECT * FROM ({window_sql(1)}) WHERE {CLOSED}""")
def stream_topic_sink(spark, d):
    path = fresh_path(spark, "topics")
    totals = op.stream_window_totals(fx.order_events_stream(spark, d))
    sinks.publish(totals, path=path).awaitTermination()
    row = F.from_json("value", "window_start timestamp, window_end timestamp, "
                      "unique_users bigint, total_orders bigint, "
                      "total_revenue decimal(38,2), avg_order_value decimal(38,2)")
    return (topics.read_topic(spark, topics.RESULTS_TOPIC, path=path, start="earliest")
            .select(row.alias("row")).select("row.*"))


@query("stream_stats_to_top_users", with_(EV) + f"""
SELECT {STATS_COLUMNS}, {iso('arg_min(ts, arrival)')} AS first_order,
       {iso('arg_max(ts, arrival)')} AS last_order,
       '2024-02-01T00:00:00+00:00' AS window_end
FROM ev GROUP BY user_id ORDER BY total_spent DESC, user_id LIMIT 10""")
def stream_stats_to_top_users(spark, d):
    # Order messages, running statistics, the results topic, and the serving read.
    path = land(spark, fx.order_messages(spark, d), topics.ORDERS_TOPIC)
    end = F.lit("2024-02-01").cast("timestamp")
    stats = op.stream_user_running_stats(topics.read_order_dicts(spark, path=path, stream=True))
    sinks.publish(stats, path=path, mode="update",
                  shape=lambda batch: published(batch, end)).awaitTermination()
    return top_users(results.read_results_bounded(spark, path=path)).drop("arrival")
