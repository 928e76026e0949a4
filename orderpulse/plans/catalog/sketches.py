"""Rollups of stored windows by sketches, held against exact counts.

The queries give out the exact value and whether the answer of the sketch is within its bound.
"""

from pyspark.sql import functions as F

from orderpulse.operators import sketches as op
from orderpulse.plans.catalog.common import EV, money, query, window_sql, with_
from orderpulse.plans.catalog.streams import CLOSED
from orderpulse.session import fresh_path
from orderpulse.sources import fixtures as fx
from orderpulse.streaming import queries as streams
from orderpulse.streaming import sinks


def against_exact(spark, d, rolled, size):
    """Rolled-up windows beside the exact number of their users."""
    exact = fx.order_events(spark, d).groupBy(F.window("timestamp", size)["start"].alias(
        "window_start")).agg(F.countDistinct("user_id").alias("exact_users"))
    off = F.abs(op.unique_users(F.col("users")) - F.col("exact_users"))
    return rolled.join(exact, "window_start").select(
        "window_start", "window_end", "total_orders", "total_revenue", "exact_users",
        (off <= F.ceil(F.col("exact_users") * op.USERS_WITHIN)).alias("within_bound"))


def exact_sql(size: str) -> str:
    return f"""
SELECT time_bucket(INTERVAL {size}, ts) AS window_start,
       time_bucket(INTERVAL {size}, ts) + INTERVAL {size} AS window_end,
       count(*) AS total_orders, {money('sum(cents)')} AS total_revenue,
       count(DISTINCT user_id) AS exact_users, true AS within_bound
FROM ev GROUP BY 1, 2"""


def stored_minutes(spark, d):
    path = fresh_path(spark, "minutes")
    op.window_sketches(fx.order_events(spark, d)).write.parquet(path)
    return spark.read.parquet(path)


@query("users_per_hour_from_minutes", with_(EV) + exact_sql("1 HOUR"))
def users_per_hour(spark, d):
    return against_exact(spark, d, op.roll_up(stored_minutes(spark, d), "1 hour"), "1 hour")


@query("users_per_day_from_hours", with_(EV) + exact_sql("1 DAY"))
def users_per_day(spark, d):
    hours = op.roll_up(stored_minutes(spark, d), "1 hour")
    return against_exact(spark, d, op.roll_up(hours, "1 day"), "1 day")


@query("sketched_summary", with_(EV) + f"""
SELECT count(*) AS total_orders, {money('sum(cents)')} AS total_revenue,
       count(DISTINCT user_id) AS exact_users,
       count(DISTINCT time_bucket(INTERVAL 1 MINUTE, ts)) AS data_points, true AS within_bound
FROM ev""")
def sketched_summary(spark, d):
    exact = fx.order_events(spark, d).agg(F.countDistinct("user_id").alias("exact_users"))
    both = op.sketched_summary(stored_minutes(spark, d)).unionByName(
        exact, allowMissingColumns=True)
    # One row of each, put side by side.
    row = both.agg(*(F.max(c).alias(c) for c in both.columns))
    off = F.abs(F.col("unique_users") - F.col("exact_users"))
    return row.select(
        "total_orders", "total_revenue", "exact_users", "data_points",
        (off <= F.ceil(F.col("exact_users") * op.USERS_WITHIN)).alias("within_bound"))


@query("stream_users_per_hour", with_(EV) + f"""
SELECT time_bucket(INTERVAL 1 HOUR, window_start) AS window_start,
       CAST(sum(total_orders) AS BIGINT) AS total_orders, true AS within_bound
FROM ({window_sql(1)}) WHERE {CLOSED} GROUP BY 1""")
def stream_users_per_hour(spark, d):
    # A stream stores the minutes; the hours are read from them.
    path = fresh_path(spark, "stream")
    minutes = op.window_sketches(streams.with_event_time(fx.order_events_stream(spark, d)))
    sinks.append_files(minutes, path).awaitTermination()
    hours = op.roll_up(spark.read.schema(minutes.schema).parquet(path), "1 hour")
    events = fx.order_events(spark, d)
    stored = spark.read.schema(minutes.schema).parquet(path).select("window_start")
    exact = (events.withColumn("window_start", F.window("timestamp", "1 minute")["start"])
             .join(stored, "window_start", "left_semi")
             .groupBy(F.window("window_start", "1 hour")["start"].alias("window_start"))
             .agg(F.countDistinct("user_id").alias("exact_users")))
    off = F.abs(op.unique_users(F.col("users")) - F.col("exact_users"))
    return hours.join(exact, "window_start").select(
        "window_start", "total_orders",
        (off <= F.ceil(F.col("exact_users") * op.USERS_WITHIN)).alias("within_bound"))


@query("percentiles_per_endpoint", """
SELECT event_type AS endpoint, time_bucket(INTERVAL 1 DAY, ts) AS window_start,
       count(*) AS requests, count(*) FILTER (event_type = 'error') AS failures,
       true AS p50_within, true AS p95_within
FROM events GROUP BY 1, 2""")
def percentiles_per_endpoint(spark, d):
    # Minutes to hours to days; the rank of each answer is counted on the requests.
    requests = fx.requests(spark, d)
    days = op.roll_up_durations(op.roll_up_durations(op.duration_sketches(requests), "1 hour"),
                                "1 day")
    days = days.select("endpoint", "window_start", "requests", "failures", *(
        op.percentile(F.col("durations"), p).alias(n) for n, p in (("p50", 0.5), ("p95", 0.95))))
    each = requests.withColumn("window_start", F.window("ts", "1 day")["start"]).join(
        days, ["endpoint", "window_start"])
    value = F.col("duration_ms")

    def within(name, p):
        below, upto = F.avg((value < F.col(name)).cast("int")), F.avg((value <= F.col(name)).cast("int"))
        slack = op.RANK_WITHIN + 1 / F.count(value)
        return ((below <= p + slack) & (upto >= p - slack)).alias(f"{name}_within")

    return each.groupBy("endpoint", "window_start", "requests", "failures").agg(
        within("p50", 0.5), within("p95", 0.95))
