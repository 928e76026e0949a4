"""Windowed totals and counts."""

from pyspark.sql import functions as F

from orderpulse.functions.times import window_bounds
from orderpulse.operators import orders as od
from orderpulse.operators import windows as op
from orderpulse.plans.catalog.common import EV, mean_money, money, query, window_sql, with_
from orderpulse.sources import fixtures as fx


@query("window_totals_1m", with_(EV) + window_sql(1))
def window_totals_1m(spark, d):
    return op.window_totals(fx.order_events(spark, d))


@query("window_totals_5m", with_(EV) + window_sql(5))
def window_totals_5m(spark, d):
    return op.window_totals(fx.order_events(spark, d), "5 minutes")


@query("window_totals_sliding", with_(EV, """slid AS (
  SELECT ev.*, time_bucket(INTERVAL 1 MINUTE, ts) - k * INTERVAL 1 MINUTE AS starts
  FROM ev, range(5) AS r(k))""") + f"""
SELECT starts AS window_start, starts + INTERVAL 5 MINUTE AS window_end,
       count(DISTINCT user_id) AS unique_users, count(*) AS total_orders,
       {money('sum(cents)')} AS total_revenue,
       {mean_money('sum(cents)', 'count(*)')} AS avg_order_value
FROM slid GROUP BY 1, 2""")
def window_totals_sliding(spark, d):
    return op.window_totals(fx.order_events(spark, d), "5 minutes", "1 minute")


@query("user_window_counts_1m", with_(EV) + """
SELECT user_id, count(*) AS order_count, time_bucket(INTERVAL 1 MINUTE, ts) AS window_start,
       time_bucket(INTERVAL 1 MINUTE, ts) + INTERVAL 1 MINUTE AS window_end
FROM ev GROUP BY ALL""")
def user_window_counts_1m(spark, d):
    return op.user_window_counts(fx.order_events(spark, d), ts="timestamp")


@query("window_bounds", """
SELECT event_id, time_bucket(INTERVAL 1 MINUTE, ts) AS window_start,
       time_bucket(INTERVAL 1 MINUTE, ts) + INTERVAL 1 MINUTE AS window_end FROM events""")
def bounds(spark, d):
    events = fx.order_events(spark, d)
    return events.withColumn("w", F.window("timestamp", "1 minute")).select(
        F.col("arrival").alias("event_id"), *window_bounds(F.col("w")))


@query("order_rate", with_(EV) + f"""
SELECT window_start, total_orders / 1.0 AS orders_per_minute, total_revenue, avg_order_value
FROM ({window_sql(1)})""")
def order_rate(spark, d):
    return od.order_rate(op.window_totals(fx.order_events(spark, d)))


@query("window_anomalies", with_(EV, f"""w AS ({window_sql(1)}),
h AS (SELECT *, count(*) OVER before AS n, avg(total_revenue) OVER before AS mean,
             stddev_samp(total_revenue) OVER before AS deviation
      FROM w WINDOW before AS (ORDER BY window_start
        RANGE BETWEEN INTERVAL 60 MINUTE PRECEDING AND INTERVAL 1 SECOND PRECEDING)),
z AS (SELECT *, CASE WHEN n >= 3 AND deviation > 0
                     THEN (total_revenue - mean) / deviation END AS score FROM h)""") + """
SELECT window_start, window_end, total_revenue AS value, round(score, 6) AS z_score,
       coalesce(abs(score) > 3, false) AS is_anomaly FROM z""")
def window_anomalies(spark, d):
    found = od.window_anomalies(op.window_totals(fx.order_events(spark, d)))
    return found.withColumn("z_score", F.round("z_score", 6))


@query("analytics_items", with_(EV, """items AS (
  SELECT 'window-' || CAST(CAST(epoch(window_start) AS BIGINT) AS VARCHAR) AS window_id,
         strftime(window_end, '%Y-%m-%dT%H:%M:%S') AS "timestamp",
         total_orders AS order_count, total_revenue, unique_users FROM (""" + window_sql(1)
                              + "))") + "SELECT * FROM items")
def analytics_items(spark, d):
    return fx.analytics_items(spark, d).drop("user_id", "window_start", "window_end")
