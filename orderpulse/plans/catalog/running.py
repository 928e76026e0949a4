"""Lifetime statistics per user."""

from pyspark.sql import functions as F

from orderpulse.operators import events as ev
from orderpulse.operators import running as op
from orderpulse.operators import serving as sv
from orderpulse.plans.catalog.common import (EV, STATS_COLUMNS, as_double, iso, mean_money,
                                             money, query, tier, with_)
from orderpulse.sources import fixtures as fx

FIRST_LAST = "arg_min(ts, arrival) AS first_order, arg_max(ts, arrival) AS last_order"

# What is left of the faulty messages: no JSON is gone, and per event type the
# price is unusable, or a default.
FAULTY = """bad AS (
  SELECT event_type, event_id AS arrival, ts,
         CASE WHEN event_type <> 'signup' THEN CAST(user_id AS VARCHAR) END AS user_id,
         event_type <> 'view' AS usable,
         CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 0
              ELSE CAST(round(value * 100) AS BIGINT) * (event_id % 5 + 1) END AS cents
  FROM events WHERE event_type <> 'error')"""


@query("user_running_stats", with_(EV) + f"""
SELECT {STATS_COLUMNS}, {FIRST_LAST} FROM ev GROUP BY user_id""")
def user_running_stats(spark, d):
    return op.user_running_stats(fx.order_events(spark, d))


@query("user_running_stats_bad_dropped", with_(FAULTY) + f"""
SELECT coalesce(user_id, 'None') AS user_id, count(*) AS total_orders,
       {money('sum(cents)')} AS total_spent,
       {mean_money('sum(cents)', 'count(*)')} AS avg_order_value,
       {tier('sum(cents)')} AS customer_tier, sum(cents) > 1000000 AS is_vip, {FIRST_LAST}
FROM bad WHERE usable GROUP BY 1""")
def user_running_stats_bad_dropped(spark, d):
    raw = fx.as_read(fx.faulty_messages(spark, d))
    return op.user_running_stats(ev.cast_with_defaults(raw, missing_user="None"))


@query("user_running_stats_bad_counted", with_(FAULTY) + f"""
SELECT user_id, count(*) AS total_orders, {money('sum(cents)')} AS total_spent,
       {mean_money('sum(cents)', 'count(*)')} AS avg_order_value,
       {tier('sum(cents)')} AS customer_tier, sum(cents) > 1000000 AS is_vip, {FIRST_LAST}
FROM bad GROUP BY user_id""")
def user_running_stats_bad_counted(spark, d):
    raw = fx.as_read(fx.faulty_messages(spark, d))
    return op.user_running_stats(ev.cast_with_defaults(raw), "count_only")


@query("user_running_stats_basic", with_(FAULTY) + f"""
SELECT user_id, count(*) AS total_orders, {money('sum(cents)')} AS total_spent,
       {mean_money('sum(cents)', 'count(*)')} AS avg_order_value
FROM bad GROUP BY user_id""")
def user_running_stats_basic(spark, d):
    raw = fx.as_read(fx.faulty_messages(spark, d))
    return op.user_running_stats_basic(ev.cast_with_defaults(raw))


@query("first_last_by_arrival", with_(EV) + f"""
SELECT user_id, {FIRST_LAST} FROM ev GROUP BY user_id""")
def first_last_by_arrival(spark, d):
    return op.first_last_by_arrival(fx.order_events(spark, d))


@query("publish_rows", with_(EV) + f"""
SELECT {STATS_COLUMNS}, {iso('arg_min(ts, arrival)')} AS first_order,
       {iso('arg_max(ts, arrival)')} AS last_order,
       '2024-02-01T00:00:00+00:00' AS window_end
FROM ev GROUP BY user_id""")
def publish_rows(spark, d):
    stats = op.user_running_stats(fx.order_events(spark, d))
    return op.published(stats, F.lit("2024-02-01").cast("timestamp"))


@query("publish_summary", with_(EV) + """
SELECT count(*) AS users, count(*) FILTER (spent > 1000000) AS vips
FROM (SELECT sum(cents) AS spent FROM ev GROUP BY user_id)""")
def publish_summary(spark, d):
    return op.publish_summary(op.user_running_stats(fx.order_events(spark, d)))


@query("vip_leaderboard", with_(EV) + f"""
SELECT user_id, total_orders, total_spent, avg_order_value, customer_tier, is_vip,
       first_order, last_order, CAST(CASE WHEN place <= 3 THEN place END AS DOUBLE) AS rank
FROM (SELECT *, row_number() OVER (ORDER BY total_spent DESC, user_id) AS place
      FROM (SELECT {STATS_COLUMNS}, {FIRST_LAST} FROM ev GROUP BY user_id) WHERE is_vip)
WHERE place <= 10""")
def vip_leaderboard(spark, d):
    return as_double(sv.vip_leaderboard(op.user_running_stats(fx.order_events(spark, d))), "rank")
