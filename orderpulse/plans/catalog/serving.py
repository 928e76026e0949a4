"""Reads over published results and stored items."""

from pyspark.sql import functions as F

from orderpulse.functions.customers import vip_filter
from orderpulse.operators import serving as op
from orderpulse.plans.catalog.common import (EV, ITEMS, ORD, RESULTS, money, query,
                                             with_)
from orderpulse.sources import fixtures as fx

LATEST = """latest AS (
  SELECT * FROM results WHERE user_id <> ''
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY window_end DESC, arrival) = 1)"""

LAST = """last AS (
  SELECT * FROM results
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY arrival DESC) = 1)"""


@query("user_results", with_(EV, RESULTS) + "SELECT * FROM results")
def user_results(spark, d):
    return fx.user_results(spark, d)


@query("has_user_id", with_(EV, RESULTS) + "SELECT * FROM results WHERE user_id <> ''")
def has_user_id(spark, d):
    return op.has_user_id(fx.user_results(spark, d))


@query("has_user_id_numeric", "SELECT * FROM events WHERE user_id <> 0")
def has_user_id_numeric(spark, d):
    return op.has_user_id(fx.table(spark, d, "events"))


@query("vip_filter", with_(EV, RESULTS) + """
SELECT * FROM results WHERE is_vip OR total_spent > 10000""")
def vips(spark, d):
    return fx.user_results(spark, d).filter(vip_filter(F.col("is_vip"), F.col("total_spent")))


@query("stream_row_defaults", with_(EV, RESULTS) + """
SELECT user_id, arrival, CASE WHEN is_vip THEN total_spent ELSE 0 END AS total_spent,
       is_vip, CASE WHEN is_vip THEN window_end ELSE '' END AS window_end FROM results""")
def stream_row_defaults(spark, d):
    known = F.col("is_vip")
    gaps = fx.user_results(spark, d).select(
        "user_id", "arrival", F.when(known, F.col("total_spent")).alias("total_spent"),
        F.when(known, known).alias("is_vip"),
        F.when(known, F.col("window_end")).alias("window_end"))
    return op.stream_row_defaults(gaps)


@query("latest_per_user", with_(EV, RESULTS, LATEST) + "SELECT * FROM latest")
def latest_per_user(spark, d):
    return op.latest_per_user(fx.user_results(spark, d))


@query("last_arrival_per_user", with_(EV, RESULTS, LAST) + "SELECT * FROM last")
def last_arrival_per_user(spark, d):
    return op.last_arrival_per_user(fx.user_results(spark, d))


@query("top_users", with_(EV, RESULTS, LATEST) + """
SELECT * FROM latest ORDER BY total_spent DESC, user_id LIMIT 10""")
def top_users(spark, d):
    return op.top_users(fx.user_results(spark, d))


@query("top_vip_users", with_(EV, RESULTS, LAST) + """
SELECT * FROM last WHERE is_vip OR total_spent > 10000
ORDER BY total_spent DESC, user_id LIMIT 10""")
def top_vip_users(spark, d):
    return op.top_vip_users(fx.user_results(spark, d))


@query("users_analyzed", with_(EV, RESULTS) + """
SELECT count(DISTINCT user_id) AS total_users_analyzed FROM results""")
def users_analyzed(spark, d):
    return op.users_analyzed(fx.user_results(spark, d))


@query("result_counters", with_(EV, RESULTS, LAST) + """
SELECT (SELECT count(*) FROM results) AS messages_processed,
       (SELECT count(*) FROM last) AS total_users,
       least(count(*), 10) AS vip_count, count(*) AS vip_total
FROM last WHERE is_vip OR total_spent > 10000""")
def result_counters(spark, d):
    return op.result_counters(fx.user_results(spark, d))


@query("analytics_summary", with_(EV, ITEMS) + """
SELECT CAST(sum(order_count) AS BIGINT) AS total_orders,
       round(sum(total_revenue), 2) AS total_revenue,
       count(DISTINCT nullif(user_id, '')) AS unique_users, count(*) AS data_points
FROM items""")
def analytics_summary(spark, d):
    return op.analytics_summary(fx.analytics_items(spark, d))


@query("analytics_summary_limited", with_(EV, ITEMS) + """
SELECT CAST(sum(order_count) AS BIGINT) AS total_orders,
       round(sum(total_revenue), 2) AS total_revenue,
       count(DISTINCT nullif(user_id, '')) AS unique_users, count(*) AS data_points
FROM (SELECT * FROM items ORDER BY window_id LIMIT 100)""")
def analytics_summary_limited(spark, d):
    return op.analytics_summary(fx.analytics_items(spark, d), max_rows=100)


@query("recent_windows", with_(EV, ITEMS) + """
SELECT * EXCLUDE (user_id) FROM items ORDER BY "timestamp" DESC, window_id LIMIT 10""")
def recent_windows(spark, d):
    return op.recent_windows(fx.analytics_items(spark, d)).drop("user_id")


@query("recent_windows_limited", with_(EV, ITEMS) + """
SELECT * EXCLUDE (user_id) FROM (SELECT * FROM items ORDER BY window_id LIMIT 20)
ORDER BY "timestamp" DESC, window_id LIMIT 10""")
def recent_windows_limited(spark, d):
    return op.recent_windows(fx.analytics_items(spark, d), max_rows=20).drop("user_id")


@query("scan_limited", with_(EV, ITEMS) + """
SELECT * EXCLUDE (user_id) FROM items ORDER BY window_id LIMIT 100""")
def scan_limited(spark, d):
    return op.scan_limited(fx.analytics_items(spark, d), 100, "window_id").drop("user_id")


@query("lookup_order", with_(ORD) + f"""
SELECT id, user_id, product_id, quantity, {money('cents')} AS total_price, status, created_at
FROM ord WHERE id = 42""")
def lookup_order(spark, d):
    return op.lookup_by_key(fx.orders(spark, d), "id", 42)


@query("lookup_user", """
SELECT c_custkey AS id, c_name AS name, c_name || '@example.com' AS email
FROM customer WHERE c_custkey = 42""")
def lookup_user(spark, d):
    return op.lookup_by_key(fx.users(spark, d), "id", 42).drop("created_at")


@query("lookup_product", """
SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS name, p_retailprice AS price,
       CAST(p_size AS BIGINT) AS stock, p_type AS category
FROM part WHERE p_partkey = 42""")
def lookup_product(spark, d):
    return op.lookup_by_key(fx.products(spark, d), "product_id", "42")


@query("lookup_window", with_(EV, ITEMS) + """
SELECT * EXCLUDE (user_id) FROM items WHERE window_id = 'window-1704067200'""")
def lookup_window(spark, d):
    return op.lookup_by_key(fx.analytics_items(spark, d), "window_id",
                            "window-1704067200").drop("user_id")


@query("lookup_missing", "SELECT c_custkey AS id FROM customer WHERE c_custkey = -1")
def lookup_missing(spark, d):
    return op.lookup_by_key(fx.users(spark, d), "id", -1).select("id")
