"""Customer insight over the orders table."""

from pyspark.sql import functions as F

from orderpulse.operators import insight as op
from orderpulse.plans.catalog.common import ORD, mean_money, money, query, tier, with_
from orderpulse.sources import fixtures as fx

STATS = f"""stats AS (
  SELECT user_id, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents FROM ord
  GROUP BY user_id)"""

PROFILE = """profile AS (
  SELECT c_custkey AS user_id, c_name AS name, c_name || '@example.com' AS email,
         coalesce(n, 0) AS n, coalesce(cents, 0) AS cents,
         CASE WHEN n > 0 THEN (2 * cents + n) // (2 * n) ELSE 0 END AS mean_cents
  FROM customer LEFT JOIN stats ON c_custkey = user_id)"""

RECOMMENDED = """concat_ws('|',
    CASE WHEN n > 5 THEN 'Loyalty reward eligible - 10% discount on next order' END,
    CASE WHEN mean_cents > 100000 THEN 'Premium customer - priority shipping available' END,
    CASE WHEN cents > 2000000 THEN 'Top VIP - personal account manager assigned' END)"""

DERIVED = f"""n AS total_orders, {money('cents')} AS total_spent,
       {money('mean_cents')} AS average_order_value, {tier('cents')} AS customer_tier,
       {RECOMMENDED} AS recommendations,
       CASE WHEN cents > 1000000 THEN 'High Spender' WHEN cents > 100000
            THEN 'Moderate Spender' ELSE 'New Customer' END AS spending_category,
       CAST(least(100, n * 10 + cents // 10000) AS BIGINT) AS loyalty_score,
       {money('(cents * 3 + 1) // 2')} AS predicted_lifetime_value"""


@query("user_order_stats", with_(ORD) + f"""
SELECT user_id, count(*) AS total_orders, {money('sum(cents)')} AS total_spent,
       {mean_money('sum(cents)', 'count(*)')} AS average_order_value
FROM ord GROUP BY user_id""")
def user_order_stats(spark, d):
    return op.user_order_stats(fx.orders(spark, d))


@query("user_order_profile", with_(ORD, STATS, PROFILE) + f"""
SELECT user_id, name, email, {DERIVED} FROM profile""")
def user_order_profile(spark, d):
    return op.user_order_profile(fx.users(spark, d), fx.orders(spark, d))


@query("user_insight", with_(ORD, STATS, PROFILE) + f"""
SELECT user_id, name, email, {DERIVED} FROM profile""")
def user_insight(spark, d):
    nested = op.user_insight(op.user_order_profile(fx.users(spark, d), fx.orders(spark, d)))
    return nested.select("user_info.*", "order_analytics.*", "recommendations", "insights.*")


@query("user_insight_one_user", with_(ORD, STATS, PROFILE) + f"""
SELECT user_id, name, email, {DERIVED} FROM profile WHERE user_id = 7""")
def user_insight_one_user(spark, d):
    profile = op.user_order_profile(fx.users(spark, d), fx.orders(spark, d))
    return profile.filter(F.col("user_id") == 7)


@query("orders_for_user", with_(ORD) + f"""
SELECT id, user_id, product_id, quantity, {money('cents')} AS total_price, status, created_at
FROM ord WHERE user_id = 7""")
def orders_for_user(spark, d):
    return op.orders_for_user(fx.orders(spark, d), "7")
