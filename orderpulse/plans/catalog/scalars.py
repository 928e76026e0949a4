"""Scalar functions, each over a whole table."""

from pyspark.sql import functions as F

from orderpulse.functions import customers as cu
from orderpulse.functions import money as mo
from orderpulse.functions.times import iso_utc, parse_iso, window_id
from orderpulse.operators.insight import user_order_profile
from orderpulse.operators.running import user_running_stats
from orderpulse.plans.catalog.common import EV, iso, mean_money, money, query, tier, with_
from orderpulse.sources import fixtures as fx

SPENT = """s AS (SELECT user_id, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents,
                        CAST((2 * sum(cents) + count(*)) // (2 * count(*)) AS BIGINT) AS mean_cents
                 FROM ev GROUP BY user_id)"""


def _stats(spark, d):
    return user_running_stats(fx.order_events(spark, d))


@query("order_revenue", with_(EV) + f"""
SELECT arrival AS event_id, {money('cents')} AS revenue FROM ev""")
def order_revenue(spark, d):
    return fx.order_events(spark, d).select(
        F.col("arrival").alias("event_id"),
        mo.order_revenue(F.col("price"), F.col("quantity")).alias("revenue"))


@query("money_round", with_(EV) + f"""
SELECT arrival AS event_id, {money('(price_cents + 1) // 2')} AS half FROM ev""")
def money_round(spark, d):
    half = F.col("price") * F.lit("0.5").cast("decimal(2,1)")
    return fx.order_events(spark, d).select(F.col("arrival").alias("event_id"),
                                            mo.money_round(half).alias("half"))


@query("money_to_double", """
SELECT o_orderkey AS id, CAST(o_totalprice AS DOUBLE) AS total_price FROM orders""")
def money_to_double(spark, d):
    return fx.orders(spark, d).select(
        "id", mo.money_to_double(F.col("total_price")).alias("total_price"))


@query("safe_average", with_(EV) + f"""
SELECT c_custkey AS id, CASE WHEN count(arrival) = 0 THEN 0 ELSE
       {mean_money('coalesce(sum(cents), 0)', 'greatest(count(arrival), 1)')} END AS mean
FROM customer LEFT JOIN ev ON user_id = CAST(c_custkey AS VARCHAR) GROUP BY c_custkey""")
def safe_average(spark, d):
    # Most customers have no event, so the count is 0.
    events = fx.order_events(spark, d).withColumn(
        "total_price", mo.order_revenue(F.col("price"), F.col("quantity")))
    profile = user_order_profile(fx.users(spark, d), events)
    return profile.select(F.col("user_id").alias("id"),
                          mo.safe_average(F.col("total_spent"), F.col("total_orders"))
                          .alias("mean"))


@query("customer_tier", with_(EV, SPENT) + f"""
SELECT user_id, {tier('cents')} AS customer_tier FROM s""")
def customer_tier(spark, d):
    return _stats(spark, d).select("user_id",
                                   cu.customer_tier(F.col("total_spent")).alias("customer_tier"))


@query("is_vip", with_(EV, SPENT) + "SELECT user_id, cents > 1000000 AS is_vip FROM s")
def is_vip(spark, d):
    return _stats(spark, d).select("user_id", cu.is_vip(F.col("total_spent")).alias("is_vip"))


@query("spending_category", with_(EV, SPENT) + """
SELECT user_id, CASE WHEN cents > 1000000 THEN 'High Spender' WHEN cents > 100000
       THEN 'Moderate Spender' ELSE 'New Customer' END AS spending_category FROM s""")
def spending_category(spark, d):
    return _stats(spark, d).select(
        "user_id", cu.spending_category(F.col("total_spent")).alias("spending_category"))


@query("loyalty_score", with_(EV) + """
SELECT order_id, CAST(least(100, trunc(10 + cents / 10000.0)) AS BIGINT) AS loyalty_score
FROM ev""")
def loyalty_score(spark, d):
    # One order each: totals of users would all reach the limit.
    spent = mo.order_revenue(F.col("price"), F.col("quantity"))
    return fx.order_events(spark, d).select(
        "order_id", cu.loyalty_score(F.lit(1), spent).alias("loyalty_score"))


@query("predicted_lifetime_value", with_(EV, SPENT) + f"""
SELECT user_id, {money('(cents * 3 + 1) // 2')} AS predicted FROM s""")
def predicted_lifetime_value(spark, d):
    return _stats(spark, d).select(
        "user_id", cu.predicted_lifetime_value(F.col("total_spent")).alias("predicted"))


@query("recommendations", with_(EV, SPENT) + """
SELECT user_id, concat_ws('|',
    CASE WHEN n > 5 THEN 'Loyalty reward eligible - 10% discount on next order' END,
    CASE WHEN mean_cents > 100000 THEN 'Premium customer - priority shipping available' END,
    CASE WHEN cents > 2000000 THEN 'Top VIP - personal account manager assigned' END)
    AS recommendations FROM s""")
def recommendations(spark, d):
    return _stats(spark, d).select("user_id", cu.recommendations(
        F.col("total_orders"), F.col("avg_order_value"), F.col("total_spent"))
        .alias("recommendations"))


@query("iso_utc", f"""
SELECT event_id, {iso('ts')} AS text, ts AS parsed FROM events""")
def iso_text(spark, d):
    text = iso_utc(F.col("ts").cast("timestamp"))
    return fx.table(spark, d, "events").select(
        "event_id", text.alias("text"), parse_iso(text).alias("parsed"))


@query("window_id", """
SELECT event_id, 'window-' || CAST(CAST(epoch(time_bucket(INTERVAL 1 MINUTE, ts)) AS BIGINT)
       AS VARCHAR) AS window_id FROM events""")
def window_key(spark, d):
    start = F.window(F.col("timestamp"), "1 minute")
    return (fx.order_events(spark, d).withColumn("w", start)
            .select(F.col("arrival").alias("event_id"),
                    window_id(F.col("w.start")).alias("window_id")))


@query("product_id", """
SELECT count(*) AS products, count(*) AS ids, 36::BIGINT AS length FROM part""")
def product_id(spark, d):
    named = fx.table(spark, d, "part").select(F.uuid().alias("product_id"))
    return named.agg(F.count("product_id").alias("products"),
                     F.countDistinct("product_id").alias("ids"),
                     F.max(F.length("product_id")).alias("length"))
