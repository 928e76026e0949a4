"""Reports on products, regions and hours."""

from orderpulse.operators import orders as op
from orderpulse.operators import search
from orderpulse.plans.catalog.common import EV, ORD, money, query, with_
from orderpulse.session import fresh_path
from orderpulse.sources import fixtures as fx
from pyspark.sql import functions as F

PRODUCT = """SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS name,
       p_retailprice AS price, CAST(p_size AS BIGINT) AS stock, p_type AS category FROM part"""


@query("order_lines", """
SELECT l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS line_number,
       o_custkey AS user_id, CAST(l_partkey AS VARCHAR) AS product_id, p_name AS name,
       CAST(l_quantity AS BIGINT) AS quantity, l_extendedprice AS line_price
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""")
def order_lines(spark, d):
    orders = fx.orders(spark, d).select(F.col("id").alias("order_id"), "user_id")
    items = fx.order_items(spark, d).withColumn("product_id", F.col("product_id").cast("string"))
    products = fx.products(spark, d).select("product_id", "name")
    return op.order_lines(orders, items, products)


@query("top_products", with_(EV) + """
SELECT product_id, CAST(sum(quantity) AS BIGINT) AS units, count(*) AS orders
FROM ev GROUP BY product_id ORDER BY units DESC, product_id LIMIT 10""")
def top_products(spark, d):
    return op.top_products(fx.order_events(spark, d))


@query("orders_by_region", with_(ORD) + f"""
SELECT r_name AS region, count(*) AS orders, {money('sum(cents)')} AS revenue
FROM ord JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""")
def orders_by_region(spark, d):
    customers = fx.table(spark, d, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("nation_id"))
    nations = fx.table(spark, d, "nation").select(
        F.col("n_nationkey").alias("nation_id"), F.col("n_regionkey").alias("region_id"))
    regions = fx.table(spark, d, "region").select(
        F.col("r_regionkey").alias("region_id"), F.col("r_name").alias("region"))
    return op.orders_by_region(fx.orders(spark, d), customers, nations, regions)


@query("peak_hour", """
SELECT CAST(hour(ts) AS BIGINT) AS hour, count(*) AS orders FROM events
GROUP BY 1 ORDER BY orders DESC, hour LIMIT 1""")
def peak_hour(spark, d):
    return op.peak_hour(fx.order_events(spark, d))


@query("user_activity", """
SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(hour(ts) AS BIGINT) AS hour,
       count(*) AS orders FROM events GROUP BY ALL""")
def user_activity(spark, d):
    return op.user_activity(fx.order_events(spark, d))


@query("deduplicate_events", with_(EV) + f"""
SELECT order_id, user_id, {money('price_cents')} AS price, arrival
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY arrival) AS place FROM ev)
WHERE place = 1""")
def deduplicate_events(spark, d):
    # Users stand for order ids, so that every id has copies.
    return op.deduplicate_events(fx.order_events(spark, d), "user_id").select(
        "order_id", "user_id", "price", "arrival")


@query("products_by_category", PRODUCT + " WHERE p_type = 'PROMO'")
def products_by_category(spark, d):
    return op.products_by_category(fx.products(spark, d), "PROMO")


@query("product_search", PRODUCT + " WHERE lower(p_name) LIKE '%widget%'")
def product_search(spark, d):
    return op.product_search(fx.products(spark, d), "Widget")


@query("product_search_by_index", PRODUCT + " WHERE lower(p_name) LIKE '%widget%'")
def product_search_by_index(spark, d):
    path, products = fresh_path(spark, "names"), fx.products(spark, d)
    search.build_index(products, path)
    return search.search(products, path, "Widget")


@query("product_search_short", PRODUCT + " WHERE lower(p_name) LIKE '%ge%'")
def product_search_short(spark, d):
    path, products = fresh_path(spark, "names"), fx.products(spark, d)
    search.build_index(products, path)
    return search.search(products, path, "GE")


@query("order_status_counts", with_(ORD) + """
SELECT status, count(*) AS orders FROM ord GROUP BY status""")
def order_status_counts(spark, d):
    return op.order_status_counts(fx.orders(spark, d))


@query("low_stock", PRODUCT + " WHERE p_size < 10")
def low_stock(spark, d):
    return op.low_stock(fx.products(spark, d))


@query("results_as_files", with_(EV) + """
SELECT product_id, CAST(sum(quantity) AS BIGINT) AS units, count(*) AS orders
FROM ev GROUP BY product_id""")
def results_as_files(spark, d):
    path = fresh_path(spark, "results")
    events = fx.order_events(spark, d)
    events.groupBy("product_id").agg(
        F.sum(F.col("quantity").cast("bigint")).alias("units"),
        F.count(F.lit(1)).alias("orders")).write.parquet(path)
    return spark.read.parquet(path)
