"""Parsing, validation and the joins of the writers."""

from pyspark.sql import functions as F

from orderpulse.functions.jsontext import to_json_result
from orderpulse.operators import events as op
from orderpulse.plans.catalog.common import EV, ORD, as_double, iso, money, query, with_
from orderpulse.plans.catalog.running import FAULTY
from orderpulse.sources import fixtures as fx

POSTS = """posts AS (
  SELECT o_orderkey AS id, o_custkey AS user_id,
         CASE WHEN o_orderpriority = '1-URGENT' THEN ''
              ELSE 'prod-' || CAST(o_orderkey % 100 AS VARCHAR) END AS product_id,
         CASE WHEN o_orderstatus <> 'F' THEN CAST(o_orderkey % 5 + 1 AS BIGINT) END AS quantity,
         CASE WHEN o_orderstatus = 'P' THEN o_totalprice END AS price,
         CASE WHEN o_orderstatus = 'O' THEN o_totalprice END AS total_price,
         o_orderdate AS created_at,
         CASE WHEN o_custkey = 0 OR o_orderpriority = '1-URGENT'
              THEN 'User ID and Product ID required' END AS error
  FROM orders)"""

USER_POSTS = """user_posts AS (
  SELECT c_custkey * 2 AS id,
         CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN '' ELSE c_name END AS name,
         c_name || '@example.com' AS email FROM customer
  UNION ALL
  SELECT c_custkey * 2 + 1, c_name, c_mktsegment || '@example.com' FROM customer)"""

PRODUCT_POSTS = """product_posts AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id,
         CASE WHEN p_brand = 'Brand#1' THEN '' ELSE p_name END AS name,
         CASE WHEN p_type <> 'PROMO' THEN p_retailprice END AS price,
         CASE WHEN p_size > 5 THEN CAST(p_size AS BIGINT) END AS stock,
         CASE WHEN p_type <> 'ECONOMY' THEN p_type END AS category
  FROM part)"""


@query("parse_order_events", with_(EV) + f"""
SELECT order_id, user_id, product_id, quantity, {money('price_cents')} AS price,
       ts AS "timestamp", 'pending' AS status, arrival FROM ev""")
def parse_order_events(spark, d):
    return op.order_events(fx.as_read(fx.order_messages(spark, d)))


@query("parse_order_events_faulty", """
SELECT event_id AS arrival,
       CASE WHEN event_type <> 'signup' THEN CAST(user_id AS VARCHAR) END AS user_id,
       CAST(CASE WHEN event_type <> 'click' THEN event_id % 5 + 1 END AS DOUBLE) AS quantity,
       CASE WHEN event_type IN ('signup', 'purchase') THEN value END AS price,
       ts AS "timestamp" FROM events WHERE event_type <> 'error'""")
def parse_order_events_faulty(spark, d):
    parsed = op.order_events(fx.as_read(fx.faulty_messages(spark, d)))
    return as_double(parsed.select("arrival", "user_id", "quantity", "price", "timestamp"),
                     "quantity")


@query("parse_user_key", """
SELECT event_id AS arrival, 1::BIGINT AS count,
       CASE WHEN event_type IN ('error', 'signup') THEN 'unknown'
            ELSE CAST(user_id AS VARCHAR) END AS user_id FROM events""")
def parse_user_key(spark, d):
    return op.parse_user_key(fx.as_read(fx.faulty_messages(spark, d))).drop("timestamp")


@query("rejects", """
SELECT 'no json ' || CAST(user_id AS VARCHAR) AS value, event_id AS arrival, ts AS "timestamp",
       'malformed json' AS reason FROM events WHERE event_type = 'error'""")
def rejects(spark, d):
    return op.rejects(fx.as_read(fx.faulty_messages(spark, d)))


@query("per_row_error_skip", """
SELECT count(*) FILTER (event_type <> 'error') AS kept,
       count(*) FILTER (event_type = 'error') AS skipped FROM events""")
def per_row_error_skip(spark, d):
    parsed = op.parse_events(fx.as_read(fx.faulty_messages(spark, d)))
    return parsed.agg(F.count_if(~F.col("malformed")).alias("kept"),
                      F.count_if("malformed").alias("skipped"))


@query("cast_with_defaults", with_(FAULTY) + """
SELECT coalesce(bad.user_id, 'None') AS user_id, arrival,
       CASE WHEN e.event_type = 'click' THEN 0 WHEN e.event_type <> 'view' THEN e.value
       END AS price,
       CASE WHEN e.event_type = 'click' THEN 1 ELSE e.event_id % 5 + 1 END AS quantity,
       bad.ts AS "timestamp"
FROM bad JOIN events e ON event_id = arrival""")
def cast_with_defaults(spark, d):
    return op.cast_with_defaults(fx.as_read(fx.faulty_messages(spark, d)), missing_user="None")


@query("build_order_event", with_(ORD) + f"""
SELECT CAST(id AS VARCHAR) AS order_id, CAST(user_id AS VARCHAR) AS user_id, product_id,
       quantity, {money('cents')} AS price, {iso('created_at')} AS "timestamp", status
FROM ord""")
def build_order_event(spark, d):
    return op.build_order_event(fx.orders(spark, d))


@query("event_json_round_trip", with_(ORD) + f"""
SELECT CAST(id AS VARCHAR) AS order_id, CAST(user_id AS VARCHAR) AS user_id, product_id,
       quantity, {money('cents')} AS price, created_at AS "timestamp", status
FROM ord""")
def event_json_round_trip(spark, d):
    return op.order_events(op.event_json(op.build_order_event(fx.orders(spark, d))))


@query("to_json_result", """
SELECT '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"'
       || event_type || '"}' AS value FROM events""")
def json_result(spark, d):
    return fx.table(spark, d, "events").select(
        to_json_result("event_id", "user_id", "event_type").alias("value"))


POSTS_CHECKED = "SELECT * REPLACE (CAST(quantity AS DOUBLE) AS quantity) FROM posts"


@query("validate_order", with_(POSTS) + POSTS_CHECKED)
def validate_order(spark, d):
    return as_double(op.validate_order(fx.order_posts(spark, d)), "quantity")


@query("dead_letter_orders", with_(POSTS) + POSTS_CHECKED + " WHERE error IS NOT NULL")
def dead_letter_orders(spark, d):
    return as_double(op.refused(op.validate_order(fx.order_posts(spark, d))), "quantity")


@query("price_or_total_price", with_(POSTS) + """
SELECT id, coalesce(price, total_price, 0) AS paid FROM posts""")
def price_or_total(spark, d):
    from orderpulse.functions.money import price_or_total_price
    return fx.order_posts(spark, d).select(
        "id", price_or_total_price(F.col("price"), F.col("total_price")).alias("paid"))


@query("status_default", with_(POSTS) + """
SELECT id, user_id, product_id, coalesce(quantity, 1) AS quantity,
       coalesce(price, total_price, 0) AS total_price, 'pending' AS status, created_at
FROM posts WHERE error IS NULL""")
def new_orders(spark, d):
    return op.new_orders(op.accepted(op.validate_order(fx.order_posts(spark, d))))


@query("validate_user", with_(USER_POSTS) + """
SELECT *, CASE WHEN name = '' THEN 'Name and email required' END AS error FROM user_posts""")
def validate_user(spark, d):
    return op.validate_user(fx.user_posts(spark, d))


@query("validate_product", with_(PRODUCT_POSTS) + """
SELECT * REPLACE (CAST(stock AS DOUBLE) AS stock),
       CASE WHEN name = '' OR price IS NULL THEN 'Name and price required' END AS error
FROM product_posts""")
def validate_product(spark, d):
    return as_double(op.validate_product(fx.product_posts(spark, d)), "stock")


@query("product_defaults", with_(PRODUCT_POSTS) + """
SELECT product_id, name, price, coalesce(stock, 0) AS stock,
       coalesce(category, 'general') AS category
FROM product_posts WHERE name <> '' AND price IS NOT NULL""")
def product_defaults(spark, d):
    valid = op.accepted(op.validate_product(fx.product_posts(spark, d)))
    return op.status_default(valid, stock=0, category="general")


@query("reject_duplicate_email", with_(USER_POSTS) + """
SELECT *, CASE WHEN email IN (SELECT c_name || '@example.com' FROM customer)
                 OR row_number() OVER (PARTITION BY email ORDER BY id) > 1
               THEN 'Email already exists' END AS error FROM user_posts""")
def reject_duplicate_email(spark, d):
    return op.reject_duplicate_email(fx.user_posts(spark, d), fx.users(spark, d), "id")
