"""Readers and writers: each query writes whole tables and reads them back."""

from pyspark.sql import functions as F

from orderpulse import schemas
from orderpulse.operators import running as rn
from orderpulse.operators import serving as sv
from orderpulse.operators import windows as wi
from orderpulse.plans.catalog.common import (EV, ITEMS, ORD, RESULTS, STATS_COLUMNS, iso,
                                             money, query, window_sql, with_)
from orderpulse.plans.catalog.parsing import POSTS, PRODUCT_POSTS, USER_POSTS
from orderpulse.plans.catalog.running import FAULTY
from orderpulse.session import fresh_path
from orderpulse.sources import fixtures as fx
from orderpulse.sources import results, tables, topics
from orderpulse.streaming import queries as sq
from orderpulse.streaming import sinks


def land(spark, messages, topic):
    """Write messages as a landed topic below a new path."""
    path = fresh_path(spark, "topics")
    messages.write.parquet(f"{path}/{topic}")
    return path


def offsets(rows):
    """Rows with the offset in place of the whole order of arrival."""
    return rows.withColumn("arrival", (F.col("arrival") % F.lit(topics.OFFSETS)).cast("bigint"))


@query("read_order_events", with_(EV) + f"""
SELECT order_id, user_id, product_id, quantity, {money('price_cents')} AS price,
       ts AS "timestamp", 'pending' AS status, arrival FROM ev""")
def read_order_events(spark, d):
    path = land(spark, fx.order_messages(spark, d), topics.ORDERS_TOPIC)
    return offsets(topics.read_order_events(spark, path=path))


@query("read_order_values", """
SELECT CASE event_type
       WHEN 'error' THEN 'no json ' || CAST(user_id AS VARCHAR) ELSE event_type END AS value
FROM events""")
def read_order_values(spark, d):
    messages = fx.faulty_messages(spark, d)
    kinds = fx.table(spark, d, "events").select(F.col("event_id").alias("offset"), "event_type")
    named = messages.join(kinds, "offset").withColumn(
        "value", F.when(F.col("event_type") == "error", F.col("value"))
        .otherwise(F.col("event_type"))).select(*schemas.TOPIC.names)
    return topics.read_order_values(spark, path=land(spark, named, topics.ORDERS_TOPIC))


@query("read_order_dicts", with_(FAULTY) + """
SELECT coalesce(user_id, 'None') AS user_id, arrival, ts AS "timestamp"
FROM bad""")
def read_order_dicts(spark, d):
    path = land(spark, fx.faulty_messages(spark, d), topics.ORDERS_TOPIC)
    return offsets(topics.read_order_dicts(spark, path=path)).select(
        "user_id", "arrival", "timestamp")


@query("start_position", """
SELECT 'earliest' AS start, count(*) AS messages FROM events
UNION ALL
SELECT 'after', count(*) FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00'""")
def start_position(spark, d):
    path = land(spark, fx.order_messages(spark, d), topics.ORDERS_TOPIC)
    since = F.lit("2024-01-15").cast("timestamp")
    every = topics.read_topic(spark, path=path, start="earliest")
    later = topics.read_topic(spark, path=path, since=since)

    def count(df, start):
        return df.agg(F.count(F.lit(1)).alias("messages")).select(
            F.lit(start).alias("start"), "messages")

    return count(every, "earliest").unionByName(count(later, "after"))


@query("landed_appends", """
SELECT count(*) AS messages, count(*) AS positions, count(*) AS arrivals, true AS in_order
FROM events""")
def landed_appends(spark, d):
    # Three appends: no message has the position of another, and later ones arrive later.
    path = fresh_path(spark, "topics")
    events = fx.table(spark, d, "events")
    for k in range(3):
        topics.write_topic(events.filter(F.col("event_id") % 3 == k).select(
            F.col("event_id").cast("string").alias("value")), topics.ORDERS_TOPIC, path=path)
    read = topics.read_topic(spark, path=path, positions=True, start="earliest")
    part = F.col("value").cast("bigint") % 3
    first, last = ([f(F.when(part == k, F.col("arrival"))) for k in range(3)]
                   for f in (F.min, F.max))
    return read.agg(F.count(F.lit(1)).alias("messages"),
                    F.countDistinct("position").alias("positions"),
                    F.countDistinct("arrival").alias("arrivals"),
                    ((last[0] < first[1]) & (last[1] < first[2])).alias("in_order"))


@query("read_results_bounded", with_(EV, RESULTS) + """
SELECT * FROM results""")
def read_results_bounded(spark, d):
    path = land(spark, fx.mixed_result_messages(spark, d), topics.RESULTS_TOPIC)
    return offsets(sv.has_user_id(results.read_results_bounded(spark, path=path)))


@query("read_results_all_shapes", with_(EV, RESULTS, f"w AS ({window_sql(1)})") + """
SELECT (SELECT count(*) FROM results) AS user_rows, (SELECT count(*) FROM w) AS window_rows""")
def read_results_all_shapes(spark, d):
    # The per-user window counts have a numeric window_end and are not admitted.
    path = land(spark, fx.mixed_result_messages(spark, d), topics.RESULTS_TOPIC)
    return results.read_results_bounded(spark, path=path).agg(
        F.count("user_id").alias("user_rows"),
        F.count_if(F.col("user_id").isNull()).alias("window_rows"))


@query("read_results_from_latest", with_(EV, RESULTS) + """
SELECT * FROM results
WHERE window_end > '2024-01-15'""")
def read_results_from_latest(spark, d):
    path = land(spark, fx.mixed_result_messages(spark, d), topics.RESULTS_TOPIC)
    since = F.lit("2024-01-15").cast("timestamp")
    return offsets(sv.has_user_id(results.read_results_from_latest(spark, since, path=path)))


@query("top_users_from_topic", with_(EV, RESULTS) + """
SELECT * EXCLUDE (arrival) FROM results WHERE window_end = (SELECT max(window_end) FROM results)
ORDER BY total_spent DESC, user_id LIMIT 10""")
def top_users_from_topic(spark, d):
    path = land(spark, fx.mixed_result_messages(spark, d), topics.RESULTS_TOPIC)
    return sv.top_users(results.read_results_bounded(spark, path=path)).drop("arrival")


ORDER_ROWS = f"""
SELECT id, user_id, product_id, quantity, {money('cents')} AS total_price, status, created_at
FROM ord"""


@query("scan_orders", with_(ORD) + ORDER_ROWS)
def scan_orders(spark, d):
    path = fresh_path(spark, "orders")
    fx.orders(spark, d).write.parquet(path)
    return tables.scan_orders(spark, path=path)


@query("scan_users", """
SELECT c_custkey AS id, c_name AS name, c_name || '@example.com' AS email FROM customer""")
def scan_users(spark, d):
    path = fresh_path(spark, "users")
    fx.users(spark, d).write.parquet(path)
    return tables.scan_users(spark, path=path).drop("created_at")


@query("scan_products", """
SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS name, p_retailprice AS price,
       CAST(p_size AS BIGINT) AS stock, p_type AS category FROM part""")
def scan_products(spark, d):
    path = fresh_path(spark, "products")
    fx.products(spark, d).write.parquet(path)
    return tables.scan_products(spark, path=path)


@query("scan_analytics", with_(EV, ITEMS) + "SELECT * EXCLUDE (user_id) FROM items")
def scan_analytics(spark, d):
    path = fresh_path(spark, "items")
    fx.analytics_items(spark, d).write.parquet(path)
    return tables.scan_analytics(spark, path=path).drop("user_id")


@query("append_orders", with_(POSTS) + """
SELECT id, user_id, product_id, coalesce(quantity, 1) AS quantity,
       coalesce(price, total_price, 0) AS total_price, 'pending' AS status, created_at
FROM posts WHERE error IS NULL""")
def append_orders(spark, d):
    path = fresh_path(spark, "orders")
    tables.append_orders(fx.order_posts(spark, d), path)
    return tables.scan_orders(spark, path=path)


@query("append_users", with_(USER_POSTS) + """
SELECT id, name, email FROM user_posts WHERE name <> ''
  AND email NOT IN (SELECT c_mktsegment || '@example.com' FROM customer
                    WHERE c_mktsegment = 'BUILDING')
QUALIFY row_number() OVER (PARTITION BY email ORDER BY id) = 1""")
def append_users(spark, d):
    path = fresh_path(spark, "users")
    taken = fx.table(spark, d, "customer").filter(F.col("c_mktsegment") == "BUILDING").select(
        F.concat("c_mktsegment", F.lit("@example.com")).alias("email"))
    tables.append_users(fx.user_posts(spark, d), taken, path)
    return tables.scan_users(spark, path=path).drop("created_at")


@query("append_products", with_(PRODUCT_POSTS) + """
SELECT product_id, name, price, coalesce(stock, 0) AS stock,
       coalesce(category, 'general') AS category
FROM product_posts WHERE name <> '' AND price IS NOT NULL""")
def append_products(spark, d):
    path = fresh_path(spark, "products")
    tables.append_products(fx.product_posts(spark, d), path)
    return tables.scan_products(spark, path=path)


@query("write_window_totals", with_(EV) + window_sql(1))
def write_window_totals(spark, d):
    path = fresh_path(spark, "topics")
    topics.write_topic(wi.window_totals(fx.order_events(spark, d)), path=path)
    row = F.from_json("value", "window_start timestamp, window_end timestamp, "
                      "unique_users bigint, total_orders bigint, "
                      "total_revenue decimal(38,2), avg_order_value decimal(38,2)")
    return (topics.read_topic(spark, topics.RESULTS_TOPIC, path=path, start="earliest")
            .select(row.alias("row")).select("row.*"))


@query("write_user_counts", with_(EV) + """
SELECT user_id, count(*) AS order_count,
       epoch_ms(time_bucket(INTERVAL 1 MINUTE, ts)) AS window_start,
       epoch_ms(time_bucket(INTERVAL 1 MINUTE, ts) + INTERVAL 1 MINUTE) AS window_end
FROM ev GROUP BY ALL""")
def write_user_counts(spark, d):
    path = fresh_path(spark, "topics")
    counts = wi.user_window_counts(fx.order_events(spark, d), ts="timestamp")
    topics.write_topic(sq.user_count_messages(counts), path=path)
    row = F.from_json("value", "user_id string, order_count bigint, "
                      "window_start bigint, window_end bigint")
    return (topics.read_topic(spark, topics.RESULTS_TOPIC, path=path, start="earliest")
            .select(row.alias("row")).select("row.*"))


@query("write_user_stats", with_(EV) + f"""
SELECT {STATS_COLUMNS}, {iso('arg_min(ts, ev.arrival)')} AS first_order,
       {iso('arg_max(ts, ev.arrival)')} AS last_order,
       '2024-02-01T00:00:00+00:00' AS window_end FROM ev GROUP BY user_id""")
def write_user_stats(spark, d):
    path = fresh_path(spark, "topics")
    stats = rn.user_running_stats(fx.order_events(spark, d))
    topics.write_topic(rn.published(stats, F.lit("2024-02-01").cast("timestamp")), path=path)
    return results.read_results_bounded(spark, path=path).drop("arrival")


@query("upsert_window_item", with_(EV, ITEMS) + "SELECT * EXCLUDE (user_id) FROM items")
def upsert_window_item(spark, d):
    path = fresh_path(spark, "upserts")
    events = fx.order_events(spark, d)
    early = events.filter(F.col("timestamp") < F.lit("2024-01-15T12:00:30").cast("timestamp"))
    sinks.replace_batch(wi.analytics_items(wi.window_totals(early)), 0, path)
    for _ in range(2):  # a batch that runs again replaces itself
        sinks.replace_batch(wi.analytics_items(wi.window_totals(events)), 1, path)
    return sinks.newest_by_key(sinks.read_batches(spark, path), "window_id").drop("user_id")


@query("compact_window_items", with_(EV, ITEMS) + "SELECT * EXCLUDE (user_id) FROM items")
def compact_window_items(spark, d):
    path, into = fresh_path(spark, "upserts"), fresh_path(spark, "compacted")
    events = fx.order_events(spark, d)
    early = events.filter(F.col("timestamp") < F.lit("2024-01-15T12:00:30").cast("timestamp"))
    sinks.replace_batch(wi.analytics_items(wi.window_totals(early)), 0, path)
    sinks.replace_batch(wi.analytics_items(wi.window_totals(events)), 1, path)
    sinks.compact(spark, path, into, "window_id")
    return sinks.read_batches(spark, into).drop("user_id", "batch_id")


@query("first_last_over_partitions", with_(EV) + """
SELECT user_id, min(ts) AS first_order, max(ts) AS last_order FROM ev GROUP BY user_id""")
def first_last_over_partitions(spark, d):
    # Three partitions whose offsets are far apart, so that only the time orders them.
    number = F.col("offset")
    spread = fx.order_messages(spark, d).select(
        "value", (number % 3).cast("int").alias("partition"),
        F.floor(number / F.pow(F.lit(10), number % 3)).alias("offset"), "timestamp")
    path = land(spark, spread, topics.ORDERS_TOPIC)
    return rn.first_last_by_arrival(topics.read_order_events(spark, path=path))


@query("newest_of_three_publishes", """
SELECT CAST(c_custkey AS VARCHAR) AS user_id, 3 * c_custkey::DOUBLE AS total_spent
FROM customer""")
def newest_of_three_publishes(spark, d):
    path = fresh_path(spark, "publishes")
    users = fx.table(spark, d, "customer")
    for publish in (1, 2, 3):
        topics.write_topic(users.select(
            F.col("c_custkey").cast("string").alias("user_id"),
            (F.col("c_custkey") * publish).cast("double").alias("total_spent"),
            F.lit(f"2024-01-0{publish}T00:00:00").alias("window_end")), path=path)
    newest = sv.last_arrival_per_user(results.read_results_bounded(spark, path=path))
    return newest.select("user_id", F.col("total_spent").cast("double").alias("total_spent"))
