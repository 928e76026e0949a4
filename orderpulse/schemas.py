"""Column types of the tables and topics."""

from __future__ import annotations

from pyspark.sql import types as T

PRICE = T.DecimalType(10, 2)      # a price as declared on the order topic
RAW_PRICE = T.DecimalType(28, 6)  # a price as a processor reads it from JSON
MONEY = T.DecimalType(38, 2)      # every sum of money

ORDER_EVENTS = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("price", PRICE),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("status", T.StringType()),
    T.StructField("arrival", T.LongType()),
])

# A landed topic keeps what the broker knows of each message.
TOPIC = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

ORDERS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("total_price", PRICE),
    T.StructField("status", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
])

USERS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
])

PRODUCTS = T.StructType([
    T.StructField("product_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("price", PRICE),
    T.StructField("stock", T.LongType()),
    T.StructField("category", T.StringType()),
])

ANALYTICS_ITEMS = T.StructType([
    T.StructField("window_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("order_count", T.LongType()),
    T.StructField("total_revenue", MONEY),
    T.StructField("unique_users", T.LongType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("window_start", T.StringType()),
    T.StructField("window_end", T.StringType()),
])

USER_RESULTS = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("total_orders", T.LongType()),
    T.StructField("total_spent", MONEY),
    T.StructField("avg_order_value", MONEY),
    T.StructField("customer_tier", T.StringType()),
    T.StructField("is_vip", T.BooleanType()),
    T.StructField("first_order", T.StringType()),
    T.StructField("last_order", T.StringType()),
    T.StructField("window_end", T.StringType()),
    T.StructField("arrival", T.LongType()),
])

# The labels that identify one metric series, next to the metric name.
LABELS = ("namespace", "pod", "container", "phase", "resource", "instance")

METRIC_SAMPLES = T.StructType(
    [T.StructField("metric", T.StringType())]
    + [T.StructField(label, T.StringType()) for label in LABELS]
    + [T.StructField("ts", T.TimestampType()), T.StructField("value", T.DoubleType())])

REQUESTS = T.StructType([
    T.StructField("ts", T.TimestampType()),
    T.StructField("endpoint", T.StringType()),
    T.StructField("check", T.StringType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("duration_ms", T.DoubleType()),
    T.StructField("failed", T.BooleanType()),
])
