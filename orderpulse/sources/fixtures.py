"""Order data derived from the generated star-schema tables, row for row.

The mappings are those of FIXTURES.md. Every fixture covers its whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderpulse.functions.jsontext import to_json_result
from orderpulse.functions.times import iso_utc
from orderpulse.operators.running import published, user_running_stats
from orderpulse.operators.windows import analytics_items as items_of
from orderpulse.operators.windows import window_totals
from orderpulse.schemas import PRICE

# Instants at which the results fixture publishes; the last is the month's end after all events.
PUBLISHES = ("2024-01-10 00:00:00", "2024-01-20 00:00:00")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_order_events(events: DataFrame) -> DataFrame:
    """Rows of ``events``, batch or stream, as typed order events."""
    number = F.col("event_id")
    return events.select(
        number.cast("string").alias("order_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.concat(F.lit("prod-"), (number % 100).cast("string")).alias("product_id"),
        (number % 5 + 1).cast("int").alias("quantity"),
        F.col("value").cast(PRICE).alias("price"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit("pending").alias("status"),
        number.alias("arrival"))


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_order_events(table(spark, sf_dir, "events"))


def order_events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a file stream."""
    schema = table(spark, sf_dir, "events").schema
    raw = (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
           .parquet(sf_dir))
    return as_order_events(raw)


def order_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as topic messages: JSON text at the position ``event_id``."""
    events = order_events(spark, sf_dir)
    event = events.select("arrival", F.col("timestamp").alias("at"), to_json_result(
        "order_id", "user_id", "product_id", "quantity",
        F.col("price").cast("double").alias("price"),
        iso_utc(F.col("timestamp")).alias("timestamp"), "status").alias("value"))
    return event.select("value", F.lit(0).alias("partition"),
                        F.col("arrival").alias("offset"), F.col("at").alias("timestamp"))


def faulty_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as messages with a fault by event type.

    ``error`` is no JSON, ``signup`` names no user, ``view`` has a price that is
    no number, ``click`` leaves price and quantity out, ``purchase`` is whole.
    """
    events = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    user = F.col("user_id").cast("string")
    price = F.col("value").cast(PRICE).cast("string")
    quantity = (F.col("event_id") % 5 + 1).cast("string")
    time = iso_utc(F.col("ts").cast("timestamp"))
    value = (
        F.when(kind == "error", F.concat(F.lit("no json "), user))
        .when(kind == "signup", F.format_string(
            '{"price":%s,"quantity":%s,"timestamp":"%s"}', price, quantity, time))
        .when(kind == "view", F.format_string(
            '{"user_id":%s,"price":"x","quantity":%s,"timestamp":"%s"}', user, quantity, time))
        .when(kind == "click", F.format_string(
            '{"user_id":"%s","timestamp":"%s"}', user, time))
        .otherwise(F.format_string(
            '{"user_id":%s,"price":%s,"quantity":%s.7,"timestamp":"%s"}',
            user, price, quantity, time)))
    return events.select(value.alias("value"), F.lit(0).alias("partition"),
                         F.col("event_id").alias("offset"),
                         F.col("ts").cast("timestamp").alias("timestamp"))


def as_read(messages: DataFrame) -> DataFrame:
    """Messages with the columns a topic read gives."""
    return messages.select("value", F.col("offset").alias("arrival"), "timestamp")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("user_id"),
        F.concat(F.lit("prod-"), (F.col("o_orderkey") % 100).cast("string"))
        .alias("product_id"),
        (F.col("o_orderkey") % 5 + 1).cast("int").alias("quantity"),
        F.col("o_totalprice").cast(PRICE).alias("total_price"),
        F.when(status == "P", "pending").when(status == "O", "processing")
        .otherwise("delivered").alias("status"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"))


def order_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders as they were posted, with the faults a post may have.

    User 0 counts as no user; priority 1-URGENT orders name no product, and the
    price comes as ``price``, as ``total_price`` or not at all by status.
    """
    raw = table(spark, sf_dir, "orders")
    status = F.col("o_orderstatus")
    total = F.col("o_totalprice").cast(PRICE)
    return raw.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("user_id"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "").otherwise(
            F.concat(F.lit("prod-"), (F.col("o_orderkey") % 100).cast("string")))
        .alias("product_id"),
        F.when(status != "F", (F.col("o_orderkey") % 5 + 1).cast("int")).alias("quantity"),
        F.when(status == "P", total).alias("price"),
        F.when(status == "O", total).alias("total_price"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.concat("c_name", F.lit("@example.com")).alias("email"),
        F.lit("2024-01-01").cast("timestamp").alias("created_at"))


def user_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers twice over: as posted first, and again by market segment, so
    that the second post of a segment repeats its e-mail."""
    raw = table(spark, sf_dir, "customer")
    first = raw.select(
        (F.col("c_custkey") * 2).alias("id"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", "").otherwise(F.col("c_name"))
        .alias("name"),
        F.concat("c_name", F.lit("@example.com")).alias("email"))
    again = raw.select(
        (F.col("c_custkey") * 2 + 1).alias("id"), F.col("c_name").alias("name"),
        F.concat("c_mktsegment", F.lit("@example.com")).alias("email"))
    return first.unionByName(again)


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_retailprice").cast(PRICE).alias("price"),
        F.col("p_size").cast("bigint").alias("stock"),
        F.col("p_type").alias("category"))


def product_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts as posted: one brand has no name, one type no price, small ones no
    stock, and one type no category."""
    kind = F.col("p_type")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.when(F.col("p_brand") == "Brand#1", "").otherwise(F.col("p_name")).alias("name"),
        F.when(kind != "PROMO", F.col("p_retailprice").cast(PRICE)).alias("price"),
        F.when(F.col("p_size") > 5, F.col("p_size").cast("bigint")).alias("stock"),
        F.when(kind != "ECONOMY", kind).alias("category"))


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast(PRICE).alias("line_price"))


def analytics_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items_of(window_totals(order_events(spark, sf_dir)))


def user_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running statistics as published at each of the instants.

    An event counts for every later publish; one aggregate gives all of them. A
    row's arrival is its publish and then its user.
    """
    events = order_events(spark, sf_dir)
    last = events.agg(F.max("timestamp").alias("ts")).select(
        F.add_months(F.trunc("ts", "month"), 1).cast("timestamp")).first()[0]
    cuts = F.array(*[F.lit(p).cast("timestamp") for p in PUBLISHES], F.lit(last).cast("timestamp"))
    events = events.withColumn("cut", F.explode(
        F.filter(cuts, lambda cut: F.col("timestamp") < cut)))
    keyed = events.withColumn("user_id", F.struct("cut", "user_id"))
    stats = user_running_stats(keyed).select(
        F.col("user_id.cut").alias("cut"), F.col("user_id.user_id").alias("user_id"),
        *[c for c in _STATS if c != "user_id"])
    order = (F.unix_seconds("cut") * 1_000_000 + F.col("user_id").cast("bigint"))
    return published(stats, F.col("cut")).withColumn("arrival", order).drop("cut")


_STATS = ("user_id", "total_orders", "total_spent", "avg_order_value", "customer_tier",
          "is_vip", "first_order", "last_order")


def mixed_result_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A results topic that carries all three shapes."""
    results = user_results(spark, sf_dir)
    totals = window_totals(order_events(spark, sf_dir))
    counts = (order_events(spark, sf_dir)
              .groupBy("user_id", F.window("timestamp", "1 minute").alias("w"))
              .agg(F.count(F.lit(1)).alias("order_count")))
    stats = results.select(
        to_json_result(*[c for c in results.columns if c != "arrival"]).alias("value"),
        F.col("arrival").alias("offset"), F.col("window_end").cast("timestamp").alias("timestamp"))
    windows = totals.select(
        to_json_result(*totals.columns).alias("value"),
        F.unix_seconds("window_end").alias("offset"), F.col("window_end").alias("timestamp"))
    per_user = counts.select(
        to_json_result("user_id", "order_count",
                       F.unix_millis(F.col("w.start")).alias("window_start"),
                       F.unix_millis(F.col("w.end")).alias("window_end")).alias("value"),
        F.unix_seconds(F.col("w.end")).alias("offset"), F.col("w.end").alias("timestamp"))
    return (stats.unionByName(windows).unionByName(per_user)
            .withColumn("partition", F.lit(0))
            .select("value", "partition", "offset", "timestamp"))


def text_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("uploads/"), F.col("doc_id").cast("string"), F.lit(".txt"))
        .alias("path"),
        F.col("text").alias("content"))


def _pick(number: Column, *names: str) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]),
                        (number % len(names) + 1).cast("int"))


def metric_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as metric samples: the type is the metric, the user the instance."""
    user = F.col("user_id")
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("metric"),
        F.lit("default").alias("namespace"),
        F.concat(_pick(user, "order", "user", "worker", "product", "gateway"),
                 F.lit("-service-"), (user % 5).cast("string")).alias("pod"),
        _pick(user, "app", "app", "proxy", "", "POD", "app", "app").alias("container"),
        _pick(user, "Running", "Failed", "Pending").alias("phase"),
        _pick(user, "cpu", "memory").alias("resource"),
        user.cast("string").alias("instance"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("value"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as request log: errors have status 500, the value is the duration."""
    kind = F.col("event_type")
    failed = kind == "error"
    check = (F.when(kind == "signup", "user created")
             .when(kind == "purchase", "order created")
             .when(kind == "view", "get products success")
             .when(kind == "click", "get users success")
             .otherwise("product created"))
    made = kind.isin("signup", "purchase")
    taken = (kind == "signup") & (F.col("event_id") % 3 == 0)
    return table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("ts"), kind.alias("endpoint"),
        check.alias("check"),
        F.when(failed, 500).when(taken, 409).when(made, 201).otherwise(200).alias("status"),
        F.col("value").alias("duration_ms"), failed.alias("failed"))
