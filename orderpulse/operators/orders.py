"""Reports that the design describes: products, regions, hours, anomalies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderpulse.operators.serving import at_most


def order_lines(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """Each order line with its order and product.

    Plain equi-joins: Spark broadcasts a side it knows to be small, else sorts and
    merges, and splits a key that fills more than its share of a partition.
    """
    return (items.join(orders, "order_id").join(products, "product_id")
            .select("order_id", "line_number", "user_id", "product_id", "name",
                    "quantity", "line_price"))


def top_products(events: DataFrame, n: int = 10) -> DataFrame:
    """The products with the most units sold."""
    sold = events.groupBy("product_id").agg(
        F.sum(F.col("quantity").cast("bigint")).alias("units"),
        F.count(F.lit(1)).alias("orders"))
    return at_most(sold.orderBy(F.desc("units"), "product_id"), n)


def orders_by_region(orders: DataFrame, customers: DataFrame, nations: DataFrame,
                     regions: DataFrame) -> DataFrame:
    """Orders and revenue per region; orders are summed per user before the first
    join and per nation before the others."""
    per_user = orders.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("total_price").alias("revenue"))
    per_nation = (per_user.join(customers, "user_id").groupBy("nation_id")
                  .agg(F.sum("orders").alias("orders"), F.sum("revenue").alias("revenue")))
    return (per_nation.join(nations, "nation_id").join(regions, "region_id")
            .groupBy("region")
            .agg(F.sum("orders").alias("orders"),
                 F.sum("revenue").cast("decimal(38,2)").alias("revenue")))


def peak_hour(events: DataFrame) -> DataFrame:
    """The hour of the day with the most orders; the earliest of equal ones."""
    hours = events.groupBy(F.hour("timestamp").alias("hour")).agg(
        F.count(F.lit(1)).alias("orders"))
    return hours.orderBy(F.desc("orders"), "hour").limit(1)


def user_activity(events: DataFrame) -> DataFrame:
    """Orders of each user in each hour of the day."""
    return events.groupBy("user_id", F.hour("timestamp").alias("hour")).agg(
        F.count(F.lit(1)).alias("orders"))


def order_rate(totals: DataFrame) -> DataFrame:
    """Orders, revenue and mean order value of each window, from window totals."""
    minutes = (F.unix_seconds("window_end") - F.unix_seconds("window_start")) / 60
    return totals.select("window_start",
                         (F.col("total_orders") / minutes).alias("orders_per_minute"),
                         "total_revenue", "avg_order_value")


def window_anomalies(totals: DataFrame, value: str = "total_revenue", minutes: int = 60,
                     threshold: float = 3.0, least: int = 3) -> DataFrame:
    """Windows whose value is far from those of the ``minutes`` before, as z-score.

    Windows are cut into blocks of that length; each row goes to its own block
    and, as history only, to the next one. So a block is complete with one small
    group, and no single sort over all windows is needed. A window with fewer than
    ``least`` predecessors, or predecessors that are all equal, has no score.
    """
    span = minutes * 60
    at = F.unix_seconds("window_start")
    block = F.floor(at / span)
    rows = totals.select(
        "window_start", "window_end", F.col(value).cast("double").alias("value"),
        at.alias("_at"), F.explode(F.array(
            F.struct(block.alias("block"), F.lit(True).alias("own")),
            F.struct((block + 1).alias("block"), F.lit(False).alias("own")))).alias("_copy"))
    before = W.partitionBy("_copy.block").orderBy("_at").rangeBetween(-span, -1)
    history = (rows
               .withColumn("_n", F.count("value").over(before))
               .withColumn("mean", F.avg("value").over(before))
               .withColumn("deviation", F.stddev_samp("value").over(before)))
    score = F.when((F.col("_n") >= least) & (F.col("deviation") > 0),
                   (F.col("value") - F.col("mean")) / F.col("deviation"))
    return (history.filter("_copy.own")
            .select("window_start", "window_end", "value", score.alias("z_score"))
            .withColumn("is_anomaly", F.coalesce(F.abs("z_score") > threshold, F.lit(False))))


def deduplicate_events(events: DataFrame, key: str = "order_id",
                       arrival: str = "arrival") -> DataFrame:
    """One event per key, the first to arrive; copies are dropped in each task first."""
    rank = F.row_number().over(W.partitionBy(key).orderBy(arrival))
    return events.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def products_by_category(products: DataFrame, category: str) -> DataFrame:
    return products.filter(F.col("category") == category)


def product_search(products: DataFrame, text: str) -> DataFrame:
    """Products whose name holds the text, in any case."""
    return products.filter(F.lower("name").contains(text.lower()))


def order_status_counts(orders: DataFrame) -> DataFrame:
    return orders.groupBy("status").agg(F.count(F.lit(1)).alias("orders"))


def low_stock(products: DataFrame, below: int = 10) -> DataFrame:
    return products.filter(F.col("stock") < below)
