"""Fixed-size time windows; the same code serves batch tables and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderpulse.functions.money import money_round, order_revenue, safe_average
from orderpulse.functions.times import window_bounds, window_id
from orderpulse.schemas import MONEY


def _user_windows(events: DataFrame, window: Column, user: str) -> DataFrame:
    return events.groupBy(window.alias("window"), F.col(user).alias("user")).agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum(order_revenue(F.col("price"), F.col("quantity"))).alias("revenue"),
        F.count(order_revenue(F.col("price"), F.col("quantity"))).alias("priced"))


def window_totals(events: DataFrame, size: str = "1 minute", slide: str | None = None,
                  ts: str = "timestamp", user: str = "user_id") -> DataFrame:
    """Distinct users, orders, revenue and mean order value of each window.

    Two stages: one small row per (window, user), then one per window. Both are
    combined before their shuffle, so neither a busy user nor a busy minute ends
    up in one task, the distinct count is exact, and a stream can run it as is.
    A null user counts as an order but not as a user; the mean is over the
    orders that have a price and a quantity.
    """
    window = F.window(ts, size, slide) if slide else F.window(ts, size)
    totals = _user_windows(events, window, user).groupBy("window").agg(
        F.count("user").alias("unique_users"),
        F.sum("orders").alias("total_orders"),
        F.sum("revenue").cast(MONEY).alias("total_revenue"),
        F.sum("priced").alias("priced"))
    return totals.select(
        *window_bounds(F.col("window")),
        "unique_users", "total_orders", "total_revenue",
        F.when(F.col("priced") > 0,
               safe_average(F.col("total_revenue"), F.col("priced")))
        .alias("avg_order_value"))


def user_window_counts(events: DataFrame, size: str = "1 minute",
                       ts: str = "ingest_ts", count: Column | None = None) -> DataFrame:
    """Orders of each user in each window of arrival time."""
    orders = F.count(F.lit(1)) if count is None else count
    counted = events.groupBy(F.window(ts, size).alias("window"), "user_id").agg(
        orders.alias("order_count"))
    return counted.select("user_id", "order_count", *window_bounds(F.col("window")))


def analytics_items(totals: DataFrame) -> DataFrame:
    """Window totals as items of the analytics table, keyed by ``window_id``."""
    iso = "yyyy-MM-dd'T'HH:mm:ss"
    return totals.select(
        window_id(F.col("window_start")).alias("window_id"),
        F.date_format("window_end", iso).alias("timestamp"),
        F.col("total_orders").alias("order_count"),
        money_round(F.col("total_revenue")).alias("total_revenue"),
        "unique_users",
        F.lit(None).cast("string").alias("user_id"),
        F.date_format("window_start", iso).alias("window_start"),
        F.date_format("window_end", iso).alias("window_end"))
