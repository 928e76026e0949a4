"""Lifetime statistics per user."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderpulse.functions.customers import customer_tier, is_vip
from orderpulse.functions.money import money_round, order_revenue, safe_average
from orderpulse.functions.times import iso_utc

_SUM = "decimal(38,6)"


def _revenue() -> Column:
    return order_revenue(F.col("price"), F.col("quantity")).cast(_SUM)


def _usable(events: DataFrame, on_bad_value: str) -> DataFrame:
    if on_bad_value == "drop":
        return events.filter(F.col("price").isNotNull() & F.col("quantity").isNotNull())
    if on_bad_value == "count_only":
        return events
    raise ValueError("on_bad_value is 'drop' or 'count_only'")


def first_last_by_arrival(events: DataFrame, ts: str = "timestamp",
                          arrival: str = "arrival") -> DataFrame:
    """Time of the order that arrived first and last, per user; not the least and
    greatest time."""
    return events.groupBy("user_id").agg(*_first_last(ts, arrival))


def _first_last(ts: str, arrival: str) -> list[Column]:
    # Timestamps and longs have a fixed width, so this stays a hash aggregate.
    return [F.min_by(ts, arrival).alias("first_order"),
            F.max_by(ts, arrival).alias("last_order")]


def user_running_stats(events: DataFrame, on_bad_value: str = "drop") -> DataFrame:
    """Count, sum, mean, tier, first and last order per user over all orders so far.

    ``on_bad_value`` decides about an order whose price or quantity is unusable:
    ``'drop'`` leaves it out, ``'count_only'`` counts it without revenue.
    """
    totals = _usable(events, on_bad_value).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.coalesce(F.sum(_revenue()), F.lit(0)).cast(_SUM).alias("revenue"),
        *_first_last("timestamp", "arrival"))
    return finished(totals)


def finished(totals: DataFrame) -> DataFrame:
    """The statistics from (user_id, total_orders, revenue, first_order, last_order)."""
    revenue = F.col("revenue")
    return totals.select(
        "user_id", "total_orders",
        money_round(revenue).alias("total_spent"),
        safe_average(revenue, F.col("total_orders"), 6).alias("avg_order_value"),
        customer_tier(revenue).alias("customer_tier"),
        is_vip(revenue).alias("is_vip"),
        "first_order", "last_order")


def user_running_stats_basic(events: DataFrame) -> DataFrame:
    """Count, sum and mean per user; orders with a bad value count, a null user is a
    group."""
    totals = _usable(events, "count_only").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.coalesce(F.sum(_revenue()), F.lit(0)).cast(_SUM).alias("revenue"))
    return totals.select(
        "user_id", "total_orders",
        money_round(F.col("revenue")).alias("total_spent"),
        safe_average(F.col("revenue"), F.col("total_orders"), 6).alias("avg_order_value"))


def published(stats: DataFrame, window_end: Column) -> DataFrame:
    """Statistics as the rows of one publish; times become ISO text."""
    times = {c: iso_utc(F.col(c)) for c in ("first_order", "last_order") if c in stats.columns}
    return stats.withColumns({**times, "window_end": iso_utc(window_end, "+00:00")})


def publish_summary(stats: DataFrame) -> DataFrame:
    """How many users and VIPs a publish holds."""
    return stats.agg(F.count(F.lit(1)).alias("users"),
                     F.count_if("is_vip").alias("vips"))
