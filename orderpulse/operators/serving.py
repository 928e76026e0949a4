"""Reads over published results: newest rows, rankings, summaries, look-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderpulse.functions.customers import vip_filter
from orderpulse.schemas import MONEY


def at_most(df: DataFrame, n: int) -> DataFrame:
    if n < 0:
        raise ValueError("limit must not be negative")
    return df.limit(n)


def has_user_id(results: DataFrame) -> DataFrame:
    """Rows that belong to a user; null, empty and 0 do not."""
    user = F.col("user_id")
    if dict(results.dtypes)["user_id"] == "string":
        return results.filter(user.isNotNull() & (user != ""))
    return results.filter(user.isNotNull() & (user != 0))


def stream_row_defaults(results: DataFrame) -> DataFrame:
    """Result rows with the defaults of a reader: 0 spent, no VIP, empty window end."""
    return results.withColumns({
        "total_spent": F.coalesce("total_spent", F.lit(0)),
        "is_vip": F.coalesce("is_vip", F.lit(False)),
        "window_end": F.coalesce("window_end", F.lit(""))})


def _first_row(df: DataFrame, key: str, *order: Column) -> DataFrame:
    # Spark keeps one row per key in each task before the shuffle (WindowGroupLimit),
    # so a key with very many rows does not reach one task whole.
    ranked = df.withColumn("_rank", F.row_number().over(W.partitionBy(key).orderBy(*order)))
    return ranked.filter("_rank = 1").drop("_rank")


def latest_per_user(results: DataFrame) -> DataFrame:
    """Per user the row with the greatest ``window_end`` text; of equal ones the
    earliest arrival."""
    window_end = F.coalesce("window_end", F.lit(""))
    return _first_row(has_user_id(results), "user_id",
                      window_end.desc(), F.col("arrival").asc())


def last_arrival_per_user(results: DataFrame) -> DataFrame:
    """Per user the row that arrived last; rows without a user form one group."""
    return _first_row(results, "user_id", F.col("arrival").desc())


def _by_spent() -> list[Column]:
    return [F.coalesce("total_spent", F.lit(0)).desc(), F.col("user_id").asc_nulls_first()]


def top_users(results: DataFrame, limit: int = 10) -> DataFrame:
    """The users who spent most, by their newest rows."""
    return at_most(latest_per_user(results).orderBy(*_by_spent()), limit)


def top_vip_users(results: DataFrame, n: int = 10) -> DataFrame:
    """The VIPs who spent most, by the rows that arrived last."""
    vips = last_arrival_per_user(results).filter(
        vip_filter(F.col("is_vip"), F.col("total_spent")))
    return at_most(vips.orderBy(*_by_spent()), n)


def vip_leaderboard(stats: DataFrame, n: int = 10, numbered: int = 3) -> DataFrame:
    """The ``n`` VIPs who spent most; the first ``numbered`` carry their rank."""
    top = at_most(stats.filter("is_vip").orderBy(*_by_spent()), n)
    # The window sees the n rows of the ranking only.
    rank = F.row_number().over(W.orderBy(*_by_spent()))
    return top.withColumn("_rank", rank).select(
        *stats.columns, F.when(F.col("_rank") <= numbered, F.col("_rank")).alias("rank"))


def recent_windows(items: DataFrame, n: int = 10, max_rows: int | None = None) -> DataFrame:
    """The newest items by ``timestamp`` text.

    With ``max_rows`` only that many items are looked at, taken in key order.
    """
    if max_rows is not None:
        items = scan_limited(items, max_rows, "window_id")
    newest = F.coalesce("timestamp", F.lit("")).desc()
    return at_most(items.orderBy(newest, F.col("window_id")), n)


def scan_limited(df: DataFrame, n: int, key: str) -> DataFrame:
    """At most ``n`` rows, the first by ``key`` so that the answer is the same each time."""
    return at_most(df.orderBy(key), n)


def analytics_summary(items: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Orders, revenue, distinct users and number of items."""
    if max_rows is not None:
        items = scan_limited(items, max_rows, "window_id")
    return items.agg(
        F.coalesce(F.sum("order_count"), F.lit(0)).alias("total_orders"),
        F.coalesce(F.round(F.sum("total_revenue"), 2), F.lit(0)).cast(MONEY)
        .alias("total_revenue"),
        F.countDistinct(F.nullif("user_id", F.lit(""))).alias("unique_users"),
        F.count(F.lit(1)).alias("data_points"))


def result_counters(results: DataFrame, n: int = 10) -> DataFrame:
    """Messages read, users seen (rows without one count as a user), and VIPs:
    ``vip_count`` as listed, at most ``n``; ``vip_total`` all of them."""
    per_user = results.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("messages"),
        F.max_by("is_vip", "arrival").alias("is_vip"),
        F.max_by("total_spent", "arrival").alias("total_spent"))
    vips = F.count_if(vip_filter(F.col("is_vip"), F.col("total_spent")))
    return per_user.agg(
        F.coalesce(F.sum("messages"), F.lit(0)).alias("messages_processed"),
        F.count(F.lit(1)).alias("total_users"),
        F.least(vips, F.lit(n).cast("bigint")).alias("vip_count"),
        vips.alias("vip_total"))


def users_analyzed(results: DataFrame) -> DataFrame:
    """Number of users behind a top-users answer."""
    return has_user_id(results).agg(F.countDistinct("user_id").alias("total_users_analyzed"))


def lookup_by_key(df: DataFrame, key: str, value) -> DataFrame:
    """The row with that key; no row when there is none."""
    return df.filter(F.col(key) == F.lit(value))
