"""Customer insight from the orders and users tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderpulse.functions.customers import (customer_tier, loyalty_score,
                                            predicted_lifetime_value, recommendations,
                                            spending_category)
from orderpulse.functions.money import safe_average
from orderpulse.schemas import MONEY


def orders_for_user(orders: DataFrame, user_id) -> DataFrame:
    """Orders of one user; ids are equal when their texts are.

    A whole-number id column is compared as a number where the asked id is its
    canonical text, so that the filter reaches the file scan.
    """
    if dict(orders.dtypes)["user_id"] in ("int", "bigint"):
        try:
            number = int(str(user_id))
        except ValueError:
            return orders.filter(F.lit(False))
        if str(number) != str(user_id):
            return orders.filter(F.lit(False))
        return orders.filter(F.col("user_id") == number)
    return orders.filter(F.col("user_id").cast("string") == str(user_id))


def user_order_stats(orders: DataFrame) -> DataFrame:
    """Count, sum and mean of the stored totals per user; a null total counts as 0."""
    totals = orders.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.coalesce(F.sum("total_price"), F.lit(0)).cast(MONEY).alias("total_spent"))
    return totals.withColumn(
        "average_order_value", safe_average(F.col("total_spent"), F.col("total_orders")))


def _same_id(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> Column:
    whole = ("int", "bigint")
    numeric = dict(left.dtypes)[left_key] in whole and dict(right.dtypes)[right_key] in whole
    if numeric:
        return left[left_key] == right[right_key]
    return left[left_key].cast("string") == right[right_key].cast("string")


def user_order_profile(users: DataFrame, orders: DataFrame) -> DataFrame:
    """One row for every user with totals, tier, score, prediction, recommendations.

    Orders are summed per user before the join, so a user who holds a large
    share of them costs one row in the join. Orders of unknown users drop out.
    """
    stats = user_order_stats(orders).withColumnRenamed("user_id", "stats_user_id")
    joined = users.join(stats, _same_id(users, "id", stats, "stats_user_id"), "left")
    money = F.lit(0).cast(MONEY)
    count, spent, mean = (F.col("total_orders"), F.col("total_spent"),
                          F.col("average_order_value"))
    return joined.select(
        F.col("id").alias("user_id"), "name", "email",
        F.coalesce(count, F.lit(0)).alias("total_orders"),
        F.coalesce(spent, money).alias("total_spent"),
        F.coalesce(mean, money).alias("average_order_value"),
    ).select(
        "*",
        customer_tier(spent).alias("customer_tier"),
        recommendations(count, mean, spent).alias("recommendations"),
        spending_category(spent).alias("spending_category"),
        loyalty_score(count, spent).alias("loyalty_score"),
        predicted_lifetime_value(spent).alias("predicted_lifetime_value"))


def user_insight(profile: DataFrame) -> DataFrame:
    """The profile as nested records, the shape a caller of the insight gets."""
    return profile.select(
        F.struct("user_id",
                 F.coalesce("name", F.lit("Unknown")).alias("name"),
                 F.coalesce("email", F.lit("Unknown")).alias("email")).alias("user_info"),
        F.struct("total_orders", "total_spent", "average_order_value",
                 "customer_tier").alias("order_analytics"),
        "recommendations",
        F.struct("spending_category", "loyalty_score",
                 "predicted_lifetime_value").alias("insights"))
