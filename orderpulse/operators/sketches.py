"""Distinct users and percentiles that add up over windows.

A count of distinct users or a percentile can't be made from those of smaller windows; a sketch
can. Each stored window keeps a sketch of bounded size beside its totals, so hours, days and the
summary come from the stored minutes, in any order and grouping, without reading events again.
In a stream the state is one such row per window, whatever the number of users.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderpulse.functions.money import order_revenue
from orderpulse.functions.times import window_bounds
from orderpulse.schemas import MONEY

#: Logarithm of the number of registers of a user sketch, and size of a value sketch.
REGISTERS, VALUES = 12, 400
#: Relative error of a user count, and error of a rank, that are passed once in some hundreds
#: of answers: three deviations of a merged sketch, and the sketch's own bound at 99 percent.
USERS_WITHIN = 3 * 1.04 / math.sqrt(1 << REGISTERS)
RANK_WITHIN = 2.446 / VALUES ** 0.9433


def window_sketches(events: DataFrame, size: str = "1 minute", ts: str = "timestamp",
                    user: str = "user_id") -> DataFrame:
    """Orders, revenue and a sketch of the users of each window, in one aggregate.

    A null user counts as an order but not as a user.
    """
    totals = events.groupBy(F.window(ts, size).alias("window")).agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum(order_revenue(F.col("price"), F.col("quantity"))).cast(MONEY)
        .alias("total_revenue"),
        F.hll_sketch_agg(F.col(user).cast("string"), REGISTERS).alias("users"))
    return totals.select(*window_bounds(F.col("window")), "total_orders", "total_revenue", "users")


def roll_up(windows: DataFrame, size: str) -> DataFrame:
    """Larger windows from stored ones, of the same columns; can be rolled up again.

    ``size`` must be a multiple of the size of the stored windows.
    """
    totals = windows.groupBy(F.window("window_start", size).alias("window")).agg(
        F.sum("total_orders").alias("total_orders"),
        F.sum("total_revenue").cast(MONEY).alias("total_revenue"),
        F.hll_union_agg("users").alias("users"))
    return totals.select(*window_bounds(F.col("window")), "total_orders", "total_revenue", "users")


def unique_users(users: Column) -> Column:
    """Distinct users in a sketch: within USERS_WITHIN, exact while they are few."""
    return F.hll_sketch_estimate(users)


def sketched_summary(windows: DataFrame) -> DataFrame:
    """Orders, revenue, distinct users over all windows together, and number of windows."""
    return windows.agg(
        F.coalesce(F.sum("total_orders"), F.lit(0)).alias("total_orders"),
        F.coalesce(F.sum("total_revenue"), F.lit(0)).cast(MONEY).alias("total_revenue"),
        F.coalesce(unique_users(F.hll_union_agg("users")), F.lit(0)).alias("unique_users"),
        F.count(F.lit(1)).alias("data_points"))


def duration_sketches(requests: DataFrame, size: str = "1 minute", ts: str = "ts") -> DataFrame:
    """Requests, failures and a sketch of the durations of each endpoint and window.

    Requests without a duration count as requests only; a window without any has no sketch.
    """
    window = F.window(ts, size).alias("window")
    found = requests.groupBy("endpoint", window).agg(
        F.count(F.lit(1)).alias("requests"), F.count_if("failed").alias("failures"),
        F.kll_sketch_agg_double(F.col("duration_ms").cast("double"), VALUES).alias("durations"),
        F.count("duration_ms").alias("timed"))
    return _with_durations(found, "endpoint")


def roll_up_durations(windows: DataFrame, size: str | None = None) -> DataFrame:
    """Larger windows of each endpoint, or with no ``size`` the whole time of each."""
    window = (F.window("window_start", size) if size else F.struct(
        F.lit(None).cast("timestamp").alias("start"), F.lit(None).cast("timestamp").alias("end")))
    merged = windows.groupBy("endpoint", window.alias("window")).agg(
        F.sum("requests").alias("requests"), F.sum("failures").alias("failures"),
        F.kll_merge_agg_double("durations", VALUES).alias("durations"),
        F.sum("timed").alias("timed"))
    return _with_durations(merged, "endpoint")


def _with_durations(found: DataFrame, key: str) -> DataFrame:
    return found.select(key, *window_bounds(F.col("window")), "requests", "failures", "timed",
                        F.when(F.col("timed") > 0, F.col("durations")).alias("durations"))


def percentile(durations: Column, p: float) -> Column:
    """The value whose rank is ``p``, within RANK_WITHIN; null without durations."""
    return F.kll_sketch_get_quantile_double(durations, F.lit(p))
