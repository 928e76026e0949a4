"""Summary of a load test from its request log."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The thresholds of the load test.
P95_BELOW_MS = 500
FAILED_BELOW = 0.1
ERRORS_BELOW = 0.1


def exact_percentile(df: DataFrame, column: str, p: float,
                     accuracy: int = 10_000) -> float | None:
    """Exact percentile with linear interpolation between neighbouring ranks.

    Each pass brackets the lower rank with an approximate percentile of known error, counts
    exactly how many values lie below, on and between the two ends, and goes on with the
    values strictly between, about four of ``accuracy``; few values are bracketed by
    themselves, which ends it. One more pass finds the upper rank. No task holds a list of
    values, and the driver receives a handful of numbers per pass.
    """
    values = df.select(F.col(column).cast("double").alias("v")).filter("v IS NOT NULL")
    total = values.count()
    if total == 0:
        return None
    position = p * (total - 1)
    low = math.floor(position)
    at_low = _value_at(values, low, total, accuracy)
    if position == low:
        return at_low
    v = F.col("v")
    reached, above = values.agg(F.count_if(v <= at_low), F.min(F.when(v > at_low, v))).first()
    at_high = at_low if reached > low + 1 else above
    return at_low + (at_high - at_low) * (position - low)


def _value_at(values: DataFrame, rank: int, count: int, accuracy: int) -> float:
    """The value with that rank (from 0) among ``count`` values."""
    v = F.col("v")
    while True:
        share, slack = rank / max(1, count - 1), 2 / accuracy
        low, high = values.agg(F.percentile_approx(
            "v", [max(0.0, share - slack), min(1.0, share + slack)], accuracy)).first()[0]
        below, on_low, between, on_high = values.agg(
            F.count_if(v < low), F.count_if(v == low), F.count_if((v > low) & (v < high)),
            F.count_if(v == high)).first()
        if rank < below:
            values, count = values.filter(v < low), below
            continue
        rank -= below
        if rank < on_low:
            return low
        rank -= on_low
        if rank < between:
            values, count = values.filter((v > low) & (v < high)), between
            continue
        rank -= between
        if low < high:
            if rank < on_high:
                return high
            rank -= on_high
            on_low += on_high
        values, count = values.filter(v > high), count - below - on_low - between


def request_summary(requests: DataFrame) -> DataFrame:
    """Requests, failed percent, mean and 95th percentile of the duration."""
    p95 = exact_percentile(requests, "duration_ms", 0.95)
    return requests.agg(
        F.count(F.lit(1)).alias("total_requests"),
        (F.avg(F.col("failed").cast("int")) * 100).alias("failed_pct"),
        F.avg("duration_ms").alias("avg_ms"),
    ).withColumn("p95_ms", F.lit(p95).cast("double"))


def request_errors(requests: DataFrame) -> DataFrame:
    """Share of checks that did not pass."""
    return requests.agg(F.avg((~check_passed()).cast("int")).alias("error_rate"))


def threshold_check(requests: DataFrame) -> DataFrame:
    """Whether the run stayed below each threshold, in one aggregate.

    Where the limit lies among the sorted durations tells whether their percentile is
    below it; only if it falls between the two ranks of the percentile do the values on
    either side count.
    """
    v = F.col("duration_ms").cast("double")
    rank = (F.count(v) - 1) * F.lit(0.95)
    below, low, high = F.count_if(v < P95_BELOW_MS), F.floor(rank), F.ceil(rank)
    left, right = F.max(F.when(v < P95_BELOW_MS, v)), F.min(F.when(v >= P95_BELOW_MS, v))
    fast = (F.when(F.count(v) == 0, F.lit(False)).when(high < below, F.lit(True))
            .when(low >= below, F.lit(False))
            .otherwise(left + (right - left) * (rank - low) < P95_BELOW_MS))
    return requests.agg(
        fast.alias("duration_ok"),
        (F.avg(F.col("failed").cast("int")) < FAILED_BELOW).alias("failed_ok"),
        (F.avg((~check_passed()).cast("int")) < ERRORS_BELOW).alias("errors_ok"))


def check_passed() -> Column:
    """The status a check wants: 201 for a creation (409 too for a user), else 200."""
    check, status = F.col("check"), F.col("status")
    return (F.when(check == "user created", status.isin(201, 409))
            .when(check.endswith("created"), status == 201)
            .otherwise(status == 200))


def check_rate(requests: DataFrame) -> DataFrame:
    """Share of passed requests per check."""
    return requests.groupBy("check").agg(
        F.avg(check_passed().cast("int")).alias("passed_rate"),
        F.count(F.lit(1)).alias("requests"))
