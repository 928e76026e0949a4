"""Queries on labelled metric samples.

A series is one metric name with one set of labels, and holds at most one sample
per timestamp.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderpulse.schemas import LABELS

SERIES = ("metric", *LABELS)

# Fixed value: the workload pods of the dashboard.
SERVICE_PODS = ".*-service.*|frontend.*|api-gateway.*"


def label_regex(label: str, pattern: str) -> Column:
    """The whole label matches the pattern; a missing label is the empty text."""
    return F.coalesce(F.col(label), F.lit("")).rlike(f"^(?:{pattern})$")


def select_metric(samples: DataFrame, metric: str, *where: Column, **equal: str) -> DataFrame:
    """Samples of one metric with the given labels; reaches the file scan as a filter."""
    picked = samples.filter(F.col("metric") == metric)
    for label, value in equal.items():
        picked = picked.filter(F.col(label) == value)
    for condition in where:
        picked = picked.filter(condition)
    return picked


def containers_only() -> Column:
    """Leaves out the samples of the pod sandbox and of the pod as a whole."""
    return (F.col("container") != "") & (F.col("container") != "POD")


def _present_labels(samples: DataFrame) -> list[str]:
    return [c for c in SERIES if c in samples.columns]


def _grew(value: Column, before: Column) -> Column:
    # A counter that fell was reset, and has counted from 0 since.
    return F.when(value >= before, value - before).when(value < before, value)


def counter_rate_by_pod(samples: DataFrame, *, span: int = 300, step: int = 60,
                        by: str = "pod", carry_in: bool = False) -> DataFrame:
    """Growth per second of the counters of each pod over the last ``span`` seconds,
    at every whole ``step`` seconds; a span ends with its instant and is open on
    the left.

    Growth is taken between neighbouring samples of a series that both lie in the
    span; with ``carry_in`` a sample also counts what it grew over its predecessor
    before the span. Values are not extrapolated to the edges of the span.

    Copies of a sample are folded in each task first. Samples are then cut into
    cells of one series and one step, so the rows of a busy series are spread over
    time, and a cell holds no more rows than a step has timestamps. One row per
    cell goes on to the comparison across cells, and sums per pod and step come
    before the spread over the instants.
    """
    if span % step:
        raise ValueError("span must be a multiple of step")
    series = _present_labels(samples)
    # The first instant at or after the sample, in seconds.
    cell = F.ceil(F.unix_micros("ts") / F.lit(step * 1_000_000)) * step
    single = samples.groupBy(*series, "ts").agg(F.max("value").alias("value"))
    cells = single.withColumn("cell", cell)
    in_cell = W.partitionBy(*series, "cell").orderBy("ts")
    cells = (cells
             .withColumn("was", F.lag("value").over(in_cell))
             .withColumn("grew", _grew(F.col("value"), F.col("was")))
             .groupBy(*series, "cell")
             .agg(F.sum("grew").alias("inside"),
                  F.min_by("value", "ts").alias("first"),
                  F.max_by("value", "ts").alias("last")))
    over_cells = W.partitionBy(*series).orderBy("cell")
    cells = (cells
             .withColumn("last_before", F.lag("last").over(over_cells))
             .withColumn("cell_before", F.lag("cell").over(over_cells))
             .withColumn("across", _grew(F.col("first"), F.col("last_before"))))
    whole = span // step
    gap = ((F.col("cell") - F.col("cell_before")) / step).cast("int")
    reach = F.lit(whole) if carry_in else F.lit(whole) - gap
    parts = (cells.select(by, "cell", F.explode(F.array(
        F.struct(F.col("inside").alias("grew"), F.lit(whole).alias("instants")),
        F.struct(F.col("across").alias("grew"), reach.alias("instants")))).alias("part"))
        .select(by, "cell", "part.*")
        .filter(F.col("grew").isNotNull() & (F.col("instants") > 0)))
    per_cell = parts.groupBy(by, "cell", "instants").agg(F.sum("grew").alias("grew"))
    instants = F.sequence(F.col("cell"), F.col("cell") + (F.col("instants") - 1) * step,
                          F.lit(step).cast("bigint"))
    return (per_cell.select(by, "grew", F.explode(instants).alias("instant"))
            .groupBy(by, "instant")
            .agg((F.sum("grew") / span).alias("rate"))
            .select(by, F.timestamp_seconds("instant").alias("instant"), "rate"))


def at_instant(samples: DataFrame, at: datetime | Column,
               lookback: timedelta = timedelta(minutes=5)) -> DataFrame:
    """The samples that count at an instant: none after it and none older than ``lookback``.

    Put before the gauges and counts below, so that a series which has ended no longer
    counts. The limits reach the file scan, which then reads no other times.
    """
    end = at if isinstance(at, Column) else F.lit(at)
    return samples.filter((F.col("ts") > end - F.lit(lookback)) & (F.col("ts") <= end))


def newest_per_series(samples: DataFrame) -> DataFrame:
    """The last value of each series; timestamp and value have a fixed width, so this
    is a hash aggregate that shrinks each series to one row before the shuffle."""
    series = _present_labels(samples)
    return samples.groupBy(*series).agg(F.max_by("value", "ts").alias("value"),
                                        F.max("ts").alias("ts"))


def gauge_sum_by_pod(samples: DataFrame, by: str = "pod") -> DataFrame:
    return newest_per_series(samples).groupBy(by).agg(F.sum("value").alias("value"))


def gauge_sum(samples: DataFrame) -> DataFrame:
    """One total over the newest values of the selected series."""
    return newest_per_series(samples).agg(F.sum("value").alias("value"))


def series_count(samples: DataFrame) -> DataFrame:
    """Number of distinct series."""
    series = _present_labels(samples)
    return samples.select(*series).distinct().agg(F.count(F.lit(1)).alias("series"))


def metric_ratio(left: DataFrame, right: DataFrame, left_value: str = "value",
                 right_value: str = "value", on: str = "pod", factor: float = 100) -> DataFrame:
    """Left over right, times ``factor``, for the pods on both sides.

    Both sides are aggregates, so the join sees a few rows per pod.
    """
    limits = right.select(on, F.col(right_value).alias("_right"))
    keep = [c for c in left.columns if c not in (on, left_value)]
    ratio = F.try_divide(F.col(left_value), F.col("_right")) * factor
    return left.join(limits, on).select(on, *keep, ratio.alias("ratio"))


def usage_vs_limit(usage: DataFrame, limits: DataFrame, value: str = "value") -> DataFrame:
    """Usage per pod as percent of the pod's limits; ``limits`` are samples."""
    return metric_ratio(usage, gauge_sum_by_pod(limits), left_value=value)


def autoscaler_status(samples: DataFrame, current: str, desired: str, maximum: str,
                      name: str = "pod") -> DataFrame:
    """Current, desired and greatest replica count of each autoscaler, side by side."""
    names = {current: "current", desired: "desired", maximum: "maximum"}
    wide = (samples.filter(F.col("metric").isin(*names))
            .groupBy(name).pivot("metric", list(names)).agg(F.max_by("value", "ts")))
    return wide.select(name, *[F.col(f"`{metric}`").alias(alias)
                               for metric, alias in names.items()])
