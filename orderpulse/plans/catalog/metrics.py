"""Metric-sample and request queries.

Event types stand for metrics: click is CPU time, view and purchase are bytes in
and out, signup is memory or a limit, error counts restarts.
"""

from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from orderpulse.operators import metrics as op
from orderpulse.operators import requests as rq
from orderpulse.plans.catalog.common import REQUESTS, SAMPLES, query, with_
from orderpulse.sources import fixtures as fx

SERIES = "metric, namespace, pod, container, phase, resource, instance"
PODS = "regexp_full_match(pod, '.*-service.*|frontend.*|api-gateway.*')"


def rate_sql(where: str, span: int, step: int, carry_in: bool, factor: str = "") -> str:
    """Growth between neighbours, straight from its definition."""
    in_span = "" if carry_in else f"WHERE epoch_us(before) > (instant - {span}) * 1000000"
    return f"""steps AS (
  SELECT pod, ts, value, lag(value) OVER s AS was, lag(ts) OVER s AS before
  FROM samples WHERE {where} WINDOW s AS (PARTITION BY {SERIES} ORDER BY ts)),
spread AS (
  SELECT pod, before, CASE WHEN value >= was THEN value - was ELSE value END AS grew,
         CAST(ceil(epoch_us(ts) / {step}e6) AS BIGINT) * {step} + k * {step} AS instant
  FROM steps, range({span // step}) AS r(k) WHERE was IS NOT NULL),
rates AS (
  SELECT pod, make_timestamp(instant * 1000000) AS instant, sum(grew) / {span}{factor} AS rate
  FROM spread {in_span} GROUP BY pod, spread.instant)"""


def newest_sql(where: str, name: str = "newest") -> str:
    return f"""{name} AS (
  SELECT {SERIES}, arg_max(value, ts) AS value FROM samples WHERE {where} GROUP BY ALL)"""


CONTAINERS = "container <> '' AND container <> 'POD'"


def _samples(spark, d):
    return fx.metric_samples(spark, d)


def _pods():
    return op.label_regex("pod", op.SERVICE_PODS)


@query("counter_rate_by_pod", with_(SAMPLES, rate_sql(
    f"metric = 'click' AND namespace = 'default' AND {CONTAINERS}", 300, 60, True, " * 100"))
    + "SELECT pod, instant, round(rate, 9) AS rate FROM rates")
def counter_rate_by_pod(spark, d):
    picked = op.select_metric(_samples(spark, d), "click", op.containers_only(),
                              namespace="default")
    return op.counter_rate_by_pod(picked, carry_in=True).withColumn(
        "rate", F.round(F.col("rate") * 100, 9))


@query("counter_rate_by_pod_in_span", with_(SAMPLES, rate_sql(
    f"metric = 'view' AND namespace = 'default' AND {PODS}", 86400, 3600, False))
    + "SELECT pod, instant, round(rate, 9) AS rate FROM rates")
def counter_rate_in_span(spark, d):
    picked = op.select_metric(_samples(spark, d), "view", _pods(), namespace="default")
    return op.counter_rate_by_pod(picked, span=86400, step=3600).withColumn(
        "rate", F.round("rate", 9))


@query("counter_rate_5m_in_span", with_(SAMPLES, rate_sql("true", 300, 60, False))
       + "SELECT pod, instant, round(rate, 9) AS rate FROM rates")
def counter_rate_5m_in_span(spark, d):
    # Events of one instance are hours apart, so few pairs lie within five minutes.
    return op.counter_rate_by_pod(_samples(spark, d)).withColumn("rate", F.round("rate", 9))


@query("gauge_sum_by_pod", with_(SAMPLES, newest_sql(f"metric = 'signup' AND {CONTAINERS}")) + """
SELECT pod, round(sum(value), 2) AS value FROM newest GROUP BY pod""")
def gauge_sum_by_pod(spark, d):
    picked = op.select_metric(_samples(spark, d), "signup", op.containers_only(),
                              namespace="default")
    return op.gauge_sum_by_pod(picked).withColumn("value", F.round("value", 2))


@query("gauge_sum_filtered", with_(SAMPLES, newest_sql("metric = 'error' AND phase = 'Running'"))
       + "SELECT round(sum(value), 2) AS value FROM newest")
def gauge_sum_filtered(spark, d):
    picked = op.select_metric(_samples(spark, d), "error", namespace="default", phase="Running")
    return op.gauge_sum(picked).withColumn("value", F.round("value", 2))


AT, LOOKBACK = datetime(2024, 1, 15, tzinfo=timezone.utc), timedelta(hours=12)
AT_INSTANT = ("namespace = 'default' AND ts > TIMESTAMP '2024-01-14 12:00:00' "
              "AND ts <= TIMESTAMP '2024-01-15 00:00:00'")


@query("gauge_sum_at_instant", with_(SAMPLES, newest_sql(f"metric = 'signup' AND {AT_INSTANT}"))
       + "SELECT pod, round(sum(value), 2) AS value FROM newest GROUP BY pod")
def gauge_sum_at_instant(spark, d):
    picked = op.select_metric(_samples(spark, d), "signup", namespace="default")
    return op.gauge_sum_by_pod(op.at_instant(picked, AT, LOOKBACK)).withColumn(
        "value", F.round("value", 2))


@query("series_count_at_instant", with_(SAMPLES) + f"""
SELECT count(*) AS series FROM (
  SELECT DISTINCT {SERIES} FROM samples WHERE metric = 'view' AND {AT_INSTANT})""")
def series_count_at_instant(spark, d):
    picked = op.select_metric(_samples(spark, d), "view", namespace="default")
    return op.series_count(op.at_instant(picked, AT, LOOKBACK))


@query("series_count", with_(SAMPLES) + f"""
SELECT count(*) AS series FROM (SELECT DISTINCT {SERIES} FROM samples)""")
def series_count(spark, d):
    return op.series_count(_samples(spark, d))


@query("label_regex", with_(SAMPLES) + """
SELECT metric, pod, ts FROM samples WHERE regexp_full_match(pod, '(order|user)-service.*')""")
def label_regex(spark, d):
    return _samples(spark, d).filter(op.label_regex("pod", "(order|user)-service.*")).select(
        "metric", "pod", "ts")


@query("usage_vs_limit", with_(SAMPLES, newest_sql(f"metric = 'view' AND {PODS}", "used"),
                               newest_sql(f"metric = 'signup' AND resource = 'memory' AND {PODS}",
                                          "limits"),
                               "u AS (SELECT pod, sum(value) AS v FROM used GROUP BY pod)",
                               "l AS (SELECT pod, sum(value) AS v FROM limits GROUP BY pod)") + """
SELECT pod, round(u.v / l.v * 100, 6) AS ratio FROM u JOIN l USING (pod)""")
def usage_vs_limit(spark, d):
    samples = _samples(spark, d)
    usage = op.gauge_sum_by_pod(op.select_metric(samples, "view", _pods()))
    limits = op.select_metric(samples, "signup", _pods(), resource="memory")
    return op.usage_vs_limit(usage, limits).withColumn("ratio", F.round("ratio", 6))


@query("rate_vs_limit", with_(SAMPLES, rate_sql(f"metric = 'click' AND {PODS}", 300, 60, True),
                              newest_sql(f"metric = 'signup' AND resource = 'cpu' AND {PODS}",
                                         "limits"),
                              "l AS (SELECT pod, sum(value) AS v FROM limits GROUP BY pod)") + """
SELECT pod, instant, round(rate / l.v * 100, 6) AS ratio FROM rates JOIN l USING (pod)""")
def rate_vs_limit(spark, d):
    samples = _samples(spark, d)
    usage = op.counter_rate_by_pod(op.select_metric(samples, "click", _pods()), carry_in=True)
    limits = op.select_metric(samples, "signup", _pods(), resource="cpu")
    return op.usage_vs_limit(usage, limits, value="rate").withColumn(
        "ratio", F.round("ratio", 6))


@query("metric_ratio", with_(SAMPLES, newest_sql("metric = 'view'", "a"),
                             newest_sql("metric = 'click'", "b"),
                             "x AS (SELECT pod, sum(value) AS v FROM a GROUP BY pod)",
                             "y AS (SELECT pod, sum(value) AS v FROM b GROUP BY pod)") + """
SELECT pod, round(x.v / y.v * 100, 6) AS ratio FROM x JOIN y USING (pod)""")
def metric_ratio(spark, d):
    samples = _samples(spark, d)
    left = op.gauge_sum_by_pod(op.select_metric(samples, "view"))
    right = op.gauge_sum_by_pod(op.select_metric(samples, "click"))
    return op.metric_ratio(left, right).withColumn("ratio", F.round("ratio", 6))


@query("autoscaler_status", with_(SAMPLES) + """
SELECT instance, arg_max(value, ts) FILTER (metric = 'click') AS current,
       arg_max(value, ts) FILTER (metric = 'view') AS desired,
       arg_max(value, ts) FILTER (metric = 'purchase') AS maximum
FROM samples WHERE metric IN ('click', 'view', 'purchase') GROUP BY instance""")
def autoscaler_status(spark, d):
    return op.autoscaler_status(_samples(spark, d), "click", "view", "purchase",
                                name="instance")


@query("request_summary", with_(REQUESTS) + """
SELECT count(*) AS total_requests, round(avg(CAST(failed AS INTEGER)) * 100, 6) AS failed_pct,
       round(avg(duration_ms), 6) AS avg_ms,
       round(quantile_cont(duration_ms, 0.95), 6) AS p95_ms FROM requests""")
def request_summary(spark, d):
    summary = rq.request_summary(fx.requests(spark, d))
    return summary.withColumns({c: F.round(c, 6) for c in ("failed_pct", "avg_ms", "p95_ms")})


CHECKED = """checked AS (
  SELECT *, CASE WHEN "check" = 'user created' THEN status IN (201, 409)
                 WHEN "check" IN ('order created', 'product created') THEN status = 201
                 ELSE status = 200 END AS passed FROM requests)"""


@query("threshold_check", with_(REQUESTS, CHECKED) + """
SELECT quantile_cont(duration_ms, 0.95) < 500 AS duration_ok,
       avg(CAST(failed AS INTEGER)) < 0.1 AS failed_ok,
       avg(1 - CAST(passed AS INTEGER)) < 0.1 AS errors_ok FROM checked""")
def threshold_check(spark, d):
    return rq.threshold_check(fx.requests(spark, d))


@query("check_rate", with_(REQUESTS, CHECKED) + """
SELECT "check", avg(CAST(passed AS INTEGER)) AS passed_rate, count(*) AS requests
FROM checked GROUP BY "check\"""")
def check_rate(spark, d):
    return rq.check_rate(fx.requests(spark, d))


@query("request_errors", with_(REQUESTS, CHECKED) + """
SELECT round(avg(1 - CAST(passed AS INTEGER)), 9) AS error_rate FROM checked""")
def request_errors(spark, d):
    return rq.request_errors(fx.requests(spark, d)).withColumn(
        "error_rate", F.round("error_rate", 9))
