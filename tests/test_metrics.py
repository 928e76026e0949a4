"""Counter rates against a direct computation; gauges, ratios and label patterns."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest

from orderpulse.operators import metrics as op

START = datetime(2024, 1, 1)
SAMPLE = "metric string, pod string, instance string, ts timestamp, value double"


def samples(spark, rows):
    """Rows of (pod, instance, second, value)."""
    return spark.createDataFrame(
        [("m", pod, inst, START + timedelta(seconds=s), v) for pod, inst, s, v in rows], SAMPLE)


def rates(df, **options):
    return {(r.pod, (r.instant - START).total_seconds()): r.rate
            for r in op.counter_rate_by_pod(df, **options).collect()}


def direct(rows, span, step, carry_in):
    series = defaultdict(list)
    for pod, inst, second, value in rows:
        series[pod, inst].append((second, value))
    found = defaultdict(float)
    for (pod, _), points in series.items():
        points.sort()
        for (s0, v0), (s1, v1) in zip(points, points[1:]):
            grew = v1 - v0 if v1 >= v0 else v1
            first = -(-s1 // step) * step
            for t in range(int(first), int(first) + span, step):
                if t - span < s1 <= t and (carry_in or s0 > t - span):
                    found[pod, float(t)] += grew / span
    return dict(found)


@pytest.mark.parametrize("carry_in", [False, True])
def test_rate_equals_definition(spark, carry_in):
    rng = random.Random(3)
    rows = set()
    for _ in range(400):
        rows.add((rng.choice("ab"), rng.choice("xyz"), rng.randrange(4000)))
    rows = [(*r, float(rng.randrange(100))) for r in sorted(rows)]
    got = rates(samples(spark, rows), carry_in=carry_in)
    want = direct(rows, 300, 60, carry_in)
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k]) for k in want)


def test_reset_counts_the_new_value(spark):
    rows = [("a", "x", 10, 50.0), ("a", "x", 20, 5.0), ("a", "x", 30, 8.0)]
    assert rates(samples(spark, rows))[("a", 60.0)] == pytest.approx(8 / 300)


def test_copies_of_a_sample_count_once(spark):
    rows = [("a", "x", 10, 1.0)] * 50 + [("a", "x", 20, 7.0)] * 50
    assert rates(samples(spark, rows))[("a", 60.0)] == pytest.approx(6 / 300)


def test_span_is_open_on_the_left(spark):
    rows = [("a", "x", 0, 1.0), ("a", "x", 300, 7.0)]
    assert rates(samples(spark, rows)) == {}
    assert set(rates(samples(spark, rows), carry_in=True)) == {
        ("a", t) for t in (300.0, 360.0, 420.0, 480.0, 540.0)}


def test_span_must_fit_the_step(spark):
    with pytest.raises(ValueError):
        op.counter_rate_by_pod(samples(spark, [("a", "x", 0, 1.0)]), span=100, step=60)


def test_newest_value_of_each_series(spark):
    rows = [("a", "x", 1, 5.0), ("a", "x", 9, 2.0), ("a", "y", 4, 3.0), ("b", "x", 1, 7.0)]
    df = samples(spark, rows)
    assert {r.pod: r.value for r in op.gauge_sum_by_pod(df).collect()} == {"a": 5.0, "b": 7.0}
    assert op.gauge_sum(df).first().value == 12.0
    assert op.series_count(df).first().series == 3


def test_ratio_keeps_pods_of_both_sides(spark):
    left = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 1.0)], "pod string, value double")
    right = spark.createDataFrame([("a", 4.0), ("d", 1.0), ("c", 0.0)], "pod string, value double")
    got = {r.pod: r.ratio for r in op.metric_ratio(left, right).collect()}
    assert got == {"a": 25.0, "c": None}


def test_pattern_matches_whole_label(spark):
    df = spark.createDataFrame([("order-service-1",), ("frontend",), ("my-frontend",), (None,)],
                               "pod string")
    got = [r.pod for r in df.filter(op.label_regex("pod", op.SERVICE_PODS)).collect()]
    assert got == ["order-service-1", "frontend"]


def test_a_series_that_ended_does_not_count(spark):
    df = samples(spark, [("a", "1", 0, 5.0), ("a", "1", 900, 7.0), ("b", "1", 0, 3.0),
                         ("c", "1", 1000, 2.0), ("d", "1", 600, 1.0)])
    now = op.at_instant(df, START + timedelta(seconds=900))
    assert {r.pod: r.value for r in op.gauge_sum_by_pod(now).collect()} == {"a": 7.0}
    assert op.series_count(now).first().series == 1


def test_the_instant_reaches_the_scan(spark, tmp_path):
    samples(spark, [("a", "1", 0, 5.0)]).write.parquet(str(tmp_path / "m"))
    now = op.at_instant(spark.read.parquet(str(tmp_path / "m")), START)
    plan = now._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):].split("\n")[0]
    assert "GreaterThan(ts" in pushed and "LessThanOrEqual(ts" in pushed
