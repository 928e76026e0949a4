"""Anomalies against a direct computation, and de-duplication."""

import random
import statistics
from datetime import datetime, timedelta

import pytest

from orderpulse.operators import orders as op

START = datetime(2024, 1, 1)


def test_anomalies_equal_definition(spark):
    rng = random.Random(5)
    minutes = sorted(rng.sample(range(600), 300))
    values = {m: rng.random() * 10 for m in minutes}
    values[minutes[200]] = 500.0
    rows = [(START + timedelta(minutes=m), START + timedelta(minutes=m + 1), v)
            for m, v in values.items()]
    totals = spark.createDataFrame(
        rows, "window_start timestamp, window_end timestamp, total_revenue double")
    got = {(r.window_start - START).total_seconds() // 60: r
           for r in op.window_anomalies(totals).collect()}
    assert len(got) == len(minutes)
    for m in minutes:
        before = [v for k, v in values.items() if m - 60 <= k < m]
        if len(before) < 3:
            assert got[m].z_score is None and not got[m].is_anomaly
            continue
        score = (values[m] - statistics.mean(before)) / statistics.stdev(before)
        assert got[m].z_score == pytest.approx(score)
        assert got[m].is_anomaly == (abs(score) > 3)
    assert got[minutes[200]].is_anomaly


def test_first_copy_is_kept(spark):
    events = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3)], "order_id string, arrival long")
    got = {r.order_id: r.arrival for r in op.deduplicate_events(events).collect()}
    assert got == {"a": 1, "b": 3}
