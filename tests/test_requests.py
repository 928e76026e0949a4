"""Exact percentiles and request summaries."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderpulse.operators import requests as rq

REQUEST = "check string, status int, duration_ms double, failed boolean"


@pytest.mark.parametrize("accuracy", [50, 10_000])
@pytest.mark.parametrize("shape", ["spread", "ties", "one value", "hot low", "hot high"])
def test_percentile_equals_brute_force(spark, accuracy, shape):
    rng = random.Random(7)
    values = {
        "spread": [rng.random() * 1000 for _ in range(3000)],
        "ties": [float(rng.randrange(5)) for _ in range(3000)],
        "one value": [4.5] * 500,
        "hot low": [1.0] * 2000 + [rng.random() for _ in range(1000)],
        "hot high": [rng.random() for _ in range(1900)] + [2.0] * 1100,
    }[shape]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double").cache()
    for p in (0.0, 0.95):
        got = rq.exact_percentile(df, "v", p, accuracy=accuracy)
        assert got == pytest.approx(np.percentile(values, p * 100), rel=1e-12)


def test_percentile_of_nothing(spark):
    assert rq.exact_percentile(spark.createDataFrame([], "v double"), "v", 0.95) is None


def test_check_and_thresholds(spark):
    rows = [("user created", 201, 100.0, False), ("user created", 409, 100.0, True),
            ("order created", 200, 100.0, False), ("get users success", 200, 600.0, False)]
    df = spark.createDataFrame(rows, REQUEST)
    rates = {r.check: r.passed_rate for r in rq.check_rate(df).collect()}
    assert rates == {"user created": 1.0, "order created": 0.0, "get users success": 1.0}
    assert rq.threshold_check(df).first().asDict() == {
        "duration_ok": False, "failed_ok": False, "errors_ok": False}
    fine = df.filter(F.col("status") == 201)
    assert rq.threshold_check(fine).first().asDict() == {
        "duration_ok": True, "failed_ok": True, "errors_ok": True}
