"""Sketches of stored windows: bounds, order of merging, odd rows."""

import random

from pyspark.sql import functions as F

from orderpulse.operators import sketches

EVENTS = "timestamp timestamp, user_id string, price decimal(10,2), quantity long"


def events(spark, n, users):
    return spark.range(n).select(
        F.timestamp_seconds(F.col("id") % 86_400).alias("timestamp"),
        (F.xxhash64("id") % users).cast("string").alias("user_id"),
        F.lit("2.50").cast("decimal(10,2)").alias("price"), F.lit(2).cast("long").alias("quantity"))


def test_days_from_minutes_are_within_the_bound(spark):
    rows = events(spark, 300_000, 60_000)
    exact = rows.select("user_id").distinct().count()
    minutes = sketches.window_sketches(rows)
    by_hour = sketches.roll_up(sketches.roll_up(minutes, "1 hour"), "1 day").first()
    at_once = sketches.window_sketches(rows, "1 day").first()
    for row in (by_hour, at_once):
        found = spark.createDataFrame([(bytes(row.users),)], "users binary").select(
            sketches.unique_users(F.col("users"))).first()[0]
        assert abs(found - exact) <= exact * sketches.USERS_WITHIN
    assert (by_hour.total_orders, by_hour.total_revenue) == (300_000, 1_500_000)
    assert sketches.sketched_summary(minutes).first().data_points == 1440


def test_few_users_are_exact_and_nobody_is_none(spark):
    rows = spark.createDataFrame(
        [(None, "a", None, 1)] * 2 + [(1, u, None, 1) for u in ("a", "b", "a", None)],
        "t long, user_id string, price decimal(10,2), quantity long").withColumn(
        "timestamp", F.timestamp_seconds("t"))
    row = sketches.sketched_summary(sketches.window_sketches(rows)).first()
    assert (row.total_orders, row.unique_users, row.total_revenue) == (4, 2, 0)
    none = sketches.sketched_summary(sketches.window_sketches(rows.limit(0))).first()
    assert tuple(none) == (0, 0, 0, 0)


def test_percentiles_whatever_the_order_of_merging(spark):
    rng = random.Random(8)
    values = [rng.lognormvariate(3, 2) for _ in range(40_000)]
    rows = spark.createDataFrame([(i % 3600, "e", v, False) for i, v in enumerate(values)],
                                 "t long, endpoint string, duration_ms double, failed boolean")
    rows = rows.withColumn("ts", F.timestamp_seconds("t"))
    minutes = sketches.duration_sketches(rows)
    ordered = sorted(values)
    for way in (sketches.roll_up_durations(minutes.orderBy("window_start")),
                sketches.roll_up_durations(minutes.orderBy(F.desc("window_start"))),
                sketches.roll_up_durations(sketches.roll_up_durations(minutes, "10 minutes"))):
        row = way.select("requests", *(sketches.percentile(F.col("durations"), p).alias(f"p{k}")
                                       for k, p in enumerate((0.05, 0.5, 0.95, 0.99)))).first()
        assert row.requests == 40_000
        for value, p in zip(row[1:], (0.05, 0.5, 0.95, 0.99)):
            rank = sum(v <= value for v in ordered) / len(ordered)
            assert abs(rank - p) <= sketches.RANK_WITHIN + 1e-4


def test_requests_without_duration(spark):
    rows = spark.createDataFrame([(1, "a", None, True), (1, "b", 5.0, False), (None, "b", 1.0, False)],
                                 "t long, endpoint string, duration_ms double, failed boolean")
    found = sketches.duration_sketches(rows.withColumn("ts", F.timestamp_seconds("t")))
    got = {r.endpoint: tuple(r[1:]) for r in sketches.roll_up_durations(found).select(
        "endpoint", "requests", "failures", sketches.percentile(F.col("durations"), 0.95)).collect()}
    assert got == {"a": (1, 1, None), "b": (1, 0, 5.0)}
