"""Plans without cross joins or Python, and right results when one key is a third."""

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from orderpulse.operators import events as ev
from orderpulse.operators import insight, orders, running, serving, windows
from orderpulse.plans.catalog import QUERIES
from orderpulse.sources import fixtures as fx

SF = "/root/testdata/sf0.001"
START = datetime(2024, 1, 1)
LAZY = sorted(n for n in QUERIES
              if not n.startswith(("stream_", "read_", "write_", "append_", "scan_", "start_",
                                   "upsert_", "compact_", "notify_", "top_users_from")))

EVENT = ("order_id string, user_id string, product_id string, price decimal(10,2), "
         "quantity int, timestamp timestamp, arrival long")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_plan_has_no_slow_operator(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for slow in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas",
                 "FlatMapGroupsInPandas", "Scan ExistingRDD"):
        assert slow not in text, slow


@pytest.mark.parametrize("name", ["latest_per_user", "last_arrival_per_user",
                                  "deduplicate_events"])
def test_newest_row_is_cut_down_before_the_shuffle(spark, name):
    text = plan(QUERIES[name](spark, SF))
    above, below = text.split("Exchange hashpartitioning", 1)
    assert "row_number(), 1, Final" in above and "row_number(), 1, Partial" in below


@pytest.mark.parametrize("name", ["user_running_stats", "user_order_stats", "gauge_sum_by_pod",
                                  "result_counters", "first_last_by_arrival"])
def test_sums_are_hash_aggregates(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "HashAggregate" in text and "SortAggregate" not in text


def test_key_filter_reaches_the_scan(spark):
    text = plan(QUERIES["orders_for_user"](spark, SF))
    assert "EqualTo(o_custkey,7)" in text
    text = plan(QUERIES["gauge_sum_by_pod"](spark, SF))
    assert "EqualTo(event_type,signup)" in text and "props" not in text


def test_messages_are_parsed_once(spark):
    messages = fx.as_read(fx.order_messages(spark, SF))
    for df in (ev.order_events(messages), ev.cast_with_defaults(messages),
               ev.rejects(messages, timed=True)):
        assert plan(df).count("from_json") == 1


@pytest.fixture(scope="module")
def hot():
    """Events of which a third belong to one user and a third to one minute."""
    rng = random.Random(11)
    rows = []
    for i in range(6000):
        user = "hot" if i % 3 == 0 else str(rng.randrange(200))
        second = rng.randrange(60) if i % 3 == 1 else rng.randrange(36000)
        rows.append((str(i // 2), user, f"p{rng.randrange(9)}", D(rng.randrange(10000)) / 100,
                     rng.randrange(1, 6), START + timedelta(seconds=second), i))
    return rows


@pytest.fixture(scope="module")
def hot_events(spark, hot):
    return spark.createDataFrame(hot, EVENT).repartition(8)


def test_hot_user_statistics(hot, hot_events):
    spent, count = defaultdict(D), Counter()
    for _, user, _, price, quantity, _, _ in hot:
        spent[user] += price * quantity
        count[user] += 1
    got = {r.user_id: r for r in running.user_running_stats(hot_events).collect()}
    assert {u: (r.total_orders, r.total_spent) for u, r in got.items()} == {
        u: (count[u], spent[u]) for u in count}
    mine = [r for r in hot if r[1] == "hot"]
    assert (got["hot"].first_order, got["hot"].last_order) == (mine[0][5], mine[-1][5])


def test_hot_minute_totals(hot, hot_events):
    users, count, spent = defaultdict(set), Counter(), defaultdict(D)
    for _, user, _, price, quantity, ts, _ in hot:
        minute = ts.replace(second=0)
        users[minute].add(user)
        count[minute] += 1
        spent[minute] += price * quantity
    got = windows.window_totals(hot_events).collect()
    assert {r.window_start: (r.unique_users, r.total_orders, r.total_revenue) for r in got} == {
        m: (len(users[m]), count[m], spent[m]) for m in count}


def test_hot_key_newest_rows_and_copies(hot, hot_events):
    last = {}
    for row in hot:
        last[row[1]] = row[6]
    got = {r.user_id: r.arrival for r in serving.last_arrival_per_user(hot_events).collect()}
    assert got == last
    first = {}
    for row in hot:
        first.setdefault(row[0], row[6])
    kept = {r.order_id: r.arrival for r in orders.deduplicate_events(hot_events).collect()}
    assert kept == first


def test_hot_product_is_split_in_the_join(spark, tmp_path):
    small = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB"}
    before = {k: spark.conf.get(k, None) for k in small}
    number = F.col("id")
    product = F.when(number % 3 != 0, "p0").otherwise(F.concat(F.lit("q"), number.cast("string")))
    rows = spark.range(200_000, numPartitions=8)
    tables = {
        "items": rows.select(number.alias("order_id"), F.lit(1).alias("line_number"),
                             F.lit(1).alias("quantity"), F.rand(1).alias("line_price"),
                             product.alias("product_id")),
        "orders": rows.select(number.alias("order_id"), (number % 100).alias("user_id")),
        "products": rows.select(product.alias("product_id")).distinct().withColumn(
            "name", F.col("product_id"))}
    read = {}
    for name, table in tables.items():
        table.write.parquet(f"{tmp_path}/{name}")
        read[name] = spark.read.parquet(f"{tmp_path}/{name}")
    try:
        for key, value in small.items():
            spark.conf.set(key, value)
        lines = orders.order_lines(read["orders"], read["items"], read["products"])
        assert lines.count() == 200_000
        lines.write.parquet(f"{tmp_path}/lines")
        lines.tail(1)
        text = plan(lines)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert "skew=true" in text
    assert spark.read.parquet(f"{tmp_path}/lines").filter("name <> product_id").count() == 0


def test_hot_user_profile_and_hot_email(spark, hot, hot_events):
    total = F.col("price") * F.col("quantity")
    spending = hot_events.select("user_id", total.alias("total_price"))
    users = spark.createDataFrame([("hot", "H", "h@x"), ("none", "N", "n@x")],
                                  "id string, name string, email string")
    got = {r.user_id: r for r in insight.user_order_profile(users, spending).collect()}
    mine = [r[3] * r[4] for r in hot if r[1] == "hot"]
    assert (got["hot"].total_orders, got["hot"].total_spent) == (len(mine), sum(mine))
    assert got["none"].total_orders == 0
    posts = hot_events.select(F.col("arrival").alias("id"), F.col("user_id").alias("email"))
    taken = spark.createDataFrame([("7",), ("7",)], "email string")
    checked = ev.reject_duplicate_email(posts, taken, "id")
    assert checked.count() == len(hot)
    first = {}
    for row in hot:
        first.setdefault(row[1], row[6])
    first.pop("7", None)
    kept = {r.email: r.id for r in checked.filter("error IS NULL").collect()}
    assert kept == first
