"""Limits, the worked example, and the traps, each on a few rows."""

import random
from datetime import datetime
from decimal import ROUND_HALF_UP
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from orderpulse.functions import customers as cu
from orderpulse.functions import money as mo
from orderpulse.functions.text import file_envelope, processed_key
from orderpulse.functions.times import iso_utc, parse_iso
from orderpulse.operators import events as ev
from orderpulse.operators import insight, running, serving, windows
from orderpulse.operators.files import process_files

MONEY = "decimal(38,2)"
EVENT = "user_id string, price decimal(10,2), quantity int, timestamp timestamp, arrival long"


def at(second, micro=0):
    return datetime(2024, 1, 1, 0, second // 60, second % 60, micro)


def raw(spark, *texts):
    rows = [(t, i, at(i)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "value string, arrival long, timestamp timestamp")


def column(spark, values, kind, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v")).alias("o")).collect()]


def test_worked_example(spark):
    users = spark.createDataFrame([(1, "A", "a@example.com"), (2, "B", "b@example.com")],
                                  "id long, name string, email string")
    prices = [D("5233.31")] * 6
    orders = spark.createDataFrame([(1, p) for p in prices],
                                   "user_id long, total_price decimal(10,2)")
    rows = {r.user_id: r for r in insight.user_order_profile(users, orders).collect()}
    one = rows[1]
    assert (one.total_orders, one.total_spent, one.average_order_value) == (
        6, D("31399.86"), D("5233.31"))
    assert (one.customer_tier, one.spending_category, one.loyalty_score) == (
        "VIP", "High Spender", 100)
    assert one.predicted_lifetime_value == D("47099.79")
    assert one.recommendations == [cu.LOYALTY_TEXT, cu.PREMIUM_TEXT, cu.TOP_VIP_TEXT]
    none = rows[2]
    assert (none.total_orders, none.total_spent, none.average_order_value,
            none.customer_tier, none.recommendations) == (0, 0, 0, "Regular", [])


def test_tier_limits(spark):
    values = [D(v) for v in ("4999.99", "5000", "5000.01", "10000", "10000.01")]
    assert column(spark, values, MONEY, cu.customer_tier) == [
        "Regular", "Regular", "Premium", "Premium", "VIP"]
    assert column(spark, values, MONEY, cu.is_vip) == [False] * 4 + [True]


def test_category_limits(spark):
    values = [D(v) for v in ("1000", "1000.01", "10000", "10000.01")]
    assert column(spark, values, MONEY, cu.spending_category) == [
        "New Customer", "Moderate Spender", "Moderate Spender", "High Spender"]


def test_recommendation_limits(spark):
    rows = [(5, D(1000), D(20000)), (6, D(1000), D(20000)),
            (5, D("1000.01"), D(20000)), (5, D(1000), D("20000.01"))]
    df = spark.createDataFrame(rows, f"n long, mean {MONEY}, spent {MONEY}")
    texts = cu.recommendations(F.col("n"), F.col("mean"), F.col("spent"))
    assert [r[0] for r in df.select(texts).collect()] == [
        [], [cu.LOYALTY_TEXT], [cu.PREMIUM_TEXT], [cu.TOP_VIP_TEXT]]


def test_score_is_cut_not_rounded(spark):
    score = lambda v: cu.loyalty_score(F.lit(1), v)
    values = [D("89.99"), D("8999.99"), D("9000"), D("1e30")]
    assert column(spark, values, MONEY, score) == [10, 99, 100, 100]


def test_average_rounds_once(spark):
    df = spark.createDataFrame([(D("0.05"), 2), (D("1"), 0), (D("-0.05"), 2),
                                (D("2.67"), 1), (D("26749.99"), 10000)],
                               f"total {MONEY}, n long")
    mean = mo.safe_average(F.col("total"), F.col("n"))
    assert [r[0] for r in df.select(mean).collect()] == [
        D("0.03"), 0, D("-0.03"), D("2.67"), D("2.67")]


@pytest.mark.parametrize("scale", [2, 6])
def test_average_equals_exact_division(spark, scale):
    rng = random.Random(scale)
    rows = []
    for _ in range(2000):
        count = rng.choice([1, 2, 3, 7, 200, 12345, 10 ** 9])
        total = D(rng.randrange(-10 ** 12, 10 ** 12)).scaleb(-scale)
        rows.append((total, count, (total / count).quantize(D("0.01"), ROUND_HALF_UP)))
    df = spark.createDataFrame(rows, f"total decimal(38,{scale}), n long, want {MONEY}")
    mean = mo.safe_average(F.col("total"), F.col("n"), scale)
    assert df.filter(mean != F.col("want")).collect() == []


def test_money_rounds_half_up(spark):
    assert column(spark, [D("2.675"), D("-2.675")], "decimal(10,3)", mo.money_round) == [
        D("2.68"), D("-2.68")]


def test_two_revenues(spark):
    # A line total of 100 for two units counts twice as streaming revenue.
    events = spark.createDataFrame([("1", D(100), 2, at(0), 0)], EVENT)
    orders = spark.createDataFrame([(1, D(100))], "user_id long, total_price decimal(10,2)")
    assert running.user_running_stats(events).first().total_spent == 200
    assert insight.user_order_stats(orders).first().total_spent == 100


def test_bad_price_policies(spark):
    texts = ('{"user_id":"1","price":"x"}', '{"user_id":"1","price":5,"quantity":"2.7"}',
             '{"user_id":"1","price":"2.5","quantity":2.7}')
    events = ev.cast_with_defaults(raw(spark, *texts))
    dropped = running.user_running_stats(events).first()
    assert (dropped.total_orders, dropped.total_spent) == (1, D("5.00"))
    counted = running.user_running_stats_basic(events).first()
    assert (counted.total_orders, counted.total_spent) == (3, D("5.00"))
    alone = ev.cast_with_defaults(raw(spark, texts[0]))
    assert running.user_running_stats(alone).collect() == []
    assert running.user_running_stats(alone, "count_only").first().total_orders == 1


def test_unknown_policy_is_refused(spark):
    with pytest.raises(ValueError):
        running.user_running_stats(spark.createDataFrame([], EVENT), "ignore")


def test_defaults_for_missing_and_null(spark):
    texts = ('{"user_id":1}', '{"user_id":1,"price":null,"quantity":null}')
    lenient = ev.cast_with_defaults(raw(spark, *texts)).orderBy("arrival").collect()
    assert [(r.price, r.quantity) for r in lenient] == [(0, 1), (0, 1)]
    assert all(r.timestamp is not None for r in lenient)
    strict = ev.cast_with_defaults(raw(spark, *texts), null_is_bad=True).orderBy("arrival")
    assert [(r.price, r.quantity) for r in strict.collect()] == [(0, 1), (None, None)]


def test_missing_user_by_operator(spark):
    one = raw(spark, '{"price":5}')
    assert ev.cast_with_defaults(one, missing_user="None").first().user_id == "None"
    assert ev.cast_with_defaults(one).first().user_id is None
    assert ev.parse_user_key(one).first().user_id == "unknown"
    assert ev.order_events(one).first().user_id is None


def test_user_key_of_odd_messages(spark):
    texts = ("nope", '{"user_id":null}', '{"user_id":{"a":1}}', '{"user_id":[7]}', "[1]", None,
             '{"user_id":12}', '{"user_id":""}', '{"user_id":"{x"}', '{"user_id":true}')
    keys = ev.parse_user_key(raw(spark, *texts)).orderBy("arrival").collect()
    assert [r.user_id for r in keys] == ["unknown"] * 6 + ["12", "", "{x", "true"]
    assert {r["count"] for r in keys} == {1}


def test_malformed_goes_to_rejects(spark):
    texts = ("nope", "", None, "[1,2]", '"text"', '{"order_id":"9"}')
    messages = raw(spark, *texts)
    assert [r.order_id for r in ev.order_events(messages).collect()] == ["9"]
    assert [r.value for r in ev.rejects(messages).orderBy("arrival").collect()] == list(texts[:5])


def test_messages_without_time_can_be_rejected(spark):
    texts = ("nope", '{"order_id":"9"}', '{"timestamp":"soon"}',
             '{"timestamp":"2024-01-01T00:00:00Z"}')
    got = ev.rejects(raw(spark, *texts), timed=True).orderBy("arrival").collect()
    assert [r.reason for r in got] == ["malformed json", "no event time", "no event time"]


def test_great_price_is_kept(spark):
    event = ev.cast_with_defaults(raw(spark, '{"user_id":1,"price":1e15,"quantity":2000000000}'))
    assert running.user_running_stats(event).first().total_spent == D("2e24")


def test_both_time_forms_are_read(spark):
    texts = ["2024-01-01T00:00:01.5Z", "2024-01-01 00:00:01.5", "2024-01-01T01:00:01.5+01:00",
             "later", None]
    want = [at(1, 500000)] * 3 + [None, None]
    assert column(spark, texts, "string", parse_iso) == want


def test_iso_text_leaves_zero_fraction_out(spark):
    assert column(spark, [at(1), at(1, 20)], "timestamp", iso_utc) == [
        "2024-01-01T00:00:01Z", "2024-01-01T00:00:01.000020Z"]


def test_window_over_the_small_decimal(spark):
    rows = [("1", D("99999999.99"), 1000, at(0), 0), ("2", D("99999999.99"), 1000, at(1), 1)]
    total = windows.window_totals(spark.createDataFrame(rows, EVENT)).first()
    assert total.total_revenue == D("199999999980.00")


def test_window_counts_users_and_orders(spark):
    rows = [("1", D(1), 1, at(59, 999000), 0), ("1", D(2), 1, at(58), 1),
            (None, D(3), 1, at(57), 2), ("1", None, 1, at(56), 3), ("1", D(4), 1, at(60), 4)]
    got = windows.window_totals(spark.createDataFrame(rows, EVENT)).orderBy("window_start")
    first, second = got.collect()
    assert (first.unique_users, first.total_orders, first.total_revenue,
            first.avg_order_value) == (1, 4, 6, 2)
    assert (second.window_start, second.total_orders) == (at(60), 1)


def test_window_without_prices(spark):
    rows = [("1", None, 1, at(0), 0)]
    only = windows.window_totals(spark.createDataFrame(rows, EVENT)).first()
    assert (only.total_orders, only.total_revenue, only.avg_order_value) == (1, None, None)


def test_first_and_last_by_arrival(spark):
    rows = [("1", D(1), 1, at(10), 0), ("1", D(1), 1, at(5), 1)]
    only = running.user_running_stats(spark.createDataFrame(rows, EVENT)).first()
    assert (only.first_order, only.last_order) == (at(10), at(5))


RESULT = "user_id string, total_spent double, is_vip boolean, window_end string, arrival long"


def test_latest_and_last_on_a_tie(spark):
    rows = [("1", 1.0, False, "b", 0), ("1", 2.0, False, "b", 1), ("1", 3.0, False, "a", 2)]
    results = spark.createDataFrame(rows, RESULT)
    assert serving.latest_per_user(results).first().total_spent == 1.0
    assert serving.last_arrival_per_user(results).first().total_spent == 3.0


def test_missing_fields_of_results(spark):
    rows = [("1", None, None, None, 0), ("2", 20000.0, None, "a", 1), (None, 5.0, True, "a", 2),
            ("", 5.0, True, "a", 3)]
    results = spark.createDataFrame(rows, RESULT)
    assert [r.user_id for r in serving.top_users(results).collect()] == ["2", "1"]
    vips = serving.top_vip_users(results).collect()
    assert [r.user_id for r in vips] == ["2", None, ""]
    counters = serving.result_counters(results, n=2).first()
    assert counters.asDict() == {"messages_processed": 4, "total_users": 4,
                                 "vip_count": 2, "vip_total": 3}


def test_limits(spark):
    results = spark.createDataFrame([("1", 1.0, False, "a", 0)], RESULT)
    assert serving.top_users(results, 0).collect() == []
    with pytest.raises(ValueError):
        serving.top_users(results, -1)


def test_summary_of_nothing(spark):
    items = spark.createDataFrame([], "order_count long, total_revenue double, user_id string")
    assert serving.analytics_summary(items).first().asDict() == {
        "total_orders": 0, "total_revenue": 0, "unique_users": 0, "data_points": 0}


def test_summary_counts_named_users(spark):
    items = spark.createDataFrame([(1, 1.005, "a"), (2, 2.0, ""), (3, None, None), (4, 1.0, "a")],
                                  "order_count long, total_revenue double, user_id string")
    got = serving.analytics_summary(items).first()
    assert (got.total_orders, got.unique_users, got.data_points) == (10, 1, 4)


def test_orders_for_user_compares_text(spark):
    orders = spark.createDataFrame([(1,), (10,)], "user_id long")
    assert insight.orders_for_user(orders, "1").count() == 1
    assert insight.orders_for_user(orders, 10).count() == 1
    assert insight.orders_for_user(orders, "01").count() == 0
    assert insight.orders_for_user(orders, "x").count() == 0
    texts = spark.createDataFrame([("1",), ("01",)], "user_id string")
    assert insight.orders_for_user(texts, 1).count() == 1


def test_validation(spark):
    posts = spark.createDataFrame([(1, "p", False), (0, "p", False), (1, "", False),
                                   (None, "p", False), (1, "p", True)],
                                  "user_id long, product_id string, bad_number boolean")
    errors = [r.error is None for r in ev.validate_order(posts).collect()]
    assert errors == [True, False, False, False, False]
    products = spark.createDataFrame([("n", 0.0), ("n", None), ("", 1.0)],
                                     "name string, price double")
    assert [r.error is None for r in ev.validate_product(products).collect()] == [
        True, False, False]


def test_order_posts_from_json(spark):
    texts = ('{"user_id":1,"product_id":"p","total_price":20,"price":10.5,"quantity":2}',
             '{"user_id":"2","product_id":7,"total_price":20}',
             '{"user_id":3,"product_id":"p"}',
             '{"user_id":4,"product_id":"p","price":null,"total_price":20}',
             '{"user_id":5,"product_id":"p","quantity":"x"}',
             '{"user_id":0,"product_id":"p"}', '{"user_id":6,"product_id":""}', "nope")
    posts = ev.validate_order(ev.parse_order_posts(raw(spark, *texts)))
    assert [r.id for r in ev.refused(posts).orderBy("id").collect()] == [3, 4, 5, 6, 7]
    rows = ev.new_orders(ev.accepted(posts)).orderBy("id").collect()
    assert [(r.user_id, r.product_id, r.quantity, r.total_price) for r in rows] == [
        (1, "p", 2, D("10.50")), (2, "7", 1, 20), (3, "p", 1, 0)]


def test_falsy_products_are_none(spark):
    texts = [f'{{"user_id":1,"product_id":{p}}}' for p in ("0", "0.0", "false", '"0"', "true", "3")]
    posts = ev.validate_order(ev.parse_order_posts(raw(spark, *texts)))
    assert [r.id for r in ev.refused(posts).orderBy("id").collect()] == [0, 1, 2]


def test_duplicate_email(spark):
    new = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id long, email string")
    old = spark.createDataFrame([("b",)], "email string")
    checked = ev.reject_duplicate_email(new, old, "id").orderBy("id").collect()
    assert [r.error is None for r in checked] == [True, False, False]


def test_paths_and_envelope(spark):
    assert column(spark, ["a/uploads/b/uploads/c"], "string", processed_key) == [
        "a/processed/b/processed/c"]
    text = column(spark, ["straße"], "string", lambda c: file_envelope(F.lit("x"), c))[0]
    assert text == ("\n=== PROCESSED FILE ===\nOriginal: x\nSize: 6 bytes\n---\nSTRASSE\n"
                    "=== END ===\n")
    files = spark.createDataFrame([("uploads/t.txt", "hi")], "path string, content string")
    plain = process_files(files, plain=True).first()
    assert (plain.processed_path, plain.processed_content) == ("processed/t.txt", "HI")


def test_long_text_is_kept_whole(spark):
    body = "word " * 60_000
    files = spark.createDataFrame([("uploads/t.txt", body)], "path string, content string")
    assert body.upper() in process_files(files).first().processed_content


def test_great_means_do_not_wrap(spark):
    rows = [(D("4000000000000000000000"), 2), (D("0.05"), 10), (D("-0.05"), 10), (D("1"), 0)]
    df = spark.createDataFrame(rows, "total decimal(38,6), n long")
    got = [r[0] for r in df.select(mo.safe_average(F.col("total"), F.col("n"), 6)).collect()]
    assert got == [D("2000000000000000000000.00"), D("0.01"), D("-0.01"), D("0.00")]
