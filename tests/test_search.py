"""Search by trigrams equals a scan, whatever the text; state as a table."""

import random

from pyspark.sql import functions as F

from orderpulse.operators import running, search
from orderpulse.operators.orders import product_search
from orderpulse.session import use_defaults
from orderpulse.sources import fixtures as fx
from orderpulse.streaming import queries, sinks, state

PRODUCTS = "product_id string, name string, stock long"
SF = "/root/testdata/sf0.001"


def test_index_equals_scan(spark, tmp_path):
    rng = random.Random(3)
    names = ["".join(rng.choice("abC é.%") for _ in range(rng.randrange(9))) for _ in range(300)]
    names += [None, "", "a", "ab", "aaaaaaaa", "Éa\U0001f600b", "100% wool", "a_b"] + ["Hot Widget"] * 200
    products = spark.createDataFrame([(str(i), n, i) for i, n in enumerate(names)], PRODUCTS)
    search.build_index(products, str(tmp_path))
    for text in ["a", "AB", "abc", "b c", "%", "é", "ÉA", "\U0001f600", "widget", "hot w", "aaa", "a_b",
                 "aaaaaaaaa", "zzz", "wool", ". a", "ca%"]:
        want = {r.product_id for r in product_search(products, text).collect()}
        assert {r.product_id for r in search.search(products, str(tmp_path), text).collect()} == want, text
    named = {r.key for r in search.search_index(spark, str(tmp_path), "").collect()}
    assert named == {str(i) for i, n in enumerate(names) if n}


def test_rarest_trigram_decides(spark, tmp_path):
    rows = [(str(i), "common thing", 0) for i in range(50)] + [("x", "common xylophone", 0)]
    search.build_index(spark.createDataFrame(rows, PRODUCTS), str(tmp_path))
    low = "common xyl"
    gram = search.rarest(spark, str(tmp_path), low)
    assert gram not in "common thing" and search.rarest(spark, str(tmp_path), "qqq") is None
    plan = search.search_index(spark, str(tmp_path), low)._jdf.queryExecution().toString()
    assert f"EqualTo(gram,{gram})" in plan


def test_state_of_running_totals(spark, tmp_path):
    use_defaults(spark)
    events, landed, checkpoint = fx.order_events(spark, SF), str(tmp_path / "in"), str(tmp_path / "cp")
    for k in range(2):
        events.filter(F.col("arrival") % 2 == k).write.mode("append").parquet(landed)
        stream = spark.readStream.schema(events.schema).parquet(landed)
        sinks.publish_user_stats(queries.stream_user_running_stats(stream), str(tmp_path / "out"),
                                 checkpoint=checkpoint, every=None).awaitTermination()
    first, last = state.batches(spark, checkpoint)
    assert (first, last) == (0, 1)
    for batch, part in ((0, events.filter("arrival % 2 = 0")), (None, events)):
        got = state.running_totals(spark, checkpoint, batch)
        assert sorted(got.collect()) == sorted(running.user_running_stats(part).collect())
    assert state.running_totals(spark, checkpoint).filter("user_id = '1'").count() == 1
