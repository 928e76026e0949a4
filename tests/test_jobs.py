"""The jobs end to end on landed topics, and the tables they start from."""

import json

import pytest
from pyspark.sql import functions as F

from orderpulse import session
from orderpulse.plans import jobs
from orderpulse.sources import tables, topics
from orderpulse.streaming import sinks
from test_streams import land


@pytest.fixture
def place(spark, tmp_path):
    def order(i, user, price, second):
        return json.dumps({"order_id": str(i), "user_id": user, "price": price, "quantity": 2,
                           "timestamp": f"2024-01-01T00:{second // 60:02}:{second % 60:02}Z"})

    land(spark, tmp_path, topics.ORDERS_TOPIC,
         order(0, "1", 3000, 1), order(1, "1", 3000.5, 2), order(2, "2", 10, 3), "nope")
    land(spark, tmp_path, topics.ORDERS_TOPIC, order(3, "2", 5, 100))
    return {"path": str(tmp_path)}


def messages(spark, place):
    read = topics.read_topic(spark, topics.RESULTS_TOPIC, **place)
    return [json.loads(r.value) for r in read.collect()]


def test_order_writer_to_running_totals(spark, tmp_path):
    place = {"path": str(tmp_path)}
    land(spark, tmp_path, jobs.POSTS_TOPIC, '{"user_id":1,"product_id":"p","total_price":60}',
         '{"user_id":0,"product_id":"p"}', "nope", '{"user_id":1,"product_id":"p","quantity":3}')
    orders, refused = str(tmp_path / "orders"), str(tmp_path / "refused")
    for _ in range(2):  # with nothing new, the second run changes nothing
        jobs.order_writer_job(spark, place, orders, refused, place,
                              checkpoint=str(tmp_path / "cp"), every=None).awaitTermination()
    stored = tables.scan_orders(spark, path=orders).orderBy("id").collect()
    assert [(r.id, float(r.total_price), r.quantity) for r in stored] == [
        (0, 60.0, 1), (3 * 4096, 0.0, 3)]
    assert spark.read.parquet(refused).count() == 2
    events = topics.read_order_events(spark, **place).orderBy("arrival").collect()
    assert [r.order_id for r in events] == ["0", str(3 * 4096)]
    jobs.running_totals_job(spark, place, place, checkpoint=str(tmp_path / "c2"),
                            every=None).awaitTermination()
    (top,) = jobs.top_users_job(spark, place).collect()
    assert (top.user_id, top.total_orders, float(top.total_spent)) == ("1", 2, 60.0)


def test_generated_keys_do_not_repeat(spark, tmp_path):
    path = str(tmp_path / "orders")
    posts = spark.createDataFrame([(1, "p", 1.0, None)] * 3,
                                  "user_id long, product_id string, price double, "
                                  "total_price double")
    for _ in range(2):
        tables.append_orders(posts, path)
    assert tables.scan_orders(spark, path=path).select("id").distinct().count() == 6


def test_event_time_job(spark, place, tmp_path):
    jobs.event_time_job(spark, place, place, checkpoint=str(tmp_path / "cp"),
                        every=None).awaitTermination()
    (only,) = messages(spark, place)
    assert (only["unique_users"], only["total_orders"], only["total_revenue"],
            only["avg_order_value"]) == (2, 3, 12021.0, 4007.0)


def test_processing_time_job(spark, place, tmp_path):
    jobs.processing_time_job(spark, place, place, checkpoint=str(tmp_path / "cp"),
                             every=None).awaitTermination()
    assert all(isinstance(m["window_end"], int) for m in messages(spark, place))


def test_running_totals_to_top_users(spark, place, tmp_path):
    jobs.running_totals_job(spark, place, place, checkpoint=str(tmp_path / "cp"),
                            every=None).awaitTermination()
    top = jobs.top_users_job(spark, place, 5).collect()
    assert [(r.user_id, r.total_orders, float(r.total_spent), r.is_vip) for r in top] == [
        ("1", 2, 12001.0, True), ("2", 2, 30.0, False)]


def test_notifications_and_rejects(spark, place, tmp_path):
    out, bad = str(tmp_path / "outbox"), str(tmp_path / "rejects")
    jobs.notification_job(spark, place, out, checkpoint=str(tmp_path / "c1"),
                          every=None).awaitTermination()
    jobs.rejects_job(spark, place, bad, checkpoint=str(tmp_path / "c2"),
                     every=None).awaitTermination()
    assert spark.read.parquet(out).count() == 4
    assert [r.value for r in spark.read.parquet(bad).collect()] == ["nope"]


def test_insight_job(spark, tmp_path):
    users, orders, out = (str(tmp_path / n) for n in ("users", "orders", "out"))
    posts = spark.createDataFrame([(1, "a", "a@x"), (2, "b", "a@x"), (3, "", "c@x")],
                                  "id long, name string, email string")
    none = spark.createDataFrame([], "email string")
    tables.append_users(posts, none, users)
    tables.append_orders(spark.createDataFrame(
        [(1, "p", None, 10.0, None), (1, "p", 3, None, 20.0), (0, "p", 1, 1.0, None)],
        "user_id long, product_id string, quantity int, price double, total_price double"),
        orders)
    stored = tables.scan_orders(spark, path=orders)
    assert {(r.quantity, float(r.total_price), r.status) for r in stored.collect()} == {
        (1, 10.0, "pending"), (3, 20.0, "pending")}
    assert stored.select("id").distinct().count() == 2
    jobs.insight_job(spark, users, orders, out)
    (only,) = spark.read.parquet(out).collect()
    assert (only.user_info.email, only.order_analytics.total_orders) == ("a@x", 2)


def test_products_get_a_key(spark, tmp_path):
    path = str(tmp_path / "products")
    tables.append_products(spark.createDataFrame(
        [("n", 1.5, None), ("m", 0.0, "c")], "name string, price double, category string"), path)
    rows = tables.scan_products(spark, path=path).collect()
    assert {(r.name, r.stock, r.category, len(r.product_id)) for r in rows} == {
        ("n", 0, "general", 36), ("m", 0, "c", 36)}


def test_file_job(spark, tmp_path):
    (tmp_path / "in" / "uploads").mkdir(parents=True)
    (tmp_path / "in" / "uploads" / "t.txt").write_text("hi")
    out = str(tmp_path / "out")
    jobs.file_job(spark, str(tmp_path / "in"), out, checkpoint=str(tmp_path / "cp"),
                  every=None).awaitTermination()
    (only,) = spark.read.parquet(out).collect()
    assert only.processed_path == "processed/t.txt" and "\nHI\n" in only.processed_content


def test_parser_knows_the_jobs():
    args = jobs._parser().parse_args(["event-time", "--path", "/x", "--checkpoint", "/c"])
    assert (args.job, args.topic) == ("event-time", topics.ORDERS_TOPIC)
    with pytest.raises(SystemExit):
        jobs._parser().parse_args(["event-time", "--checkpoint", "/c"])


def test_broker_options_reach_source_and_sink():
    args = jobs._parser().parse_args([
        "running-totals", "--servers", "b:9093", "--checkpoint", "/c", "--every", "1 minute",
        "--option", "kafka.security.protocol=SSL", "--option", "kafka.ssl.truststore.location=/t=1",
        "--max-per-trigger", "500", "--start", "earliest", "--on-bad-value", "count_only"])
    source, out = jobs._places(args)
    ssl = {"kafka.security.protocol": "SSL", "kafka.ssl.truststore.location": "/t=1"}
    assert out == {"servers": "b:9093", **ssl}
    assert source == {"topic": topics.ORDERS_TOPIC, "start": "earliest",
                      "maxOffsetsPerTrigger": "500", **out}
    assert ssl.items() <= topics.kafka_options(**out).items()
    for wrong in (["notifications", "--path", "/x", "--checkpoint", "/c"],
                  ["top-users", "--path", "/x", "--option", "nothing"]):
        with pytest.raises(SystemExit):
            jobs._parser().parse_args(wrong)


def test_top_users_from_the_command_line(spark, tmp_path, capfd):
    rows = spark.createDataFrame([("u1", 1, "3.00"), ("u2", 1, "9.00")],
                                 "user_id string, total_orders long, total_spent string")
    topics.write_topic(rows, path=str(tmp_path))
    jobs.main(["top-users", "--path", str(tmp_path), "--limit", "1"])
    shown = capfd.readouterr().out
    assert "u2" in shown and "u1" not in shown


def test_shared_folder(spark, monkeypatch):
    base = session.shared_dir(spark)
    assert session.fresh_path(spark, "x").startswith(base + "/x-")
    monkeypatch.setattr(session, "is_local", lambda _: False)
    monkeypatch.setattr(session, "CHECKPOINT_CONF", "spark.orderpulse.unset")
    with pytest.raises(ValueError):
        session.shared_dir(spark)


def test_published_batches_are_one_folder_each(spark, place, tmp_path):
    jobs.running_totals_job(spark, place, place, checkpoint=str(tmp_path / "cp"), mode="complete",
                            every=None).awaitTermination()
    read = sinks.read_batches(spark, f"{place['path']}/{topics.RESULTS_TOPIC}")
    assert [r.batch_id for r in read.select("batch_id").distinct().collect()] == [0]
    assert read.agg(F.max("offset")).first()[0] == 0


def test_analytics_table_and_its_reads(spark, place, tmp_path):
    out, checkpoint = str(tmp_path / "items"), str(tmp_path / "cp")
    for second in (200, 400, 600):  # each batch closes the windows before it
        land(spark, tmp_path, topics.ORDERS_TOPIC, json.dumps(
            {"order_id": str(second), "user_id": "3", "price": 2, "quantity": 1,
             "timestamp": f"2024-01-01T00:{second // 60:02}:{second % 60:02}Z"}))
        jobs.analytics_job(spark, place, out, checkpoint=checkpoint, fold_after=2,
                           every=None).awaitTermination()
    table = jobs.analytics_table(spark, out)
    assert len(table.manifest().deltas) < 2 and table.manifest().base
    (summary,) = jobs.read_job(spark, "summary", path=out).collect()
    assert (summary.total_orders, float(summary.total_revenue), summary.data_points) == (
        6, 12035.0, 4)
    recent = jobs.read_job(spark, "recent", path=out, limit=2).collect()
    assert [r.window_start for r in recent] == ["2024-01-01T00:06:00", "2024-01-01T00:03:00"]
    (one,) = jobs.read_job(spark, "window", path=out, key=recent[0].window_id).collect()
    assert one.order_count == 1 and jobs.read_job(spark, "window", path=out, key="no").count() == 0


def test_reads_of_the_running_totals(spark, place, tmp_path):
    checkpoint = str(tmp_path / "totals")
    jobs.running_totals_job(spark, place, place, checkpoint=checkpoint, mode="complete",
                            every=None).awaitTermination()
    (user,) = jobs.read_job(spark, "user", checkpoint=checkpoint, key="1").collect()
    assert (user.total_orders, float(user.total_spent), user.is_vip) == (2, 12001.0, True)
    vips = jobs.read_job(spark, "vips", checkpoint=checkpoint).collect()
    assert [(r.user_id, r.rank) for r in vips] == [("1", 1)]


def test_files_to_objects(spark, tmp_path):
    (tmp_path / "uploads").mkdir()
    (tmp_path / "uploads" / "a.txt").write_text("hello")
    out = tmp_path / "out"
    jobs.file_job(spark, str(tmp_path), str(out), checkpoint=str(tmp_path / "cp"), objects=True,
                  every=None).awaitTermination()
    assert "HELLO" in (out / "processed" / "a.txt").read_text()


def test_command_line_of_the_new_jobs():
    parse = jobs._parser().parse_args
    assert parse(["running-totals", "--path", "p", "--checkpoint", "c", "--mode", "complete"]).mode == "complete"
    assert parse(["files", "--root", "r", "--out", "o", "--checkpoint", "c", "--objects", "--every", "1 second"]).objects
    assert parse(["analytics-table", "--path", "p", "--out", "o", "--checkpoint", "c"]).size == "1 minute"
    assert parse(["read", "user", "--checkpoint", "c", "--key", "7"]).key == "7"
