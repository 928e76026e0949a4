"""The jobs, from source to sink.

``python -m orderpulse.plans.jobs <job> --help`` shows the options of each. A job
reads a broker (``--servers``) or a landed topic (``--path``).
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orderpulse.operators import events as ev
from orderpulse.operators import insight, serving, windows
from orderpulse.operators.files import process_files
from orderpulse.operators.running import published
from orderpulse.session import build_session
from orderpulse.schemas import ANALYTICS_ITEMS
from orderpulse.sources import files, results, tables, topics
from orderpulse.sources.snapshots import Snapshots
from orderpulse.streaming import queries, sinks, state


POSTS_TOPIC = "order-posts"


def order_writer_job(spark: SparkSession, source: dict, orders: str, rejected: str, out: dict,
                     *, checkpoint: str, every: str | None = "10 seconds") -> StreamingQuery:
    """Order posts to the orders table and the order events topic; refused posts, with
    the reason, to a side table.

    The events are built from the rows as stored, so table and topic agree, and a
    batch that runs again writes the same rows under the same keys.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        posts = ev.parse_order_posts(batch)
        sinks.replace_batch(tables.order_rows(posts), batch_id, orders)
        sinks.replace_batch(ev.refused(ev.validate_order(posts)), batch_id, rejected)
        stored = spark.read.parquet(f"{orders}/batch_id={batch_id}")
        sinks.send(ev.build_order_event(stored), batch_id, topics.ORDERS_TOPIC,
                   offset=F.col("order_id"), **out)

    posts = topics.read_topic(spark, stream=True, positions=True,
                              **{"topic": POSTS_TOPIC, **source})
    return sinks.run_batches(posts, write, "append", checkpoint=checkpoint, every=every)


def event_time_job(spark: SparkSession, source: dict, out: dict, *, checkpoint: str,
                   size: str = "1 minute", every: str | None = "10 seconds") -> StreamingQuery:
    """Order events to window totals on the results topic, each window once."""
    events = topics.read_order_events(spark, stream=True, **source)
    totals = queries.count_windows(queries.stream_window_totals(events, size))
    return sinks.publish(totals, checkpoint=checkpoint, every=every, **out)


def processing_time_job(spark: SparkSession, source: dict, out: dict, *, checkpoint: str,
                        size: str = "1 minute",
                        every: str | None = "10 seconds") -> StreamingQuery:
    """Messages to counts per user and window of arrival, on the results topic."""
    keyed = ev.parse_user_key(topics.read_topic(spark, stream=True, **source))
    counts = queries.count_windows(queries.stream_user_window_counts(
        keyed, size, heartbeat=every is not None))
    return sinks.publish(counts, shape=queries.user_count_messages,
                         checkpoint=checkpoint, every=every, **out)


def running_totals_job(spark: SparkSession, source: dict, out: dict, *, checkpoint: str,
                       mode: str = "update", on_bad_value: str = "drop",
                       every: str | None = sinks.PUBLISH_EVERY) -> StreamingQuery:
    """Order events to lifetime statistics per user, published once a minute."""
    events = topics.read_order_dicts(spark, stream=True, **source)
    stats = queries.stream_user_running_stats(events, on_bad_value)
    return sinks.publish(stats, mode=mode, checkpoint=checkpoint, every=every,
                         shape=lambda batch: published(batch, F.current_timestamp()), **out)


def notification_job(spark: SparkSession, source: dict, out: str, *, checkpoint: str,
                     every: str | None = "10 seconds") -> StreamingQuery:
    """Order events to an outbox table."""
    events = topics.read_order_events(spark, stream=True, **source)
    return sinks.append_files(queries.notifications(events), out,
                              checkpoint=checkpoint, every=every)


def rejects_job(spark: SparkSession, source: dict, out: str, *, checkpoint: str,
                every: str | None = "10 seconds") -> StreamingQuery:
    """Messages that are no JSON object or have no event time to a side table."""
    raw = topics.read_topic(spark, stream=True, **source)
    return sinks.append_files(ev.rejects(raw, timed=True), out, checkpoint=checkpoint, every=every)


def file_job(spark: SparkSession, root: str, out: str, *, checkpoint: str,
             objects: bool = False, every: str | None = "10 seconds") -> StreamingQuery:
    """New objects below ``uploads/`` to processed rows, or to objects at their own keys."""
    found = files.read_text_files(spark, root, stream=True)
    processed = process_files(found, root.rstrip("/") + "/")
    if not objects:
        return sinks.append_files(processed, out, checkpoint=checkpoint, every=every)
    return sinks.run_batches(
        processed, lambda batch, _: files.write_processed_files(batch, out, objects=True),
        "append", checkpoint=checkpoint, every=every)


def analytics_table(spark: SparkSession, path: str) -> Snapshots:
    """The table of window items, by ``window_id``."""
    return Snapshots(spark, path, ANALYTICS_ITEMS, "window_id")


def analytics_job(spark: SparkSession, source: dict, out: str, *, checkpoint: str,
                  size: str = "1 minute", fold_after: int = 32,
                  every: str | None = "10 seconds") -> StreamingQuery:
    """Order events to the analytics table, an item for each window.

    The open deltas are folded into the base once there are ``fold_after`` of them, so a
    read never meets more.
    """
    table = analytics_table(spark, out)
    events = topics.read_order_events(spark, stream=True, **source)
    items = windows.analytics_items(queries.stream_window_totals(events, size))

    def write(batch: DataFrame, batch_id: int) -> None:
        table.put(batch, "analytics", batch_id)
        if len(table.manifest().deltas) >= fold_after:
            table.fold()

    return sinks.run_batches(items, write, "append", checkpoint=checkpoint, every=every)


#: What can be asked of the analytics table, and the totals behind a checkpoint.
READS = ("summary", "recent", "window", "user", "vips")


def read_job(spark: SparkSession, what: str, *, path: str | None = None,
             checkpoint: str | None = None, key: str | None = None,
             limit: int = 10) -> DataFrame:
    """An answer of the serving side: ``summary``, ``recent`` windows or one ``window`` of the
    analytics table at ``path``; one ``user`` or the ``vips`` from the state of the running
    totals whose query keeps its ``checkpoint``."""
    if what in ("summary", "recent", "window"):
        table = analytics_table(spark, path)
        if what == "window":
            return table.lookup(key)
        items = table.read()
        return serving.analytics_summary(items) if what == "summary" else serving.recent_windows(
            items, limit)
    totals = state.running_totals(spark, checkpoint)
    if what == "user":
        return serving.lookup_by_key(totals, "user_id", key)
    if what == "vips":
        return serving.vip_leaderboard(totals, limit)
    raise ValueError(f"what is one of {', '.join(READS)}")


def insight_job(spark: SparkSession, users: str, orders: str, out: str) -> None:
    """Users and orders to one insight record per user."""
    profile = insight.user_order_profile(tables.scan_users(spark, path=users),
                                         tables.scan_orders(spark, path=orders))
    insight.user_insight(profile).write.mode("overwrite").parquet(out)


def top_users_job(spark: SparkSession, source: dict, limit: int = 10) -> DataFrame:
    """The users who spent most, from the results topic."""
    return serving.top_users(results.read_results_bounded(spark, **source), limit)


def _option(text: str) -> tuple[str, str]:
    name, found, value = text.partition("=")
    if not found:
        raise argparse.ArgumentTypeError(f"{text!r} is not key=value")
    return name, value


def _broker_options(job: argparse.ArgumentParser, topic: str, what: str) -> None:
    where = job.add_mutually_exclusive_group(required=True)
    where.add_argument("--servers", help=f"brokers of {what}")
    where.add_argument("--path", help="folder of landed topics")
    job.add_argument("--topic", default=topic)
    job.add_argument("--option", action="append", default=[], type=_option, metavar="KEY=VALUE",
                     help="connector option of source and sink, such as "
                          "kafka.security.protocol=SSL; may be repeated")


def _places(args: argparse.Namespace) -> tuple[dict, dict]:
    """Where a job reads, with the bound on a batch, and where it writes."""
    place = {"servers": args.servers, **dict(args.option)} if args.servers else {"path": args.path}
    source = {"topic": args.topic, **place}
    if getattr(args, "start", None) and args.servers:
        source["start"] = args.start
    bound = getattr(args, "max_per_trigger", None)
    if bound:
        source |= {"maxOffsetsPerTrigger": str(bound)} if args.servers else {"max_files": bound}
    return source, place


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)
    streams = {name: (topics.ORDERS_TOPIC, "source and results topic") for name in (
        "event-time", "processing-time", "running-totals", "notifications", "rejects",
        "analytics-table")}
    streams["order-writer"] = POSTS_TOPIC, "posts and events topic"
    for name, (topic, what) in streams.items():
        job = jobs.add_parser(name)
        _broker_options(job, topic, what)
        job.add_argument("--start", choices=("latest", "earliest"), default="latest",
                         help="where a broker is read from at first")
        job.add_argument("--max-per-trigger", type=int,
                         help="messages of a broker, or files, in a batch")
        job.add_argument("--every", help="time between batches, such as '10 seconds'")
        job.add_argument("--checkpoint", required=True)
        if name in ("notifications", "rejects", "analytics-table"):
            job.add_argument("--out", required=True, help="folder of the table to write")
        if name in ("event-time", "processing-time", "analytics-table"):
            job.add_argument("--size", default="1 minute", help="length of a window")
        if name == "running-totals":
            job.add_argument("--on-bad-value", choices=("drop", "count_only"), default="drop")
            job.add_argument("--mode", choices=("update", "complete"), default="update",
                             help="publish the users that changed, or all of them")
        if name == "order-writer":
            for option in ("--orders", "--rejected"):
                job.add_argument(option, required=True)
    job = jobs.add_parser("top-users")
    _broker_options(job, topics.RESULTS_TOPIC, "the results topic")
    job.add_argument("--limit", type=int, default=10)
    job = jobs.add_parser("files")
    job.add_argument("--root", required=True)
    job.add_argument("--out", required=True)
    job.add_argument("--checkpoint", required=True)
    job.add_argument("--every", help="time between batches, such as '10 seconds'")
    job.add_argument("--objects", action="store_true",
                     help="put each text at processed/<name> below --out, not into a table")
    job = jobs.add_parser("read")
    job.add_argument("what", choices=READS)
    job.add_argument("--path", help="the analytics table")
    job.add_argument("--checkpoint", help="that of the running totals")
    job.add_argument("--key", help="window or user")
    job.add_argument("--limit", type=int, default=10)
    job = jobs.add_parser("insight")
    for option in ("--users", "--orders", "--out"):
        job.add_argument(option, required=True)
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session(f"orderpulse-{args.job}")
    if args.job == "insight":
        insight_job(spark, args.users, args.orders, args.out)
        return
    if args.job == "files":
        file_job(spark, args.root, args.out, checkpoint=args.checkpoint, objects=args.objects,
                 **({"every": args.every} if args.every else {})).awaitTermination()
        return
    if args.job == "read":
        read_job(spark, args.what, path=args.path, checkpoint=args.checkpoint, key=args.key,
                 limit=args.limit).show(args.limit, truncate=False)
        return
    source, place = _places(args)
    if args.job == "top-users":
        top_users_job(spark, source, args.limit).show(args.limit, truncate=False)
        return
    more = {"checkpoint": args.checkpoint, **({"every": args.every} if args.every else {})}
    if args.job == "order-writer":
        query = order_writer_job(spark, source, args.orders, args.rejected, place, **more)
    elif args.job == "notifications":
        query = notification_job(spark, source, args.out, **more)
    elif args.job == "rejects":
        query = rejects_job(spark, source, args.out, **more)
    elif args.job == "running-totals":
        query = running_totals_job(spark, source, place, on_bad_value=args.on_bad_value,
                                   mode=args.mode, **more)
    elif args.job == "analytics-table":
        query = analytics_job(spark, source, args.out, size=args.size, **more)
    else:
        run = event_time_job if args.job == "event-time" else processing_time_job
        query = run(spark, source, place, size=args.size, **more)
    query.awaitTermination()


if __name__ == "__main__":
    main()
