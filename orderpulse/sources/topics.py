"""Message topics, on a broker or landed as files.

A landed topic is a parquet folder with the columns of ``schemas.TOPIC``. Both
forms give the same DataFrame: ``value``, ``arrival`` and ``timestamp``.
"""

from __future__ import annotations

from datetime import datetime, timezone
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderpulse.functions.jsontext import to_json_result
from orderpulse.operators import events as ev
from orderpulse.schemas import TOPIC
from orderpulse.sources.numbered import NumberedFiles

ORDERS_TOPIC = "orders-events"
RESULTS_TOPIC = "analytics-results"
#: Partitions that a position has room for; rows of a task, as bits, and writes of a landed topic.
PARTITIONS, ROW_BITS, WRITES = 4096, 33, 1 << 18
#: Above all offsets: what lies below this in an arrival is the offset.
OFFSETS = Decimal(10 ** 19)


def kafka_options(servers: str, **options: str) -> dict[str, str]:
    """Connector options; extra ones go by their name with ``_`` for ``.``, such as
    ``kafka_security_protocol='SSL'``."""
    named = {k.replace("_", "."): v for k, v in options.items()}
    return {"kafka.bootstrap.servers": servers, **named}


def arrival(timestamp: Column, partition: Column, offset: Column) -> Column:
    """Order of arrival over all partitions: broker time in milliseconds, partition, offset.

    Offsets of different partitions do not compare, so the time comes first. One number of
    fixed width keeps ``min_by``/``max_by`` on it hash aggregates. All offsets fit, and
    100,000 partitions; more are an error.
    """
    whole = "decimal(38,0)"
    number = (F.unix_millis(timestamp).cast(whole) * F.lit(10 ** 5).cast(whole)
              + partition.cast(whole)) * F.lit(OFFSETS).cast(whole) + offset.cast(whole)
    fits = partition.between(0, 10 ** 5 - 1)
    return F.when(fits, number.cast(whole)).when(
        ~fits, F.raise_error(F.lit("too many partitions for an order of arrival")).cast(whole))


def position(partition: Column, offset: Column) -> Column:
    """A long that no other message of the topic has; one that does not fit is an error."""
    fits = partition.between(0, PARTITIONS - 1) & offset.between(0, (1 << 51) - 1)
    return F.when(fits, F.shiftleft(offset, 12) + partition).when(
        ~fits, F.raise_error(F.lit("partition or offset too large for a position"))
        .cast("bigint"))


def utc(since: datetime) -> datetime:
    """The time as it is, or as UTC if it has no zone."""
    return since if since.tzinfo else since.replace(tzinfo=timezone.utc)


def start_options(start: str, since: datetime | Column | None = None) -> dict[str, str]:
    """Where a broker read starts. With a time as ``since`` the broker seeks to it, so
    that older messages are not read at all; one without a zone is UTC."""
    if isinstance(since, datetime):
        return {"startingTimestamp": str(int(utc(since).timestamp() * 1000)),
                "startingOffsetsByTimestampStrategy": "latest"}
    return {"startingOffsets": start}


def read_topic(spark: SparkSession, topic: str = ORDERS_TOPIC, *, servers: str | None = None,
               path: str | None = None, stream: bool = False, start: str = "latest",
               since: datetime | Column | None = None, max_files: int | None = None,
               positions: bool = False, **options: str) -> DataFrame:
    """Raw messages. ``start`` is ``latest`` or ``earliest`` for a broker; a landed
    topic is read whole. ``since`` keeps the messages that arrived after it, a
    time without a zone is UTC. ``positions`` adds a unique long to each message."""
    if (servers is None) == (path is None):
        raise ValueError("give either servers or path")
    reader = spark.readStream if stream else spark.read
    if servers:
        where = start_options(start, since)
        if not stream and where.get("startingOffsets") == "latest":
            raise ValueError("a bounded read starts at earliest or at a time")
        raw = (reader.format("kafka").options(**kafka_options(servers, **options), **where)
               .option("subscribe", topic).load())
    else:
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        raw = reader.schema(TOPIC).parquet(f"{path}/{topic}")
    if since is not None:
        after = F.lit(utc(since)) if isinstance(since, datetime) else since
        raw = raw.filter(F.col("timestamp") > after)
    number = [position(F.col("partition"), F.col("offset")).alias("position")]
    return raw.select(
        F.col("value").cast("string").alias("value"),
        arrival(F.col("timestamp"), F.col("partition"), F.col("offset")).alias("arrival"),
        "timestamp", *(number if positions else ()))


def messages(rows: DataFrame, offset: Column | None = None, write: int = 0) -> DataFrame:
    """Rows as topic messages; a row keeps its ``value`` or becomes JSON text.

    Without a column for it, the tasks of a write are the partitions and the offset is made of
    the number of the write and that of the row in its task, so that no message of another
    write has the same; ``write_topic`` gives each write a number.
    """
    value = F.col("value") if rows.columns == ["value"] else to_json_result(*rows.columns)
    if offset is None:
        row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << ROW_BITS) - 1))
        return rows.select(
            value.alias("value"), F.spark_partition_id().alias("partition"),
            (row + F.lit(write << ROW_BITS).cast("bigint")).alias("offset"),
            F.current_timestamp().alias("timestamp"))
    return rows.select(value.alias("value"), F.lit(0).alias("partition"),
                       offset.cast("bigint").alias("offset"),
                       F.current_timestamp().alias("timestamp"))


def write_topic(rows: DataFrame, topic: str = RESULTS_TOPIC, *, servers: str | None = None,
                path: str | None = None, mode: str = "append", **options: str) -> None:
    """Append a batch of messages to a topic.

    In a landed topic each write takes the next free number, kept below ``_writes`` where
    readers of the topic don't look, so positions never repeat over appends. Appends to one
    landed topic must come one after another: Spark's file committer does not keep two of them
    in one folder apart.
    """
    if (servers is None) == (path is None):
        raise ValueError("give either servers or path")
    if servers:
        (messages(rows).select("value").write.format("kafka")
         .options(**kafka_options(servers, **options)).option("topic", topic).save())
        return
    number = NumberedFiles(rows.sparkSession, f"{path}/{topic}/_writes").take({})
    if number >= WRITES:
        raise ValueError(f"a landed topic takes {WRITES} writes; fold {path}/{topic} into one")
    messages(rows.coalesce(PARTITIONS), write=number).write.mode(mode).parquet(f"{path}/{topic}")


def read_order_events(spark: SparkSession, topic: str = ORDERS_TOPIC, **where) -> DataFrame:
    """Typed order events; a missing field is null, malformed messages are skipped."""
    return ev.order_events(read_topic(spark, topic, **where))


def read_order_values(spark: SparkSession, topic: str = ORDERS_TOPIC, **where) -> DataFrame:
    """The messages as plain text."""
    return read_topic(spark, topic, **where).select("value")


def read_order_dicts(spark: SparkSession, topic: str = ORDERS_TOPIC, *,
                     missing_user: str | None = "None", null_is_bad: bool = False,
                     **where) -> DataFrame:
    """Events as the running processors read them, with defaults filled in."""
    return ev.cast_with_defaults(read_topic(spark, topic, **where),
                                 missing_user=missing_user, null_is_bad=null_is_bad)
