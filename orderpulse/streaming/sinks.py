"""Streaming sinks.

A table written by ``foreachBatch`` has one folder per batch, ``batch_id=N``, which
a batch replaces as a whole. A batch that runs again after a failure therefore
leaves the table as if it had run once. The numbers come from the checkpoint, so a
table and its checkpoint belong together.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.readwriter import DataStreamWriter

from orderpulse.operators.running import published
from orderpulse.session import fresh_path
from orderpulse.sources.snapshots import Snapshots
from orderpulse.sources.topics import RESULTS_TOPIC, messages, write_topic

PUBLISH_EVERY = "1 minute"  # fixed value: one publish a minute


def _triggered(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    """A micro-batch every ``every``, or all that is there and then stop."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def checkpoint_path(spark: SparkSession, name: str, path: str | None = None) -> str:
    """Where a query keeps offsets and state. A query that shall resume after a
    restart must be given the same path again."""
    return path or fresh_path(spark, f"{name}-checkpoint")


def append_files(df: DataFrame, path: str, *, checkpoint: str | None = None,
                 every: str | None = None, form: str = "parquet",
                 partition_by: tuple[str, ...] = ()) -> StreamingQuery:
    """Append finished rows to files, exactly once; ``partition_by`` names columns, such
    as a date, whose folders later reads can skip."""
    where = checkpoint_path(df.sparkSession, "append", checkpoint)
    writer = (df.writeStream.format(form).outputMode("append")
              .partitionBy(*partition_by).option("checkpointLocation", where))
    return _triggered(writer, every).start(path)


def replace_batch(batch: DataFrame, batch_id: int, path: str) -> None:
    """Write one batch into its own folder; writing it again replaces it."""
    batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def run_batches(df: DataFrame, write: Callable[[DataFrame, int], None], mode: str, *,
                checkpoint: str | None = None, every: str | None = None) -> StreamingQuery:
    """Call ``write`` with every batch and its number."""
    where = checkpoint_path(df.sparkSession, "batches", checkpoint)
    writer = (df.writeStream.outputMode(mode).foreachBatch(write)
              .option("checkpointLocation", where))
    return _triggered(writer, every).start()


def each_batch(df: DataFrame, path: str, mode: str, *,
               shape: Callable[[DataFrame], DataFrame] | None = None,
               checkpoint: str | None = None, every: str | None = None) -> StreamingQuery:
    """Write every batch of ``df`` to its folder below ``path``, after ``shape``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        replace_batch(shape(batch) if shape else batch, batch_id, path)

    return run_batches(df, write, mode, checkpoint=checkpoint, every=every)


def publish_user_stats(stats: DataFrame, path: str, *, mode: str = "update",
                       window_end: Column | None = None, checkpoint: str | None = None,
                       every: str | None = PUBLISH_EVERY) -> StreamingQuery:
    """Publish running statistics, with the time of the publish as ``window_end``.

    ``mode`` is ``complete`` to publish all users each time, or ``update`` for those
    that changed since the last one.
    """
    end = window_end if window_end is not None else F.current_timestamp()
    return each_batch(stats, path, mode, shape=lambda batch: published(batch, end),
                      checkpoint=checkpoint, every=every)


def send(rows: DataFrame, batch_id: int, topic: str, *, path: str | None = None,
         servers: str | None = None, offset: Column | None = None, **options: str) -> None:
    """Write one batch to a topic as JSON text.

    In a landed topic the offset is the batch unless given: a user has one row per
    batch, so that is the order in which the rows of a user arrived. A broker gets
    a batch again if it failed half way; readers that keep the newest row do not
    mind.
    """
    if (servers is None) == (path is None):
        raise ValueError("give either servers or path")
    if servers:
        write_topic(rows, topic, servers=servers, **options)
    else:
        number = F.lit(batch_id) if offset is None else offset
        replace_batch(messages(rows, number), batch_id, f"{path}/{topic}")


def publish(results: DataFrame, topic: str = RESULTS_TOPIC, *, mode: str = "append",
            shape: Callable[[DataFrame], DataFrame] | None = None,
            checkpoint: str | None = None, every: str | None = None,
            **place: str) -> StreamingQuery:
    """Send every batch, after ``shape``, to a topic; ``place`` as for ``send``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        send(shape(batch) if shape else batch, batch_id, topic, **place)

    return run_batches(results, write, mode, checkpoint=checkpoint, every=every)


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """All batches of such a table, with ``batch_id``."""
    return spark.read.option("basePath", path).parquet(path)


def newest_by_key(batches: DataFrame, key: str) -> DataFrame:
    """The table after all upserts: per key the row of the last batch."""
    rank = F.row_number().over(W.partitionBy(key).orderBy(F.desc("batch_id")))
    return (batches.withColumn("_rank", rank).filter("_rank = 1").drop("_rank", "batch_id"))


def upsert_window_items(items: DataFrame, path: str, *, mode: str = "append",
                        checkpoint: str | None = None,
                        every: str | None = None) -> StreamingQuery:
    """Put items by key; of equal keys the last write counts (see ``newest_by_key``).

    A put only adds the rows of its batch; nothing stored before is rewritten.
    """
    return each_batch(items, path, mode, checkpoint=checkpoint, every=every)


def upsert_snapshots(items: DataFrame, table: Snapshots, *, name: str = "items",
                     mode: str = "append", checkpoint: str | None = None,
                     every: str | None = None) -> StreamingQuery:
    """Put items by key into a table that is folded and read while the query runs.

    ``name`` is that of the query for ever: the table remembers the last batch it put
    under it, so a batch that is repeated after a restart is not put again.
    """
    return run_batches(items, lambda batch, batch_id: table.put(batch, name, batch_id), mode,
                       checkpoint=checkpoint, every=every)


def compact(spark: SparkSession, path: str, into: str, key: str) -> None:
    """Write the newest row per key as the first batch of a new table."""
    newest_by_key(read_batches(spark, path), key).write.mode("overwrite").parquet(
        f"{into}/batch_id=0")


class Totals(StreamingQueryListener):
    """Sums over the whole life of the queries started after it was added. A query keeps
    the progress of its last batches only, so they are added up as they come."""

    def __init__(self):
        self.late: dict[str, int] = {}
        self.counts: dict[tuple[str, str], int] = {}
        self.batches: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress, run = event.progress, str(event.progress.runId)
        self.late[run] = self.late.get(run, 0) + sum(
            state.numRowsDroppedByWatermark for state in progress.stateOperators)
        for name, row in progress.observedMetrics.items():
            self.counts[run, name] = self.counts.get((run, name), 0) + row[name]
        self.batches[run] = progress.batchId

    def _wait(self, query: StreamingQuery, seconds: float = 30.0) -> str:
        """Progress is told a little later than it is made."""
        run, last, until = str(query.runId), query.lastProgress, time.monotonic() + seconds
        while last and self.batches.get(run, -1) < last["batchId"]:
            if time.monotonic() > until:
                raise TimeoutError(f"no progress of batch {last['batchId']}")
            time.sleep(0.05)
        return run

    def dropped_late(self, query: StreamingQuery) -> int:
        """Rows dropped behind the watermark since the query was started."""
        return self.late.get(self._wait(query), 0)

    def observed(self, query: StreamingQuery, name: str = "windows") -> int:
        """Sum of an observed count since the query was started."""
        return self.counts.get((self._wait(query), name), 0)


def watch(spark: SparkSession) -> Totals:
    """Add up late rows and observed counts of all queries that start from now on."""
    totals = Totals()
    spark.streams.addListener(totals)
    return totals
