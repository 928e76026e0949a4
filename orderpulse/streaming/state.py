"""The state of the running totals as a table.

A look-up of a user needs no publish: Spark's state store reader gives the rows that the stream
keeps in its checkpoint, as of its last finished batch or an earlier one that is still kept. The
stream may run meanwhile.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderpulse.operators.running import finished

#: The buffers of the aggregates of ``user_running_stats``, in their order.
BUFFERS = ("struct<total_orders:bigint,revenue:decimal(38,6),no_revenue:boolean,"
           "first_order:timestamp,first_arrival:decimal(38,0),"
           "last_order:timestamp,last_arrival:decimal(38,0)>")


def running_totals(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """Running statistics of all users, as ``stream_user_running_stats`` would give them out
    after its last batch, or after ``batch``, from the checkpoint of its query."""
    reader = spark.read.format("statestore")
    if batch is not None:
        reader = reader.option("batchId", batch)
    held = reader.load(checkpoint).select(
        F.col("key.user_id").alias("user_id"), F.col("value").cast(BUFFERS).alias("v"))
    return finished(held.select("user_id", "v.total_orders",
                                F.coalesce("v.revenue", F.lit(0)).cast("decimal(38,6)")
                                .alias("revenue"), "v.first_order", "v.last_order"))


def batches(spark: SparkSession, checkpoint: str) -> tuple[int, int]:
    """The first and the last batch whose state can be read."""
    kept = spark.read.format("state-metadata").load(checkpoint).agg(
        F.max("minBatchId"), F.min("maxBatchId")).first()
    return kept[0], kept[1]
