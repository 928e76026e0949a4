"""Helpers shared by the operators: tables in the shared folder, folds, Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from orderpulse.session import fresh_path

#: Rows and bytes that are worked on at once, so that long texts do not pile up in a task.
ROWS_AT_ONCE, BYTES_AT_ONCE = 1024, 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, label: str) -> DataFrame:
    """The rows as a written table in the shared folder: cut lineage, safe from lost executors."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column) -> Column:
    """True for the quarter of ids that no model may learn from; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def may_train(doc_id: Column) -> Column:
    """False for held-out and for null ids."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 != 2, F.lit(False))


def share(doc_id: Column, wanted: Column) -> Column:
    """True for about ``wanted`` (0 to 1) of the ids, always the same ones."""
    return F.pmod(F.xxhash64(F.lit("sample"), doc_id), F.lit(1 << 30)) < wanted * (1 << 30)


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS_AT_ONCE,
           size: int = BYTES_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """Pieces of at most so many rows and, unless one row is longer, so many bytes."""
    for batch in batches:
        at = 0
        step = max(1, min(rows, int(size * batch.num_rows / max(1, batch.nbytes))))
        while at < batch.num_rows:
            part = batch.slice(at, step)
            while part.num_rows > 1 and part.nbytes > 2 * size:
                part = part.slice(0, part.num_rows // 2)
            yield part
            at += part.num_rows


def texts(column: pa.Array) -> list[str]:
    """Texts of a batch; null counts as empty."""
    return [t or "" for t in column.to_pylist()]


def chained(*steps: Callable) -> Callable:
    """One function over Arrow batches that runs several after one another in the same task."""
    def run(batches):
        for step in steps:
            batches = step(batches)
        return batches
    return run
