"""A keyed table that takes upserts from streams and is read from snapshots.

The table is a base, whose files are dealt to buckets by the hash of the key, and the deltas put
since. A manifest names them. Each change writes its files first and then the next manifest,
under a number nobody else can take; who loses the race looks at the winner's manifest and tries
again. A reader takes one manifest and sees that state, whatever happens meanwhile.

``fold`` merges the deltas of one manifest into new files of the buckets they touch and leaves
the other buckets as they are. Deltas put while it works stay open, so it can run beside a
stream. Files are only added: a reader of an older manifest keeps what it reads until ``vacuum``.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orderpulse.sources.numbered import NumberedFiles

BUCKETS = 64
#: Columns that the table adds to stored rows: the bucket of base rows, the delta's number.
BUCKET, NUMBER = "_bucket", "_number"


@dataclass
class Manifest:
    """One state of the table: a folder for each bucket of the base, the open deltas as
    [number, folder], the next number, and the last batch of each stream."""

    version: int = -1
    base: dict[str, str] = field(default_factory=dict)
    deltas: list[list] = field(default_factory=list)
    next: int = 1
    batches: dict[str, int] = field(default_factory=dict)


def _newest(rows: DataFrame, key: str) -> DataFrame:
    """Per key the row with the greatest number. One row per key is kept in each task before
    the shuffle, so a key that is put very often does not reach one task whole."""
    rank = F.row_number().over(W.partitionBy(key).orderBy(F.desc(NUMBER)))
    return rows.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


class Snapshots:
    """The table below ``path``, with one row per ``key``. All handles of a table must be made
    with the same schema, key and number of buckets. Rows without a key are not stored."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, key: str,
                 buckets: int = BUCKETS):
        self.spark, self.path, self.schema, self.key = spark, path.rstrip("/"), schema, key
        self.buckets, self.log = buckets, NumberedFiles(spark, f"{self.path}/manifests")

    def manifest(self, version: int | None = None) -> Manifest:
        """The newest state, or that of a version."""
        if version is None:
            numbers = self.log.numbers()
            if not numbers:
                return Manifest()
            version = numbers[-1]
        return Manifest(version, **self.log.read(version))

    def _change(self, made) -> Manifest | None:
        """Write the next manifest as ``made`` from the newest one, unless that gives None."""
        while True:
            now = self.manifest()
            after = made(now)
            if after is None:
                return None
            content = {k: v for k, v in vars(after).items() if k != "version"}
            if self.log.write(now.version + 1, content):
                after.version = now.version + 1
                return after

    def _bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def put(self, rows: DataFrame, stream: str | None = None, batch: int | None = None) -> bool:
        """Upsert rows; of equal keys in one put one row counts. With ``stream`` and ``batch``
        a batch that was put before is not put again, and False comes back."""
        if stream is not None and batch <= self.manifest().batches.get(stream, -1):
            return False
        folder = f"data/{uuid.uuid4().hex}"
        (rows.select(*self.schema.names).filter(F.col(self.key).isNotNull())
         .write.parquet(f"{self.path}/{folder}"))

        def made(now: Manifest) -> Manifest | None:
            batches = dict(now.batches)
            if stream is not None:
                if batch <= batches.get(stream, -1):
                    return None
                batches[stream] = batch
            return Manifest(base=now.base, deltas=[*now.deltas, [now.next, folder]],
                            next=now.next + 1, batches=batches)

        return self._change(made) is not None

    def _load(self, folders: list[str]) -> DataFrame:
        read = self.spark.read.schema(self.schema)
        return read.parquet(*(f"{self.path}/{f}" for f in folders))

    def _open(self, now: Manifest) -> DataFrame:
        """Rows of the open deltas, with their number."""
        parts = [self._load([f]).withColumn(NUMBER, F.lit(n).cast("long")) for n, f in now.deltas]
        return reduce(DataFrame.unionByName, parts)

    def _merged(self, base: DataFrame | None, deltas: DataFrame | None) -> DataFrame:
        if deltas is None:
            return base if base is not None else self.spark.createDataFrame([], self.schema)
        changed = _newest(deltas, self.key).drop(NUMBER)
        if base is None:
            return changed
        # Few deltas are sent to the base, many meet it by key; Spark sees their size.
        return base.join(changed.select(self.key), self.key, "left_anti").select(
            *self.schema.names).unionByName(changed)

    def read(self, version: int | None = None) -> DataFrame:
        """The whole table as one manifest has it: its base and its open deltas, no more."""
        now = self.manifest(version)
        base = self._load(sorted(now.base.values())) if now.base else None
        return self._merged(base, self._open(now) if now.deltas else None)

    def lookup(self, value, version: int | None = None) -> DataFrame:
        """The row with that key, from one bucket of the base and the open deltas."""
        now = self.manifest(version)
        key = F.lit(value).cast(self.schema[self.key].dataType)
        bucket = self.spark.range(1).select(self._bucket(key)).first()[0]
        folder = now.base.get(str(bucket))
        own = F.col(self.key) == key
        return self._merged(self._load([folder]).filter(own) if folder else None,
                            self._open(now).filter(own) if now.deltas else None)

    def fold(self) -> Manifest:
        """Merge the open deltas into the base. Only buckets they touch are written anew, each
        by tasks of its own; deltas that come meanwhile stay open."""
        now = self.manifest()
        if not now.deltas:
            return now
        changed = _newest(self._open(now), self.key).drop(NUMBER)
        touched = [r[0] for r in changed.select(self._bucket(F.col(self.key))).distinct().collect()]
        old = [now.base[str(b)] for b in touched if str(b) in now.base]
        whole = self._merged(self._load(sorted(old)) if old else None, self._open(now))
        folder = f"data/{uuid.uuid4().hex}"
        (whole.withColumn(BUCKET, self._bucket(F.col(self.key))).repartition(BUCKET)
         .write.partitionBy(BUCKET).parquet(f"{self.path}/{folder}"))
        fresh = {str(b): f"{folder}/{BUCKET}={b}" for b in touched}
        folded = {n for n, _ in now.deltas}

        def made(later: Manifest) -> Manifest:
            if any(later.base.get(b) != now.base.get(b) for b in fresh) or not folded <= {
                    n for n, _ in later.deltas}:
                raise RuntimeError(f"two folds of {self.path} at once; this one gave up")
            return Manifest(base={**later.base, **fresh}, next=later.next, batches=later.batches,
                            deltas=[d for d in later.deltas if d[0] not in folded])

        return self._change(made)

    def vacuum(self, keep: int = 2) -> int:
        """Remove files that none of the newest ``keep`` manifests names, and the manifests
        before them. No write may be running, as its files are named last."""
        numbers = self.log.numbers()
        kept = [self.manifest(n) for n in numbers[-keep:]]
        named = {f.split("/")[1] for m in kept for f in [*m.base.values(), *(d[1] for d in m.deltas)]}
        data, gone = self.log.name(f"{self.path}/data"), 0
        if self.log.fs.exists(data):
            for status in self.log.fs.listStatus(data):
                if status.getPath().getName() not in named:
                    self.log.delete(str(status.getPath().toString()))
                    gone += 1
        for number in numbers[:-keep]:
            self.log.delete(f"{self.log.path}/{number:012d}.json")
        return gone
