"""Token totals by source, language and tokenizer version, kept up to date by signed changes.

A change has an image after it, an image before it, or both: an insert adds, a delete takes
away, a revision does both. A batch of changes is summed to one delta for each group, and the
totals are the sum of the deltas of all committed batches. A delta is written first, under a
name of its own; the batch counts from the moment its commit row is written. What a lost driver
or executor leaves half-written has no commit row and is never read, and a batch that comes
again is not counted again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

GROUP = ("source", "lang", "tokenizer")
COMMITS = "batch_id string, attempt string"
DELTAS = "source string, lang string, tokenizer string, n_docs long, n_tokens long, attempt string"


def signed(changes: DataFrame) -> DataFrame:
    """(source, lang, tokenizer, n_docs, n_tokens): one delta for each group of a batch.

    ``changes`` have a struct ``old`` and a struct ``new`` of (source, lang, tokenizer,
    n_tokens); a null struct is no image. Null source and language are groups of their own, a
    null count is zero. Each row is a change; groups that come out even are left out.
    """
    def image(name: str, sign: int):
        return F.when(F.col(name).isNotNull(), F.struct(
            F.lit(sign).alias("sign"), *(F.col(f"{name}.{c}").alias(c)
                                         for c in (*GROUP, "n_tokens"))))

    rows = changes.select(F.explode(F.array_compact(F.array(
        image("new", 1), image("old", -1)))).alias("i")).select("i.*")
    return (rows.groupBy(*GROUP)
            .agg(F.sum("sign").cast("long").alias("n_docs"),
                 F.sum(F.col("sign") * F.coalesce("n_tokens", F.lit(0))).cast("long")
                 .alias("n_tokens"))
            .filter("n_docs != 0 or n_tokens != 0"))


class Rollup:
    """Totals below a folder that all executors share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    @classmethod
    def create(cls, spark: SparkSession, root: str) -> Rollup:
        """An empty rollup in a new folder."""
        made = cls(spark, root)
        spark.createDataFrame([], COMMITS).write.parquet(f"{made.root}/commits")
        spark.createDataFrame([], DELTAS).write.parquet(f"{made.root}/deltas")
        return made

    def commits(self) -> DataFrame:
        """(batch_id, attempt): the first attempt of each committed batch, should two writers
        have committed the same one."""
        return (self.spark.read.schema(COMMITS).parquet(f"{self.root}/commits")
                .groupBy("batch_id").agg(F.min("attempt").alias("attempt")))

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Count a batch once; False if it was counted before."""
        if not self.commits().filter(F.col("batch_id") == batch_id).isEmpty():
            return False
        attempt = uuid.uuid4().hex
        signed(changes).withColumn("attempt", F.lit(attempt)).write.mode("append").parquet(
            f"{self.root}/deltas")
        self.spark.createDataFrame([(batch_id, attempt)], COMMITS).coalesce(1).write.mode(
            "append").parquet(f"{self.root}/commits")
        return True

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, n_docs, n_tokens) of all committed batches; groups without
        documents and tokens are left out."""
        deltas = self.spark.read.schema(DELTAS).parquet(f"{self.root}/deltas")
        return (deltas.join(self.commits().select("attempt"), "attempt", "left_semi")
                .groupBy(*GROUP).agg(F.sum("n_docs").alias("n_docs"),
                                     F.sum("n_tokens").alias("n_tokens"))
                .filter("n_docs != 0 or n_tokens != 0"))

    def compacted(self, root: str) -> Rollup:
        """The same totals and the same memory of batches in a new folder, as one delta."""
        made = Rollup(self.spark, root)
        attempt = uuid.uuid4().hex
        self.totals().withColumn("attempt", F.lit(attempt)).write.parquet(f"{made.root}/deltas")
        self.commits().select("batch_id", F.lit(attempt).alias("attempt")).write.parquet(
            f"{made.root}/commits")
        return made


def inserts(counts: DataFrame) -> DataFrame:
    """Changes that insert rows of (source, lang, tokenizer, n_tokens)."""
    image = F.struct(*GROUP, "n_tokens")
    return counts.select(F.when(F.lit(False), image).alias("old"), image.alias("new"))


def deletes(counts: DataFrame) -> DataFrame:
    """Changes that take away rows of (source, lang, tokenizer, n_tokens)."""
    image = F.struct(*GROUP, "n_tokens")
    return counts.select(image.alias("old"), F.when(F.lit(False), image).alias("new"))


def revisions(counts: DataFrame, new_tokens: str) -> DataFrame:
    """Changes that give rows another count, in the column ``new_tokens``."""
    return counts.select(F.struct(*GROUP, "n_tokens").alias("old"),
                         F.struct(*GROUP, F.col(new_tokens).alias("n_tokens")).alias("new"))
