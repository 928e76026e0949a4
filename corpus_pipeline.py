"""A corpus made ready for training: filter, de-duplicate, decontaminate, redact, tokenize.

Each stage takes the documents that the one before kept and is written before the next reads
it. The stages use models and groups, which SQL can't express, so there is no ORACLE_SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderpulse.llm import bpe, decontaminate, pii, simhash, toxicity
from orderpulse.llm.common import saved, table
from orderpulse.llm.queries import PATTERN, RANKS


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator does not reject."""
    return toxicity.kept(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each SimHash group."""
    return simhash.first_of_each(docs, simhash.near_duplicates(docs, shingle=3, bits=3))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with marks in place of personal data."""
    return pii.redact(docs, pii.find(docs))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the bytes decoded from them."""
    return bpe.round_trip(docs, RANKS, PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("personal data", redact_personal_data),
    ("byte-level bpe", tokenize),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
