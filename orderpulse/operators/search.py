"""Search for parts of names by an index of trigrams.

Every place of a name starts a trigram; past its end the name goes on with ``END``. The index has
a row for each trigram and name, sorted by trigram, so a read of one trigram skips the other row
groups; a trigram that very many names hold is spread over files by key. A text of three letters
or more is looked for under its rarest trigram, a shorter one under the trigrams that begin with
it, and what is found there is checked on the name. No other name is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stands behind the end of a name; names do not hold it.
END = "\x00"
SIZE = 3


def postings(products: DataFrame, key: str = "product_id", name: str = "name") -> DataFrame:
    """(gram, key, name) for each distinct trigram of each name, in lower case."""
    low = F.lower(name)
    padded = F.concat(low, F.lit(END * (SIZE - 1)))
    grams = F.transform(F.sequence(F.lit(1), F.length(low)),
                        lambda at: F.substring(padded, at, SIZE))
    return products.filter(F.length(name) > 0).select(
        F.explode(F.array_distinct(grams)).alias("gram"), F.col(key).alias("key"),
        low.alias("name"))


def build_index(products: DataFrame, path: str, key: str = "product_id",
                name: str = "name") -> None:
    """Write the postings and the number of names of each trigram below ``path``."""
    rows = postings(products, key, name)
    (rows.repartitionByRange("gram", "key").sortWithinPartitions("gram", "key")
     .write.parquet(f"{path}/postings"))
    counts = products.sparkSession.read.parquet(f"{path}/postings").groupBy("gram").agg(
        F.count(F.lit(1)).alias("names"))
    counts.repartitionByRange("gram").sortWithinPartitions("gram").write.parquet(f"{path}/grams")


def rarest(spark: SparkSession, path: str, text: str) -> str | None:
    """The trigram of a text that the fewest names hold; None if some trigram is in no name."""
    grams = sorted({text[at:at + SIZE] for at in range(len(text) - SIZE + 1)})
    held = spark.read.parquet(f"{path}/grams").filter(F.col("gram").isin(grams)).collect()
    if len(held) < len(grams):
        return None
    return min(held, key=lambda row: (row.names, row.gram)).gram


def search_index(spark: SparkSession, path: str, text: str) -> DataFrame:
    """(key, name) of the products whose name holds the text, in any case; names in lower case.

    The empty text is in every name.
    """
    low = text.lower()
    rows = spark.read.parquet(f"{path}/postings")
    if len(low) >= SIZE:
        gram = rarest(spark, path, low)
        rows = rows.filter(F.col("gram") == gram) if gram is not None else rows.limit(0)
    else:
        rows = rows.filter(F.col("gram").startswith(low)) if low else rows
    return rows.filter(F.col("name").contains(low)).select("key", "name").distinct()


def search(products: DataFrame, path: str, text: str, key: str = "product_id") -> DataFrame:
    """The rows of the products that the index finds."""
    found = search_index(products.sparkSession, path, text).select(F.col("key").alias(key))
    return products.join(found, key, "left_semi").select(products.columns)
