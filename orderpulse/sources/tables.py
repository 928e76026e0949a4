"""Relational and item tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orderpulse import schemas
from orderpulse.operators import events as ev


def scan(spark: SparkSession, schema: StructType, *, path: str | None = None,
         table: str | None = None, jdbc: dict[str, str] | None = None,
         form: str = "parquet") -> DataFrame:
    """A whole table from files, the catalog or a database.

    Readers prune columns and push filters. A database read is split when ``jdbc``
    names ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions``.
    """
    if path:
        whole = spark.read.schema(schema).format(form).load(path)
    elif table:
        whole = spark.read.table(table)
    else:
        whole = spark.read.format("jdbc").options(**(jdbc or {})).load()
    return whole.select(*schema.names)


def scan_orders(spark: SparkSession, **where) -> DataFrame:
    return scan(spark, schemas.ORDERS, **where)


def scan_users(spark: SparkSession, **where) -> DataFrame:
    return scan(spark, schemas.USERS, **where)


def scan_products(spark: SparkSession, **where) -> DataFrame:
    return scan(spark, schemas.PRODUCTS, **where)


def scan_analytics(spark: SparkSession, **where) -> DataFrame:
    return scan(spark, schemas.ANALYTICS_ITEMS, **where)


def _typed(df: DataFrame, schema: StructType) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def _next_key(spark: SparkSession, schema: StructType, key: str, path: str) -> int:
    """One more than the greatest key stored, 0 for a new table."""
    try:
        stored = scan(spark, schema, path=path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0
    return (stored.agg(F.max(key)).first()[0] or 0) + 1


def _keyed(rows: DataFrame, schema: StructType, key: str, path: str) -> DataFrame:
    """Rows with a key: the given one, else numbers above those stored, with gaps."""
    if key in rows.columns:
        return rows
    first = _next_key(rows.sparkSession, schema, key, path)
    return rows.withColumn(key, F.monotonically_increasing_id() + first)


def _timed(rows: DataFrame) -> DataFrame:
    if "created_at" in rows.columns:
        return rows
    return rows.withColumn("created_at", F.current_timestamp())


def order_rows(posts: DataFrame) -> DataFrame:
    """The order posts that pass the checks, as rows of the orders table."""
    return ev.new_orders(ev.accepted(ev.validate_order(posts)))


def append_orders(posts: DataFrame, path: str) -> None:
    """Store the order posts that pass the checks; key and time come with the post
    (topic position and arrival) or are generated."""
    rows = _timed(_keyed(order_rows(posts), schemas.ORDERS, "id", path))
    _typed(rows, schemas.ORDERS).write.mode("append").parquet(path)


def append_users(posts: DataFrame, existing: DataFrame, path: str, order: str = "id") -> None:
    """Store the new users that pass the checks and whose e-mail is free."""
    valid = ev.accepted(ev.validate_user(posts))
    free = ev.accepted(ev.reject_duplicate_email(valid, existing, order))
    rows = _timed(_keyed(free, schemas.USERS, "id", path))
    _typed(rows, schemas.USERS).write.mode("append").parquet(path)


def append_products(posts: DataFrame, path: str) -> None:
    """Store the product posts that pass the checks, under a random key unless given."""
    rows = ev.status_default(ev.accepted(ev.validate_product(posts)),
                             stock=0, category="general")
    if "product_id" not in rows.columns:
        rows = rows.withColumn("product_id", F.uuid())
    _typed(rows, schemas.PRODUCTS).write.mode("append").parquet(path)
