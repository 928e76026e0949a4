"""The results topic, which carries rows of three shapes."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderpulse.functions.jsontext import kind, scalar_text
from orderpulse.schemas import MONEY, USER_RESULTS
from orderpulse.sources.topics import RESULTS_TOPIC, read_topic

_FIELDS = ("user_id variant, total_orders bigint, total_spent variant, "
           "avg_order_value variant, customer_tier string, is_vip boolean, "
           "first_order string, last_order string, window_end variant")
_BROKEN = "_broken"
_LENIENT = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}


def parse_results(raw: DataFrame, value: str = "value") -> DataFrame:
    """Result messages as rows of one shape.

    A numeric ``window_end``, which per-user window counts carry, cannot be
    compared with the texts of the others; such rows are left out, and so are messages
    that are no JSON object (``rejected_results`` has them).
    """
    row = F.from_json(F.col(value), f"{_FIELDS}, {_BROKEN} string", _LENIENT)
    kept = F.filter(F.array(row), lambda r: r[_BROKEN].isNull())
    parsed = (raw.filter(F.trim(value) != "").select("arrival", F.explode(kept).alias("row"))
              .select("arrival", "row.*"))
    end = F.col("window_end")
    numeric = end.isNotNull() & ~F.is_variant_null(end) \
        & (kind(end) != "STRING")

    def money(name: str) -> Column:
        return F.try_variant_get(F.col(name), "$", MONEY.simpleString()).alias(name)

    text = {"user_id": scalar_text(F.col("user_id")),
            "window_end": F.try_variant_get(end, "$", "string")}
    columns = {c: F.col(c) for c in USER_RESULTS.names}
    columns.update({c: e.alias(c) for c, e in text.items()})
    columns.update({c: money(c) for c in ("total_spent", "avg_order_value")})
    return parsed.filter(~F.coalesce(numeric, F.lit(False))).select(*columns.values())


def rejected_results(raw: DataFrame, value: str = "value") -> DataFrame:
    """The messages of the results topic that are no JSON object."""
    row = F.from_json(F.col(value), f"{_FIELDS}, {_BROKEN} string", _LENIENT)
    return raw.filter(F.coalesce(F.trim(value) == "", F.lit(True)) | row[_BROKEN].isNotNull())


def read_results_bounded(spark: SparkSession, topic: str = RESULTS_TOPIC, **where) -> DataFrame:
    """All results from the earliest on, as a bounded read."""
    return parse_results(read_topic(spark, topic, start="earliest", **where))


def read_results_from_latest(spark: SparkSession, since: datetime | Column,
                             topic: str = RESULTS_TOPIC, **where) -> DataFrame:
    """Only the results that arrived after ``since``."""
    return parse_results(read_topic(spark, topic, start="earliest", since=since, **where))
