"""Registration of queries, and the SQL parts their checks share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderpulse.session import use_defaults

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, and the SQL that must give the same rows."""
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(fn(use_defaults(spark), sf_dir.rstrip("/")))

        run.__name__ = name
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return fn
    return add


def plain(df: DataFrame) -> DataFrame:
    """Types that compare across engines: doubles for decimals, timestamps without
    zone, long for every whole number, joined text for lists."""
    columns = []
    for field in df.schema:
        column, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, T.DecimalType):
            column = column.cast("double")
        elif isinstance(kind, T.TimestampType):
            column = column.cast("timestamp_ntz")
        elif isinstance(kind, T.IntegerType):
            column = column.cast("bigint")
        elif isinstance(kind, T.ArrayType):
            column = F.array_join(column, "|")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def as_double(df: DataFrame, column: str) -> DataFrame:
    """A whole-number column with gaps as double, which has one form in every client."""
    return df.withColumn(column, F.col(column).cast("double"))


# --- SQL parts -----------------------------------------------------------------

EV = """ev AS (
  SELECT CAST(event_id AS VARCHAR) AS order_id, CAST(user_id AS VARCHAR) AS user_id,
         'prod-' || CAST(event_id % 100 AS VARCHAR) AS product_id,
         CAST(event_id % 5 + 1 AS BIGINT) AS quantity,
         CAST(round(value * 100) AS BIGINT) AS price_cents,
         CAST(round(value * 100) AS BIGINT) * (event_id % 5 + 1) AS cents,
         ts, event_id AS arrival, event_type
  FROM events)"""

ORD = """ord AS (
  SELECT o_orderkey AS id, o_custkey AS user_id,
         'prod-' || CAST(o_orderkey % 100 AS VARCHAR) AS product_id,
         CAST(o_orderkey % 5 + 1 AS BIGINT) AS quantity,
         CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
         CASE o_orderstatus WHEN 'P' THEN 'pending' WHEN 'O' THEN 'processing'
              ELSE 'delivered' END AS status,
         o_orderdate AS created_at
  FROM orders)"""


def money(cents: str) -> str:
    return f"CAST({cents} AS DOUBLE) / 100"


def mean_money(cents: str, n: str) -> str:
    """Half-up mean of non-negative cents, on whole numbers."""
    return f"CAST((2 * ({cents}) + ({n})) // (2 * ({n})) AS DOUBLE) / 100"


def tier(cents: str) -> str:
    return (f"CASE WHEN {cents} > 1000000 THEN 'VIP' WHEN {cents} > 500000 "
            "THEN 'Premium' ELSE 'Regular' END")


def iso(ts: str, suffix: str = "Z") -> str:
    """ISO text of a timestamp, without a zero fraction."""
    return (f"CASE WHEN epoch_us({ts}) % 1000000 = 0 "
            f"THEN strftime({ts}, '%Y-%m-%dT%H:%M:%S{suffix}') "
            f"ELSE strftime({ts}, '%Y-%m-%dT%H:%M:%S.%f{suffix}') END")


def window_sql(minutes: int, source: str = "ev") -> str:
    """Totals of tumbling windows over ``source``."""
    start = f"time_bucket(INTERVAL {minutes} MINUTE, ts)"
    return f"""
  SELECT {start} AS window_start, {start} + INTERVAL {minutes} MINUTE AS window_end,
         count(DISTINCT user_id) AS unique_users, count(*) AS total_orders,
         {money('sum(cents)')} AS total_revenue,
         {mean_money('sum(cents)', 'count(*)')} AS avg_order_value
  FROM {source} GROUP BY 1, 2"""


ITEMS = f"""items AS (
  SELECT 'window-' || CAST(CAST(epoch(window_start) AS BIGINT) AS VARCHAR) AS window_id,
         strftime(window_end, '%Y-%m-%dT%H:%M:%S') AS "timestamp",
         total_orders AS order_count, total_revenue, unique_users,
         CAST(NULL AS VARCHAR) AS user_id,
         strftime(window_start, '%Y-%m-%dT%H:%M:%S') AS window_start,
         strftime(window_end, '%Y-%m-%dT%H:%M:%S') AS window_end
  FROM ({window_sql(1)}))"""

STATS_COLUMNS = f"""user_id, count(*) AS total_orders,
         {money('sum(cents)')} AS total_spent,
         {mean_money('sum(cents)', 'count(*)')} AS avg_order_value,
         {tier('sum(cents)')} AS customer_tier, sum(cents) > 1000000 AS is_vip"""

RESULTS = f"""results AS (
  SELECT {STATS_COLUMNS},
         {iso('arg_min(ts, ev.arrival)')} AS first_order,
         {iso('arg_max(ts, ev.arrival)')} AS last_order,
         strftime(cut, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS window_end,
         CAST(epoch(cut) AS BIGINT) * 1000000 + CAST(user_id AS BIGINT) AS arrival
  FROM ev JOIN (VALUES (TIMESTAMP '2024-01-10 00:00:00'), (TIMESTAMP '2024-01-20 00:00:00'),
                       ((SELECT date_trunc('month', max(ts)) + INTERVAL 1 MONTH FROM events))
                      ) AS p(cut) ON ts < cut
  GROUP BY cut, user_id)"""

FILES = """files AS (
  SELECT 'uploads/' || CAST(doc_id AS VARCHAR) || '.txt' AS path, text AS content
  FROM documents)"""


def _pick(number: str, *names: str) -> str:
    listed = ", ".join(f"'{n}'" for n in names)
    return f"[{listed}][CAST({number} % {len(names)} + 1 AS INTEGER)]"


SAMPLES = f"""samples AS (
  SELECT event_type AS metric, 'default' AS namespace,
         {_pick('user_id', 'order', 'user', 'worker', 'product', 'gateway')}
           || '-service-' || CAST(user_id % 5 AS VARCHAR) AS pod,
         {_pick('user_id', 'app', 'app', 'proxy', '', 'POD', 'app', 'app')} AS container,
         {_pick('user_id', 'Running', 'Failed', 'Pending')} AS phase,
         {_pick('user_id', 'cpu', 'memory')} AS resource,
         CAST(user_id AS VARCHAR) AS instance, ts, value
  FROM events)"""

REQUESTS = """requests AS (
  SELECT ts, event_type AS endpoint,
         CASE event_type WHEN 'signup' THEN 'user created' WHEN 'purchase' THEN 'order created'
              WHEN 'view' THEN 'get products success' WHEN 'click' THEN 'get users success'
              ELSE 'product created' END AS "check",
         CASE WHEN event_type = 'error' THEN 500
              WHEN event_type = 'signup' AND event_id % 3 = 0 THEN 409
              WHEN event_type IN ('signup', 'purchase') THEN 201 ELSE 200 END AS status,
         value AS duration_ms, event_type = 'error' AS failed
  FROM events)"""


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"
