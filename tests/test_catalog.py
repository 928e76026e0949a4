"""Every registered query against its SQL, on the small tables."""

import pytest

import __spark_entry__ as entry
from orderpulse.plans.catalog import ORACLES, QUERIES
import oracle

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    sql = ORACLES.get(name)
    assert sql, f"{name} has no SQL"
    assert oracle.compare(QUERIES[name](spark, SF), con, sql) == ""


@pytest.mark.parametrize("name", ["user_results", "latest_per_user", "result_counters",
                                  "top_users_from_topic", "read_results_bounded"])
def test_events_of_any_month_are_published(spark, tmp_path, name):
    con = oracle.duckdb.connect()
    con.execute(f"""COPY (SELECT * REPLACE (ts + INTERVAL 75 DAY * (event_id % 3) AS ts)
        FROM read_parquet('{SF}/events.parquet')) TO '{tmp_path}/events.parquet'""")
    assert oracle.compare(QUERIES[name](spark, str(tmp_path)), oracle.connect(str(tmp_path)),
                          ORACLES[name]) == ""


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["window_start", "window_end", "unique_users", "total_orders",
                          "total_revenue", "avg_order_value"]
    assert df.count() > 0


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
