"""Driver contract: entry() runs, and every query runs on the smallest data."""

import os

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["transaction_date", "store_region", "store_city", "store_id",
                          "store_name", "category", "unit_sold", "total_revenue",
                          "unique_customers"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert set(E._QUERIES) <= set(o)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{SF}/{f}')")
    return con


@pytest.mark.parametrize("name", sorted(E._QUERIES))
def test_query_has_the_rows_of_its_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    n = duck.execute(f"SELECT count(*) FROM ({E.oracle_sql()[name]})").fetchone()[0]
    assert df.count() == n and n > 0


@pytest.mark.parametrize("name, order", [
    ("daily_sales", [("transaction_date", 1)]), ("pos_iot_sensor_data", [("transaction_date", 1), ("store_id", 1)]),
    ("gross_margin", [("total_procurement_cost", -1)]), ("sensor_affect_revenue", [("transaction_date", 1)])])
def test_result_order(spark, name, order):
    rows = [tuple(r[c] for c, _ in order) for r in E.queries()[name](spark, SF).collect()]
    (first, sign), *rest = order
    keys = [r for r in rows if None not in r]
    assert keys == sorted(keys, reverse=sign < 0)
