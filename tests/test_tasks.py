"""All four silver tasks over one landing layout, catch-up mode."""

import os
import tempfile

import pytest

from strata.plans import fixtures, gold, mapping
from strata.sources import files
from strata.streaming.tasks import Layout, read_silver, register_tables, start_silver_tasks

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def test_silver_tasks_then_gold(spark):
    root = tempfile.mkdtemp(prefix="layout-")
    lay = Layout(landing=f"{root}/landing", silver=f"{root}/silver",
                 checkpoints=f"{root}/ckpt")
    files.write_csv(mapping.pos_raw(spark, SF), lay.land("pos"))
    erp = mapping.erp_raw(spark, SF).drop("_shipdate", "_action")   # files carry no action
    erp.write.parquet(lay.land("erp"))
    fixtures.write_json_arrays(mapping.iot_docs(spark, SF), lay.land("iot"), rows_per_file=500)
    inv = mapping.inventory_raw(spark, SF)
    inv.write.parquet(lay.land("inventory"))
    qs = start_silver_tasks(spark, lay, erp.schema, inv.schema, trigger="availableNow")
    for q in qs.values():
        q.awaitTermination()
    t = read_silver(spark, lay)
    n_pos = mapping.pos_raw(spark, SF).select("transaction_id", "transaction_date") \
        .distinct().count()
    assert t["pos"].count() == n_pos
    assert t["iot"].count() > 0 and t["erp"].count() > 0
    assert t["inventory"].count() == inv.count()
    names = gold.register_views(t["pos"], t["erp"], t["iot"])
    assert spark.sql(f"SELECT count(*) FROM {names[2]}").first()[0] > 0
    # existing SQL over the registered table names
    register_tables(spark, lay)
    daily = spark.sql("""
        SELECT transaction_date, store_id, sum(quantity) AS unit_sold,
               count(DISTINCT customer_id) AS unique_customers
        FROM cleaned_pos_transaction GROUP BY transaction_date, store_id""")
    assert daily.count() == gold.daily_sales(t["pos"]).select("transaction_date", "store_id") \
        .distinct().count()
    assert spark.sql("SELECT order_date::date AS d FROM erp_orders").count() == t["erp"].count()


def test_cli_arguments():
    from strata.__main__ import build_parser
    a = build_parser().parse_args(["tasks", "--landing", "L", "--silver", "S",
                                   "--checkpoints", "C", "--trigger", "availableNow",
                                   "--only", "pos,iot"])
    assert (a.command, a.trigger, a.only) == ("tasks", "availableNow", "pos,iot")
    b = build_parser().parse_args(["sql", "--landing", "L", "--silver", "S",
                                   "--checkpoints", "C", "SELECT 1"])
    assert b.statement == "SELECT 1"
