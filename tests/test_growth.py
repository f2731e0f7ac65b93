"""Steps whose cost a larger input must not multiply."""

import datetime as dt
import tempfile

from pyspark.sql import functions as F

from strata.operators.dedup import latest_in_task, latest_per_key
from strata.plans import mapping, workloads as W
from strata.sources.change_table import ChangeTable

SF = "/root/testdata/sf0.001"


def test_the_current_state_is_folded_by_one_sort(spark):
    rows = spark.createDataFrame([("a", 1, "INSERT"), ("b", 2, "INSERT"), (None, 3, "INSERT")], "k string, v int, _action string")
    gone = spark.createDataFrame([("a", 1, "DELETE"), ("z", 1, "DELETE"), (None, 3, "DELETE")], rows.schema)
    again = spark.createDataFrame([("a", 5, "INSERT"), ("b", 2, "DELETE")], rows.schema)
    schema = rows.drop("_action").schema.add("created_at", "timestamp_ntz").add("updated_at", "timestamp_ntz")
    t = ChangeTable(spark, tempfile.mkdtemp(prefix="table-"), ["k"], schema)
    for day, part in enumerate((rows, gone, gone, again), 1):
        t.merge(part, f"c{day}", now=dt.datetime(2024, 1, day))
    plan = t.read()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 1 and "row_number" not in plan
    day = lambda n: dt.datetime(2024, 1, n)
    assert sorted(map(tuple, t.read().collect()), key=str) == [("a", 5, day(4), day(4)), (None, 3, day(1), day(1))]


def test_a_years_rows_are_read_without_the_others(spark):
    rows = spark.range(60).select("id", F.when(F.col("id") % 4 > 0, 2000 + F.col("id") % 4).cast("int").alias("_y"))
    years, of_year = W._by_year(spark, rows, "growth_years")
    assert years == [None, 2001, 2002, 2003]
    assert sorted(r.id for r in of_year(2002).collect()) == list(range(2, 60, 4))
    assert "PartitionFilters: [isnotnull(_y" in of_year(2002)._jdf.queryExecution().executedPlan().toString()


def test_names_join_the_rows_last(spark):
    plan = mapping.pos_raw(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    on_part, on_store = plan.index("(l_partkey"), plan.index("(l_suppkey")
    assert on_store < on_part            # the plan's top is printed first


def test_a_backlog_of_many_files_is_few_batches(spark, monkeypatch):
    write, seen = W.files.write_csv, []
    monkeypatch.setattr(W.files, "write_csv", lambda df, path: write(df.repartition(40), path))
    real = W.ingest_stream
    monkeypatch.setattr(W, "ingest_stream", lambda *a, **k: seen.append(k) or real(*a, **k))
    n = W.stream_ingest(spark, SF).count()
    assert seen[0] == {"maxFilesPerTrigger": 3} and n == mapping.pos_raw(spark, SF).count()


def test_history_moves_rows_once_and_a_hot_order_reduced(spark):
    plan = W.erp_history(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(order_id#") == 1
    rows = spark.range(0, 60_000, 1, 3).select(
        F.when(F.col("id") % 10 > 0, "hot").alias("k"), (F.col("id") % 2).cast("int").alias("m"), F.col("id").alias("v"))
    rows = rows.unionByName(spark.createDataFrame([("one", None, 1), ("one", None, 2), ("one", 3, 2), (None, None, 0)], rows.schema))
    left = latest_in_task(rows, ["k", "m"], [F.col("v").desc()])
    assert "Exchange" not in left._jdf.queryExecution().executedPlan().toString()
    assert left.count() <= rows.rdd.getNumPartitions() * 4 + 3
    got = latest_per_key(left, ["k", "m"], [F.col("v").desc()])
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, latest_per_key(rows, ["k", "m"], [F.col("v").desc()]).collect()), key=str)


def test_both_states_of_the_change_feed_move_once_by_the_order(spark, tmp_path):
    day = lambda m, d=1, y=1998: dt.datetime(y, m, d)
    lines = [(1, 1, 7, 1, 10.0, "O", "N", day(2)),           # of the warehouse that is gone: DELETE
             (1, 2, 7, 1, 10.0, "F", "N", day(3)),           # late: DELETE and INSERT
             (2, 1, 7, 1, 10.0, "F", "N", day(1, 9)),        # unchanged
             (2, 1, 7, 1, 10.0, "F", "N", day(1, 9)),        # and twice
             (2, None, 7, 1, 10.0, "F", "N", day(1, 9)),     # no key, unchanged
             (2, None, 7, 1, 10.0, "F", "N", day(4)),        # no key, late
             (3, 1, 7, 1, 20.0, "O", "N", day(7)),           # new
             (4, 1, 8, 1, 20.0, "O", "N", day(7))]           # of an unknown part
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, "
                          "l_linestatus string, l_returnflag string, l_shipdate timestamp_ntz") \
        .write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(k, 5, day(1), "P") for k in (1, 2, 3, 4)],
                          "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderstatus string") \
        .write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(7, "T", "B", 2.0)], "p_partkey long, p_type string, p_brand string, p_retailprice double") \
        .write.parquet(f"{tmp_path}/part.parquet")
    got = W.erp_from_change_feed(spark, str(tmp_path))
    plan = got._jdf.queryExecution().executedPlan().toString()
    moved = [x for x in plan.splitlines() if "Exchange hashpartitioning(order_id#" in x]
    assert len(moved) == 3 and all(x.count("#") == 1 and "REPARTITION_BY_COL" in x for x in moved)
    rows = sorted(((r.order_id, r.order_status, str(r.actual_delivery)) for r in got.collect()), key=str)
    assert rows == sorted([("ORD_1_2", "Changed", "1998-03-01"), ("ORD_2_1", "P", "1998-01-09"), ("ORD_3_1", "Changed", "1998-07-01"),
                           (None, "Changed", "1998-04-01"), (None, "P", "1998-04-01")], key=str)
