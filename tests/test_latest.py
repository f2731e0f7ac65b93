"""Streaming top-1 in the state store against dedup and merge, file after file."""

import os
import random
import tempfile

from pyspark.sql import functions as F

from strata.operators.dedup import latest_per_key
from strata.operators.merge import merge
from strata.functions.expr import order_desc
from strata.streaming.ingest import change_stream
from strata.streaming.latest import ARRIVED, arriving, descending, keep_latest, latest, read_latest

SCHEMA = "k string, d date, t string, n int, s string"
KEYS, ORDER = ["k", "d"], ["t"]


def batch(spark, rng, n):
    rows = [(rng.choice(["a", "b", "c", None]), rng.choice(["2024-01-01", "2024-01-02"]), rng.choice(["09:00", "10:00", None]),
             rng.choice([1, 2, None]), rng.choice(["", "x", "xy", "é", None])) for _ in range(n)]
    return spark.createDataFrame(rows, "k string, d string, t string, n int, s string").withColumn("d", F.col("d").cast("date"))


def content(df):
    return sorted((tuple(r) for r in df.select("k", "d", "t", "n", "s").collect()), key=str)


def test_files_one_by_one_equal_the_merge(spark):
    rng = random.Random(3)
    landing, ckpt = tempfile.mkdtemp(prefix="land-"), tempfile.mkdtemp(prefix="ckpt-")
    merged = None
    for step in range(4):
        rows = batch(spark, rng, 25).checkpoint()
        rows.coalesce(1).write.mode("append").parquet(landing)
        stream = arriving(change_stream(spark, landing, "parquet", rows.schema))
        query = keep_latest(stream, KEYS, ORDER, ckpt, "latest")      # started again on its checkpoint each time
        query.awaitTermination()
        assert query.lastProgress["numInputRows"] == 25
        merged = merge(merged, latest_per_key(rows, KEYS, [order_desc("t")]), KEYS, columns=rows.columns).checkpoint()
        assert content(read_latest(spark, ckpt, KEYS)) == content(merged)
    table = read_latest(spark, ckpt, KEYS)
    times = table.where("k = 'a'").first()
    assert times.created_at <= times.updated_at and table.columns == ["k", "d", "t", "n", "s", "created_at", "updated_at"]


def test_mirrored_order(spark):
    values = ["", "a", "ab", "b", "é", "語", "z", "😀"]
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [r.s for r in df.orderBy(descending("s", df.schema["s"].dataType).desc()).collect()]
    assert got == sorted(values, key=str.encode)


def test_one_exchange_on_a_batch(spark):
    df = spark.range(100).select((F.col("id") % 7).cast("string").alias("k"), F.current_timestamp().alias(ARRIVED), "id")
    plan = latest(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("partial_max") >= 1
    assert {r.top.row.id for r in latest(df, ["k"], ["id"]).collect()} == set(range(93, 100))


def test_state_holds_a_row_once_and_on_disk(spark):
    landing, ckpt = tempfile.mkdtemp(prefix="land-"), tempfile.mkdtemp(prefix="ckpt-")
    rows = spark.createDataFrame([("a", "2024-01-01", "09:00", 1, "payload" * 100)], "k string, d string, t string, n int, s string") \
        .withColumn("d", F.col("d").cast("date"))
    rows.write.mode("append").parquet(landing)
    keep_latest(arriving(change_stream(spark, landing, "parquet", rows.schema)), KEYS, ORDER, ckpt, "once").awaitTermination()
    value = spark.read.format("statestore").load(ckpt).select(F.to_json("value").alias("v")).first().v
    assert value.count("payload") == 100 and len(value) < 1000
    with open(f"{ckpt}/offsets/0") as f:
        assert "RocksDBStateStoreProvider" in f.read()
    assert content(read_latest(spark, ckpt, KEYS)) == content(rows)
