"""Pipes: skipped files, ledger, pending and empty files; JSON arrays cut into blocks; tasks over a table's feed."""

import datetime as dt
import json
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from strata import schemas as sc
from strata.plans import silver
from strata.sources import loads
from strata.sources.change_table import ChangeTable
from strata.sources.json_arrays import read_json_elements
from strata.sources.raw_table import Feed, RawTable
from strata.streaming.pipes import Pipe, run_task


def put(folder, name, text):
    with open(os.path.join(folder, name), "w" if isinstance(text, str) else "wb") as f:
        f.write(text)


def folder(prefix):
    return tempfile.mkdtemp(prefix=prefix)


def status(pipe):
    return {os.path.basename(r.file): (r.status, r.rows_loaded, r.error_count) for r in pipe.status().collect()}


def test_a_bad_csv_file_is_skipped_and_the_stream_goes_on(spark):
    landing, ckpt = folder("land-"), folder("ckpt-")
    schema = spark.createDataFrame([], "k string, n int").schema
    t = RawTable(spark, folder("raw-"), schema)
    pipe = Pipe(spark, "p", landing, loads.csv_reader(schema), t, ckpt)
    put(landing, "one file%.csv", "k,n\na,1\nb,2\n")
    put(landing, "bad.csv", "k,n\nc,3\nd,four\ne,5\n")
    put(landing, "[3].csv", "k,n\nf,6\n")
    put(landing, "header.csv", "k,n\n")
    put(landing, "empty.csv", "")
    pipe.start("availableNow").awaitTermination()
    assert sorted(map(tuple, t.read().collect())) == [("a", 1), ("b", 2), ("f", 6)]
    want = {"one file%.csv": ("LOADED", 2, 0), "bad.csv": ("LOAD_SKIPPED", 0, 1), "[3].csv": ("LOADED", 1, 0),
            "header.csv": ("LOADED", 0, 0), "empty.csv": ("EMPTY", 0, 0)}
    assert status(pipe) == want
    put(landing, "late.csv", "k,n\ng,7\n")
    assert status(pipe) == {**want, "late.csv": ("PENDING", 0, 0)}
    again = Pipe(spark, "p", landing, loads.csv_reader(schema), t, ckpt)
    again.start("availableNow").awaitTermination()
    assert status(again)["late.csv"] == ("LOADED", 1, 0) and t.read().count() == 4
    again.start("availableNow").awaitTermination()
    assert t.read().count() == 4


def test_damaged_parquet_files(spark):
    landing, src = folder("land-"), folder("src-")
    spark.range(1000).select("id", F.col("id").cast("string").alias("s")).coalesce(1).write.mode("overwrite").parquet(src)
    name = next(x for x in os.listdir(src) if x.endswith(".parquet"))
    data = open(os.path.join(src, name), "rb").read()
    put(landing, "good.parquet", data)
    put(landing, "cut.parquet", data[:len(data) // 2])
    put(landing, "text.parquet", "this is no parquet file")
    spark.createDataFrame([], "id long, s string").coalesce(1).write.mode("overwrite").parquet(src + "/none")
    spark.createDataFrame([(1, "x", 2.5)], "id long, s string, late double").coalesce(1).write.parquet(src + "/wide")
    put(landing, "wide.parquet", open(next(os.path.join(src, "wide", x) for x in os.listdir(src + "/wide") if x.endswith(".parquet")), "rb").read())
    t = RawTable(spark, folder("raw-"), "v variant")
    pipe = Pipe(spark, "p", landing, loads.parquet_reader("v"), t, folder("ckpt-"))
    pipe.start("availableNow").awaitTermination()
    got = status(pipe)
    assert got == {"good.parquet": ("LOADED", 1000, 0), "cut.parquet": ("LOAD_SKIPPED", 0, 1),
                   "text.parquet": ("LOAD_SKIPPED", 0, 1), "wide.parquet": ("LOADED", 1, 0)}
    late = t.read().select(F.variant_get("v", "$.late", "double").alias("d")).where("d is not null")
    assert [r.d for r in late.collect()] == [2.5] and t.read().count() == 1001


def arrays(rng):
    def value(depth):
        kind = rng.randint(0, 5 if depth < 3 else 2)
        if kind == 3:
            return {"k": value(depth + 1), "[,": 1}
        if kind == 4:
            return [value(depth + 1) for _ in range(rng.randint(0, 3))]
        return {0: rng.randint(-5, 5), 1: rng.choice(["", "a,b", "x\"]}{[,\\", "é,語\\\"", "}],["]), 2: None, 5: {"s": "\\"}}[kind]
    return [{"id": i, "v": value(0)} for i in range(rng.randint(0, 60))]


@pytest.fixture
def small_blocks(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda n: spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("block", [64, 333, 5000])
def test_array_elements_across_blocks(spark, small_blocks, block):
    rng = random.Random(block)
    landing, want = folder("json-"), []
    for i in range(6):
        rows = arrays(rng)
        text = json.dumps(rows, ensure_ascii=bool(i % 2), indent=[None, 2, None][i % 3])
        put(landing, f"{i}.json", ("﻿" if i == 4 else "") + text + "\n" * (i % 2))
        want += [json.dumps(r, sort_keys=True) for r in rows]
    put(landing, "none.json", "[ ]")
    put(landing, "long.json", json.dumps([{"id": -1, "v": "x,y" * 2000}, {"id": -2, "v": ["a"] * 900}, 7, "s"]))
    want += [json.dumps(r, sort_keys=True) for r in [{"id": -1, "v": "x,y" * 2000}, {"id": -2, "v": ["a"] * 900}, 7, "s"]]
    for name, text in {"open": '[{"a":1},{"a":', "object": '{"a":1}', "after": "[1] 2", "quote": '["a]'}.items():
        put(landing, f"bad_{name}.json", text)
    small_blocks(block)
    found = read_json_elements(spark, landing).collect()
    assert sorted(json.dumps(json.loads(r.text), sort_keys=True) for r in found if r.text is not None) == sorted(want)
    assert sorted(os.path.basename(r.file) for r in found if r.text is None) == \
        [f"bad_{x}.json" for x in ("after", "object", "open", "quote")]


def test_one_large_array_is_read_by_many_tasks(spark, small_blocks):
    landing = folder("json-")
    put(landing, "all.json", json.dumps([{"id": i, "s": "a,b" * 20} for i in range(20000)]))
    small_blocks(64 << 10)
    out = read_json_elements(spark, landing)
    assert out.rdd.getNumPartitions() > 4
    ids = out.select(F.get_json_object("text", "$.id").cast("int").alias("id"))
    assert ids.agg(F.count("*"), F.count_distinct("id"), F.sum("id")).first()[:] == (20000, 20000, 20000 * 19999 // 2)


def test_json_pipe_skips_files_that_are_no_array(spark):
    landing = folder("land-")
    put(landing, "a.json", '[{"id":1,"late":{"x":[1]}},{"id":2}]')
    put(landing, "b.json", '[{"id":3},{"id":4')
    put(landing, "c.json", '[{"id":5},{id:6}]')
    t = RawTable(spark, folder("raw-"), "row_col variant")
    pipe = Pipe(spark, "p", landing, loads.json_reader(), t, folder("ckpt-"), 1)
    pipe.start("availableNow").awaitTermination()
    assert status(pipe) == {"a.json": ("LOADED", 2, 0), "b.json": ("LOAD_SKIPPED", 0, 1), "c.json": ("LOAD_SKIPPED", 0, 1)}
    assert sorted(r[0] for r in t.read().select(F.to_json("row_col")).collect()) == ['{"id":1,"late":{"x":[1]}}', '{"id":2}']


def test_a_task_applies_each_change_once(spark):
    raw = RawTable(spark, folder("raw-"), "parquet_raw variant")
    orders = ChangeTable(spark, folder("orders-"), sc.ERP_KEYS, sc.ERP_CLEAN)
    feed = Feed(raw, "task")
    prepare = lambda c: silver.dedup_erp(silver.erp_typed(c, "parquet_raw"))
    at = lambda d: dt.datetime(2024, 2, d)
    docs = lambda *rows: spark.createDataFrame([(json.dumps(r),) for r in rows], "j string").select(F.parse_json("j").alias("parquet_raw"))
    order = lambda i, status="new": {"order_id": i, "order_status": status, "order_date": "2024-01-01 00:00:00"}
    raw.append(docs(order("a"), order("b"), order("c")), "load")
    assert run_task(feed, orders, prepare, at(1)) and not run_task(feed, orders, prepare, at(1))
    raw.delete(F.variant_get("parquet_raw", "$.order_id", "string") == "a", "delete")
    raw.update(F.variant_get("parquet_raw", "$.order_id", "string") == "b", {"parquet_raw": F.parse_json(F.lit(json.dumps(order("b", "Changed"))))}, "update")
    # The merge is done, the mark is not: the next run takes the same range and the table knows it.
    with pytest.raises(RuntimeError):
        def down(changes, commit_id):
            orders.merge(prepare(changes), commit_id, now=at(2))
            raise RuntimeError
        feed.consume(down)
    raw.append(docs(order("d")), "more")
    assert run_task(feed, orders, prepare, at(3)) and run_task(feed, orders, prepare, at(4))
    assert {r.order_id: (r.order_status, r.created_at, r.updated_at) for r in orders.read().collect()} == {
        "b": ("Changed", at(1), at(2)), "c": ("new", at(1), at(1)), "d": ("new", at(4), at(4))}
