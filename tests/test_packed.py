"""Rows that move as compressed blocks of columns, and files of a size that grows less than the rows."""

import datetime as dt
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import functions as F

from strata.operators import packed
from strata.operators.dedup import latest_packed, latest_per_key
from strata.plans import catalog, workloads as W
from strata.streaming.latest import STORE

SF = "/root/testdata/sf0.001"


def test_blocks_give_back_every_value():
    t = pa.table({
        "text": pa.array(["x", None, "", "äöü"] * 50), "none": pa.array([None] * 200, pa.string()),
        "money": pa.array([Decimal("1.25"), None, Decimal("-7.00"), Decimal("99999999.99")] * 50, pa.decimal128(12, 2)),
        "flag": pa.array([True, None, False, True] * 50), "n": pa.array([1, None, -3, 4] * 50, pa.int64()),
        "at": pa.array([dt.datetime(2020, 1, 1), None, dt.datetime(1960, 1, 1, 1, 2, 3, 4), dt.datetime(2030, 1, 1)] * 50, pa.timestamp("us")),
        "day": pa.array([dt.date(2020, 1, 1), None] * 100, pa.date32()), "raw": pa.array([b"\0\1", None] * 100)})
    whole = t.slice(3, 150).combine_chunks().to_batches()[0]
    for own in (whole, whole.slice(5, 77), whole.slice(0, 1)):
        back = packed._decoded(packed._encoded(own), own.num_rows, t.schema)
        back.validate(full=True)
        assert back.to_pydict() == own.to_pydict()


def test_a_packed_dedup_keeps_the_same_rows(spark):
    rows = spark.range(0, 30_000, 1, 5).select(
        F.when(F.col("id") % 7 > 0, (F.col("id") % 4000).cast("string")).alias("k"),
        F.when(F.col("id") % 11 > 0, F.date_add(F.lit("2020-01-01"), (F.col("id") % 3).cast("int"))).alias("day"),
        F.when(F.col("id") % 5 > 0, (F.col("id") % 2).cast("string")).alias("time"),
        F.when(F.col("id") % 3 > 0, (F.col("id") % 13).cast("decimal(12,2)")).alias("v"),
        F.when(F.col("id") % 13 > 0, F.concat(F.lit("p"), F.col("id") % 17)).alias("text"))
    rows = rows.unionByName(rows.where("text = 'p3'"))             # some twice
    rows = rows.unionByName(spark.range(5000).select(             # a key that holds many, all different
        F.lit("hot").alias("k"), F.lit(None).cast("date").alias("day"), F.lit("1").alias("time"),
        F.col("id").cast("decimal(12,2)").alias("v"), F.lit("q").alias("text")))
    order = [F.col("time").desc_nulls_first()]
    got = latest_packed(rows, ["k", "day"], order, least=0)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 3 and "row_number" not in plan
    assert plan.count("Exchange") == 1 and "_block#" in plan
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, latest_per_key(rows, ["k", "day"], order).collect()), key=str)


def test_small_inputs_and_other_types_are_not_packed(spark):
    rows = spark.range(3).selectExpr("cast(id as string) AS k", "cast(id as double) AS v")
    plain = lambda df, keys, **k: "_block#" not in latest_packed(df, keys, [F.col("k").asc()], **k)._jdf.queryExecution().executedPlan().toString()
    assert plain(rows, ["k"], least=1 << 62) and not plain(rows, ["k"], least=0)
    assert plain(rows, ["v"], least=0)                            # -0.0 equals 0.0 but not its bytes
    assert plain(rows.select("k", F.parse_json(F.lit("1")).alias("v")), ["k"], least=0)
    assert packed.input_bytes(spark.read.parquet(f"{SF}/orders.parquet").groupBy("o_custkey").count()) > 1000


def test_the_silver_tables_of_large_inputs_move_packed(spark, monkeypatch):
    from strata.operators import dedup
    for make in (catalog.silver_pos, catalog.silver_erp, catalog.silver_iot):
        plain = sorted(map(str, make(spark, SF).collect()))
        monkeypatch.setattr(dedup, "PACK_BYTES", 0)
        own = make(spark, SF)
        assert "_block#" in own._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(str, own.collect())) == plain
        monkeypatch.undo()


def test_stored_history_is_a_parquet_table(spark):
    history = W.stored_history(spark, SF)
    assert history.inputFiles() and all(f.endswith(".parquet") for f in history.inputFiles())
    assert sorted(map(str, history.collect())) == sorted(map(str, W.erp_history(spark, SF).collect()))


def _landed(monkeypatch, query, spark):
    real, seen = W.scratch_path, []
    monkeypatch.setattr(W, "scratch_path", lambda *a: seen.append(real(*a)) or seen[-1])
    n = query(spark, SF).count()
    landing = next(p for p in seen if "landing" in p or "pos_years-" in p)
    names = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(landing).inputFiles()
    return n, names


def test_landed_pos_files_are_compressed(spark, monkeypatch):
    for query in (W.stream_ingest, W.stream_latest, W.stream_merge):
        n, names = _landed(monkeypatch, query, spark)
        assert n and names and all(x.endswith(".csv.gz") for x in names)
        monkeypatch.undo()
    assert STORE["spark.sql.streaming.stateStore.rocksdb.compression"] == "zstd"


def test_the_pipes_files_move_packed(spark, monkeypatch):
    seen = []
    real = W.repacked
    monkeypatch.setattr(W, "repacked", lambda df, keys: seen.append(keys) or real(df, keys))
    assert W.pipe_status(spark, SF).count() and seen == [["ship_year"]] * 2
