"""Operator-level workloads over the test inputs (the non-gold ``queries()``).

Each function takes ``(spark, sf_dir)``, derives its input from the test
tables with Spark and returns a DataFrame.  Workloads that exercise sources
or streams write their input files below the shared checkpoint folder first
(``strata.session.scratch_path``) and read them back.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import schemas as sc
from strata.functions.expr import normalise_time, order_desc, shift
from strata.functions.paths import vget, vitems
from strata.functions.variant import with_field
from strata.operators import history as hist
from strata.operators.changes import change_feed as _change_feed
from strata.operators.dedup import latest_in_task, latest_per_key
from strata.operators.flatten import unnest
from strata.operators.merge import update_where as _update_where
from strata.operators.packed import repacked
from strata.plans import catalog, fixtures, mapping, silver
from strata.session import scratch_path, settings
from strata.sources import files, loads
from strata.sources.audit import ingest_audit as _ingest_audit
from strata.sources.change_table import ChangeTable
from strata.sources.raw_table import Feed, RawTable
from strata.streaming.cdc import cdc_into
from strata.streaming.ingest import change_stream, ingest_stream
from strata.streaming.latest import ARRIVED, keep_latest, read_latest
from strata.streaming.pipes import Pipe, run_task

# Fixed parameters of the update and history workloads.
UPDATED_ORDER = "ORD_2_6"
AS_OF_TS = "1998-01-01 00:00:00"
OFFSET_NOW = "1998-01-01 01:00:00"
OFFSET_SECONDS = 3600
RESTORE_COMMIT = "C199801"
RESTORE_ID = "R1"
EXPIRE_DAYS = 14
EXPIRE_NOW = "1998-01-10 00:00:00"


# ---------------------------------------------------------------- semi-structured
def variant_extract(spark: SparkSession, d: str) -> DataFrame:
    """``props:k::INT`` etc. on the JSON text of every event."""
    ev = mapping.table(spark, d, "events").select("event_id", F.parse_json("props").alias("v"))
    return ev.select("event_id",
                     vget("v", "k", "int").alias("k_int"),
                     vget("v", "k", "number(10,2)").alias("k_number"),
                     vget("v", "k", "varchar").alias("k_text"),
                     vget("v", "missing", "varchar").alias("missing"))


def nested_path(spark: SparkSession, d: str) -> DataFrame:
    """Top-level and nested ``metadata.*`` paths of every sensor document."""
    return silver.iot_events(mapping.iot_raw(spark, d)).drop("_readings", "_alerts")


def flatten_inner(spark: SparkSession, d: str) -> DataFrame:
    """One row per reading; documents without readings vanish."""
    ev = silver.iot_events(mapping.iot_raw(spark, d))
    r = unnest(ev, "_readings", "_r", position="reading_pos")
    return r.select("event_id", "reading_pos",
                    vget("_r", "sensor", "varchar").alias("sensor_name"),
                    vget("_r", "value", "number(10,2)").alias("sensor_value"),
                    vget("_r", "unit", "varchar").alias("sensor_unit"))


def flatten_outer(spark: SparkSession, d: str) -> DataFrame:
    """One row per alert, one NULL row for missing / null / empty alerts."""
    ev = silver.iot_events(mapping.iot_raw(spark, d))
    a = unnest(ev, "_alerts", "_a", outer=True, position="alert_pos")
    return a.select("event_id", "alert_pos",
                    vget("_a", "alert_type", "varchar").alias("alert_type"),
                    vget("_a", "severity", "varchar").alias("severity"),
                    vget("_a", "triggered_at", "timestamp").alias("triggered_at"))


def flatten_both(spark: SparkSession, d: str) -> DataFrame:
    """Readings x alerts with every typed field, before dedup."""
    return silver.iot_flatten(mapping.iot_raw(spark, d)).withColumnRenamed("_apos", "alert_pos")


def flatten_missing(spark: SparkSession, d: str) -> DataFrame:
    """Documents of which some have no readings (missing, null or an empty list) and so vanish from the inner unnest, while
    the outer one keeps them with NULLs (C5, C6)."""
    ev = mapping.table(spark, d, "events")
    readings = F.when(F.col("event_type") == "signup", F.lit("null")).when(F.col("event_type") == "view", F.lit("[]")) \
        .otherwise(F.concat(F.lit('[{"sensor":"'), "event_type", F.lit('"},{"sensor":"k"}]')))
    text = F.when(F.col("event_type") == "error", F.concat(F.lit('{"id":'), "event_id", F.lit("}"))) \
        .otherwise(F.concat(F.lit('{"id":'), "event_id", F.lit(',"readings":'), readings, F.lit("}")))
    docs = ev.select(F.parse_json(text).alias("v")).select(vget("v", "id", "bigint").alias("event_id"), vitems("v", "readings").alias("_readings"))
    inner = unnest(docs, "_readings", "_r", position="pos").select(F.lit("inner").alias("kind"), "event_id", "pos", "_r")
    outer = unnest(docs, "_readings", "_r", outer=True, position="pos").select(F.lit("outer").alias("kind"), "event_id", "pos", "_r")
    return inner.unionByName(outer).select("kind", "event_id", "pos", vget("_r", "sensor").alias("sensor"))


def date_shift(spark: SparkSession, d: str) -> DataFrame:
    """``dateadd`` by hours, days, months and years, over month ends (H5)."""
    o = mapping.table(spark, d, "orders")
    at = F.col("o_orderdate").cast("timestamp_ntz")
    by = [("hour", -1), ("minute", 90), ("day", 45), ("month", 1), ("month", -13), ("year", 4)]
    return o.select("o_orderkey", *[shift(at, n, unit).alias(f"{unit}_{n}".replace("-", "minus_")) for unit, n in by])


def inventory_extract(spark: SparkSession, d: str) -> DataFrame:
    """Typed inventory snapshot rows."""
    return silver.inventory(mapping.inventory_raw(spark, d))


# ---------------------------------------------------------------- changes / DML
def _order_states(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    o = mapping.table(spark, d, "orders")
    before = o.filter(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz"))
    after = (o.filter(F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz"))
              .withColumn("o_orderstatus",
                          F.when(F.col("o_orderpriority") == "1-URGENT", "Changed")
                           .otherwise(F.col("o_orderstatus"))))
    return before, after


def change_feed(spark: SparkSession, d: str) -> DataFrame:
    """Net INSERT/DELETE rows between two states of ``orders``."""
    before, after = _order_states(spark, d)
    return _change_feed(before, after)


def update_where(spark: SparkSession, d: str) -> DataFrame:
    """``UPDATE erp_orders SET order_status = 'Changed' WHERE order_id = '...'``."""
    erp = catalog.silver_erp(spark, d)
    return _update_where(erp, F.col("order_id") == UPDATED_ORDER, {"order_status": "Changed"})


def update_and_restore(spark: SparkSession, d: str) -> DataFrame:
    """The recovery demonstration on a stored table: load, UPDATE as a commit, read the state before
    it, restore, and report the order's row at each step (I5, B8, K3, K4, A13)."""
    table = ChangeTable(spark, scratch_path(spark, "erp_recovery"), sc.ERP_KEYS, sc.ERP_CLEAN)
    typed = silver.dedup_erp(silver.erp_typed(mapping.erp_raw(spark, d)))
    at = lambda day: dt.datetime(2024, 2, day)
    table.merge(typed, "load", now=at(1), once=True)
    table.update(F.col("order_id") == UPDATED_ORDER, {"order_status": "Changed"}, "mistake", now=at(2))
    steps = [("updated", table.read().checkpoint()), ("before", table.before_commit("mistake").checkpoint())]
    table.restore_to("mistake", "restored", now=at(3))
    steps.append(("restored", table.read()))
    out = None
    for name, rows in steps:
        step = rows.select(F.lit(name).alias("step"), *rows.columns)
        out = step if out is None else out.unionByName(step)
    return out


def erp_from_change_feed(spark: SparkSession, d: str) -> DataFrame:
    """Two states of the raw ERP rows -> change feed -> typed -> dedup -> merge: changed orders arrive as a
    DELETE and an INSERT, vanished ones as a DELETE, new ones as an INSERT (J2 -> P2).

    Each state moves once, by the order: the feed, the dedups and the merge use that partitioning."""
    raw = mapping.erp_raw(spark, d).drop(sc.ACTION)
    cut = F.col("_shipdate") < F.lit(mapping.BATCH_SPLIT).cast("timestamp_ntz")
    before = raw.filter(cut).drop("_shipdate").repartition(*sc.ERP_KEYS)
    # Afterwards: late rows were corrected, rows of one warehouse are gone, later rows are new.
    after = raw.filter(~((F.col("warehouse_id") == "WH_O") & cut)).drop("_shipdate") \
        .withColumn("order_status", F.when(F.col("is_late"), "Changed").otherwise(F.col("order_status"))) \
        .repartition(*sc.ERP_KEYS)
    table = silver.erp_orders(before, None, now=catalog.LOAD_1)
    return silver.erp_orders(_change_feed(before, after), table, now=catalog.LOAD_2)


# ---------------------------------------------------------------- history
def erp_history(spark: SparkSession, d: str) -> DataFrame:
    """History of ``erp_orders`` with one commit per ship month."""
    return erp_history_from(mapping.erp_raw(spark, d))


def erp_history_from(raw: DataFrame) -> DataFrame:
    """History of ERP change rows (with ``_shipdate``), one commit per ship month.

    Changes of one order within a month are reduced to one (INSERT first,
    newest order time), then INSERT/UPDATE/DELETE follow from the order's
    previous action.  Rows move once, by the order, reduced in their task before.
    """
    typed = silver.erp_typed(raw, keep=["_shipdate"])
    own = [c for c in typed.columns if c != "_shipdate"]
    ch = typed.select(*own, F.trunc(F.to_date("_shipdate"), "month").alias("_month"))
    first = F.when(F.col(sc.ACTION) == "INSERT", 0).otherwise(1)
    keys, order = sc.ERP_KEYS + ["_month"], [first.asc(), order_desc("order_date")]
    ch = latest_per_key(latest_in_task(ch, keys, order).repartition(*sc.ERP_KEYS), keys, order)
    ch = ch.select(
        *own,
        F.concat(F.lit("C"), F.date_format("_month", "yyyyMM")).alias("commit_id"),
        (F.year("_month") * 12 + F.month("_month")).cast("long").alias("commit_seq"),
        F.add_months("_month", 1).cast("timestamp_ntz").alias("committed_at"))
    return hist.history_from_changes(ch, sc.ERP_KEYS)


def stored_history(spark: SparkSession, d: str) -> DataFrame:
    """The history written once (Parquet in the shared folder, a third of a checkpoint's rows), as the
    time-travel reads see a stored history table; the reads below use it
    several times (states, scalar subqueries)."""
    path = scratch_path(spark, "erp_history")
    rows = erp_history(spark, d)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def as_of(spark: SparkSession, d: str) -> DataFrame:
    return hist.as_of(stored_history(spark, d), sc.ERP_KEYS, AS_OF_TS)


def before_offset(spark: SparkSession, d: str) -> DataFrame:
    return hist.before_offset(stored_history(spark, d), sc.ERP_KEYS, OFFSET_SECONDS, OFFSET_NOW)


def before_commit(spark: SparkSession, d: str) -> DataFrame:
    return hist.before_commit(stored_history(spark, d), sc.ERP_KEYS, RESTORE_COMMIT)


def restore(spark: SparkSession, d: str) -> DataFrame:
    return hist.restore(stored_history(spark, d), sc.ERP_KEYS, RESTORE_COMMIT, catalog.LOAD_2,
                        RESTORE_ID)


def expire(spark: SparkSession, d: str) -> DataFrame:
    return hist.expire(stored_history(spark, d), sc.ERP_KEYS, EXPIRE_DAYS, EXPIRE_NOW)


# ---------------------------------------------------------------- sources
def csv_load(spark: SparkSession, d: str) -> DataFrame:
    """POS rows written as CSV files and loaded back (A1)."""
    path = scratch_path(spark, "csv_load")
    files.write_csv(mapping.pos_raw(spark, d), path, compression="none")
    return files.read_pos_csv(spark, path)


def json_array_load(spark: SparkSession, d: str) -> DataFrame:
    """Sensor documents written as JSON-array files, loaded as VARIANT rows
    and cleaned into ``device_event_readings_from_IOT`` (A2 -> P4)."""
    path = scratch_path(spark, "json_array_load")
    fixtures.write_json_arrays(mapping.iot_docs(spark, d), path)
    return silver.iot_readings(files.read_json_array(spark, path), None, now=catalog.LOAD_1)


def parquet_load(spark: SparkSession, d: str) -> DataFrame:
    """ERP change rows written as Parquet and merged into ``erp_orders`` (A3 -> P2)."""
    path = scratch_path(spark, "parquet_load")
    mapping.erp_raw(spark, d).drop("_shipdate").write.mode("overwrite").parquet(path)
    return silver.erp_orders(files.read_parquet_raw(spark, path), None, now=catalog.LOAD_1)


def inventory_load(spark: SparkSession, d: str) -> DataFrame:
    """Inventory Parquet loaded and appended to ``inventory_snapshots``."""
    raw = scratch_path(spark, "inventory_raw")
    mapping.inventory_raw(spark, d).write.mode("overwrite").parquet(raw)
    table = scratch_path(spark, "inventory_snapshots")
    files.append(silver.inventory(files.read_parquet_raw(spark, raw)), table)
    return files.read_table(spark, table)


def ingest_audit(spark: SparkSession, d: str) -> DataFrame:
    """Loaded rows by landed file, told by its ship year, and the row count the status has."""
    path = scratch_path(spark, "audit")
    raw = mapping.pos_raw(spark, d, with_version=True).withColumn("ship_year", F.year("_shipdate"))
    raw.drop("_shipdate").write.option("header", True).partitionBy("ship_year").csv(path)
    seen = _ingest_audit(files.read_pos_csv(spark, path))
    year = F.regexp_extract("file_path", r"ship_year=(\d+)", 1).cast("int")
    return seen.groupBy(year.alias("ship_year")).agg(F.sum("rows_loaded").alias("rows_loaded"),
                                                     F.min(F.col("file_size") > 0).alias("has_bytes"))


# ---------------------------------------------------------------- streams
INGEST_BATCHES = 16


def stream_ingest(spark: SparkSession, d: str) -> DataFrame:
    """Auto-ingest: new CSV files copied once into a bronze table."""
    landing = scratch_path(spark, "ingest_landing")
    files.write_csv(mapping.pos_raw(spark, d), landing)
    sink, ckpt = scratch_path(spark, "bronze_pos"), scratch_path(spark, "bronze_pos_ckpt")
    # A backlog is cut into micro-batches of one file, of more files when there are many of them.
    files_each = -(-loads.listing(spark, landing).count() // INGEST_BATCHES)
    q = ingest_stream(spark, "csv", landing, sc.POS_RAW, ckpt, sink, maxFilesPerTrigger=max(1, files_each))
    q.awaitTermination()
    # A second run over the same folder finds nothing new.
    q2 = ingest_stream(spark, "csv", landing, sc.POS_RAW, ckpt, sink)
    q2.awaitTermination()
    return spark.read.schema(sc.POS_RAW).parquet(sink)


def _by_year(spark: SparkSession, rows: DataFrame, name: str) -> tuple[list, Callable[[int], DataFrame]]:
    """The years (``_y``) of ``rows``, and the rows of one: stored once by year, so a year's read meets no other's rows."""
    path = scratch_path(spark, name)
    kind = T.StructType([f for f in rows.schema.fields if f.name != "_y"]).add("_y", T.IntegerType())
    with settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": "64"}):
        rows.write.partitionBy("_y").parquet(path)
    stored = spark.read.schema(kind).parquet(path)
    years = [r[0] for r in stored.select("_y").distinct().orderBy("_y").collect()]
    return years, lambda y: stored.where(F.col("_y") == y).drop("_y")


def stream_merge(spark: SparkSession, d: str) -> DataFrame:
    """POS change files arriving one ship year at a time, deduplicated and merged per
    micro-batch into ``cleaned_pos_transaction`` (J3-J6, P1)."""
    rows = mapping.pos_raw(spark, d, with_version=True).withColumn("_y", F.year("_shipdate")).drop("_shipdate")
    years, of_year = _by_year(spark, rows, "pos_years_source")
    landing, ckpt = scratch_path(spark, "pos_landing"), scratch_path(spark, "pos_merge_ckpt")
    table = ChangeTable(spark, scratch_path(spark, "cleaned_pos"), sc.POS_KEYS, sc.POS_CLEAN)
    load = dt.datetime.fromisoformat(catalog.LOAD_1)
    for y in years:
        of_year(y).write.mode("append").option("header", True).option("compression", "gzip").csv(landing)
        cdc_into(change_stream(spark, landing, "csv", sc.POS_RAW), table, silver.dedup_pos, name="pos_merge",
                 checkpoint=ckpt, now=lambda _id: load).awaitTermination()
    return table.read()


def stream_latest(spark: SparkSession, d: str) -> DataFrame:
    """POS change files of several ship years kept as the latest row a transaction in a state store, without batches of our
    own: the year of a file's folder is its arrival, in whatever order files are met (J5, J6, P1)."""
    landing, ckpt = scratch_path(spark, "pos_years"), scratch_path(spark, "pos_latest_ckpt")
    raw = mapping.pos_raw(spark, d, with_version=True).withColumn("ship_year", F.year("_shipdate")).drop("_shipdate")
    with settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": "64"}):
        raw.write.option("header", True).option("compression", "gzip").partitionBy("ship_year").csv(landing)
    year = F.regexp_extract(F.col("_metadata.file_path"), r"ship_year=(\d+)", 1).cast("int")
    stream = change_stream(spark, landing, "csv", sc.POS_RAW, recursiveFileLookup="true") \
        .select("*", F.make_timestamp(year, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)).alias(ARRIVED)) \
        .withColumn("transaction_time", normalise_time("transaction_time"))
    keep_latest(stream, sc.POS_KEYS, ["transaction_time"], ckpt, "pos_latest").awaitTermination()
    return read_latest(spark, ckpt, sc.POS_KEYS).select(*sc.names(sc.POS_COLUMNS))


def late_data(spark: SparkSession, d: str) -> DataFrame:
    """A late batch after the newer one: the merge takes the last arrival, whatever its time."""
    b1, b2 = catalog.split_by_ship_date(mapping.pos_raw(spark, d, with_version=True))
    newer = silver.clean_pos(b2, None, now=catalog.LOAD_1)
    return silver.clean_pos(b1, newer, now=catalog.LOAD_2)


def stream_erp(spark: SparkSession, d: str) -> DataFrame:
    """ERP change files arriving one ship year at a time; after each arrival
    a scheduled run (``availableNow``) merges what is new into ``erp_orders``
    with delete / update / insert (A5 for Parquet, J4, P2)."""
    rows = mapping.erp_raw(spark, d).withColumn("_y", F.year("_shipdate")).drop("_shipdate")
    years, of_year = _by_year(spark, rows, "erp_years_source")
    landing = scratch_path(spark, "erp_landing")
    table = ChangeTable(spark, scratch_path(spark, "erp_orders"), sc.ERP_KEYS, sc.ERP_CLEAN)
    ckpt = scratch_path(spark, "erp_merge_ckpt")
    schema = rows.drop("_y").schema
    load = dt.datetime.fromisoformat(catalog.LOAD_1)
    for y in years:
        of_year(y).write.mode("append").parquet(landing)
        stream = change_stream(spark, landing, "parquet", schema)
        cdc_into(stream, table, lambda b: silver.dedup_erp(silver.erp_typed(b)),
                 name="erp_merge", checkpoint=ckpt, now=lambda _id: load).awaitTermination()
    return table.read()


def stream_iot(spark: SparkSession, d: str) -> DataFrame:
    """Sensor JSON-array files streamed into ``device_event_readings_from_IOT``:
    VARIANT rows, flatten, dedup, merge (A2 + A5, J4, P4)."""
    landing = scratch_path(spark, "iot_landing")
    fixtures.write_json_arrays(mapping.iot_docs(spark, d), landing)
    table = ChangeTable(spark, scratch_path(spark, "iot_readings"), sc.IOT_KEYS, sc.IOT_CLEAN)
    stream = change_stream(spark, landing, "json", sc.IOT_VARIANT, multiLine="true", mode="FAILFAST")
    load = dt.datetime.fromisoformat(catalog.LOAD_1)
    cdc_into(stream, table, silver.iot_source_from_docs, name="iot_merge",
             checkpoint=scratch_path(spark, "iot_merge_ckpt"),
             now=lambda _id: load).awaitTermination()
    return table.read()


def stream_inventory(spark: SparkSession, d: str) -> DataFrame:
    """Inventory Parquet files auto-ingested into ``inventory_snapshots``
    through the silver inventory task (file sink, exactly once) (A4 + A5, P3)."""
    from strata.streaming.tasks import Layout, start_silver_tasks

    root = scratch_path(spark, "inventory_task")
    lay = Layout(landing=f"{root}/landing", silver=f"{root}/silver",
                 checkpoints=f"{root}/checkpoints")
    raw = mapping.inventory_raw(spark, d)
    raw.write.mode("overwrite").parquet(lay.land("inventory"))
    q = start_silver_tasks(spark, lay, erp_schema=None, inventory_schema=raw.schema,
                           trigger="availableNow", which=("inventory",))["inventory"]
    q.awaitTermination()
    return spark.read.parquet(lay.table("inventory_snapshots"))


# ---------------------------------------------------------------- raw tables
def _day(n: int) -> dt.datetime:
    return dt.datetime(2024, 2, n)


def erp_stream_from_table(spark: SparkSession, d: str) -> DataFrame:
    """The raw ERP table (one VARIANT column, filled by a pipe) is deleted and updated in; its task consumes the change
    feed twice, and the second run sees the net changes only (A3 + A5, J1, A10, J2, J4, P2)."""
    raw = mapping.erp_raw(spark, d).drop(sc.ACTION)
    cut = F.col("_shipdate") < F.lit(mapping.BATCH_SPLIT).cast("timestamp_ntz")
    landing = scratch_path(spark, "raw_erp_landing")
    table = RawTable(spark, scratch_path(spark, "raw_erp_data"), "parquet_raw variant")
    pipe = Pipe(spark, "erp_orders_pipe", landing, loads.parquet_reader("parquet_raw"), table, scratch_path(spark, "erp_pipe_ckpt"))
    orders = ChangeTable(spark, scratch_path(spark, "erp_orders"), sc.ERP_KEYS, sc.ERP_CLEAN)
    feed = Feed(table, "stream_raw_erp_data")
    prepare = lambda changes: silver.dedup_erp(silver.erp_typed(changes, "parquet_raw"))

    raw.where(cut).drop("_shipdate").write.mode("append").parquet(landing)
    pipe.start("availableNow", now=lambda _id: _day(1)).awaitTermination()
    run_task(feed, orders, prepare, now=dt.datetime.fromisoformat(catalog.LOAD_1))

    table.delete(vget("parquet_raw", "warehouse_id") == "WH_O", "delete", now=_day(2))
    raw.where(~cut).drop("_shipdate").write.mode("append").parquet(landing)
    pipe.start("availableNow", now=lambda _id: _day(3)).awaitTermination()
    changed = with_field("parquet_raw", "order_status", F.lit("Changed"))
    table.update(vget("parquet_raw", "is_late", "boolean"), {"parquet_raw": changed}, "update", now=_day(4))
    run_task(feed, orders, prepare, now=dt.datetime.fromisoformat(catalog.LOAD_2))
    return orders.read()


def variant_change_feed(spark: SparkSession, d: str) -> DataFrame:
    """The change feed between two states of ``orders`` kept as VARIANT rows: one side has its keys in another order and
    its numbers in another form (J2 over VARIANT)."""
    before, after = _order_states(spark, d)
    texts = lambda df: [F.col(c).cast("string").alias(c) if "timestamp" in t else F.col(c) for c, t in df.dtypes]
    one = before.select(F.to_variant_object(F.struct(*texts(before))).alias("v"))
    two = after.select(F.parse_json(F.to_json(F.struct(*reversed(texts(after))))).alias("v"))
    return _change_feed(one, two).select(
        *[F.variant_get("v", f"$.{c}", "string" if "timestamp" in t else t).cast(t).alias(c) for c, t in before.dtypes], "_action")


def raw_time_travel(spark: SparkSession, d: str) -> DataFrame:
    """Earlier states of a table of repeated rows: AT, BEFORE, retention and recovery (K1-K5 without a key)."""
    rows = mapping.pos_raw(spark, d, with_version=True).select(
        "store_region", "payment_method", F.col("quantity").cast("int").alias("quantity"), "_shipdate")
    early, late = catalog.split_by_ship_date(rows)
    t = RawTable(spark, scratch_path(spark, "raw_pos"), early.schema)
    t.append(early, "early", now=_day(1))
    t.append(late, "late", now=_day(2))
    t.delete((F.col("payment_method") == "CASH") & (F.col("quantity") > 40), "delete", now=_day(3))
    t.update(F.col("store_region") == "ASIA", {"store_region": "APAC", "quantity": 0}, "update", now=_day(4))
    states = {"before_expiry": t.as_of(_day(1)).groupBy(*t.columns).count().checkpoint()}
    t.expire(7, now=_day(9))                       # the two loads become one base
    states |= {"as_of": t.as_of(_day(2)), "before_offset": t.before_offset(24 * 3600, _day(5)), "before": t.before_commit("update"),
               "updated": t.read()}
    states = {k: v if "count" in v.columns else v.groupBy(*t.columns).count().checkpoint() for k, v in states.items()}
    t.restore_to("delete", "restored", now=_day(10))
    states["restored"] = t.read().groupBy(*t.columns).count()
    out = None
    for name, df in states.items():
        step = df.select(F.lit(name).alias("step"), *t.columns, F.col("count").alias("n"))
        out = step if out is None else out.unionByName(step)
    return out


def raw_changes(spark: SparkSession, d: str) -> DataFrame:
    """What changed in a table of repeated rows between two commits, as INSERT and DELETE rows."""
    rows = mapping.pos_raw(spark, d, with_version=True).select(
        "store_region", "category", F.col("quantity").cast("int").alias("quantity"), "_shipdate")
    early, late = catalog.split_by_ship_date(rows)
    t = RawTable(spark, scratch_path(spark, "raw_pos"), early.schema)
    t.append(early, "early", now=_day(1))
    t.append(late, "late", now=_day(2))
    t.update(F.col("quantity") > 30, {"quantity": F.col("quantity") - 10}, "update", now=_day(3))
    t.delete(F.col("store_region") == "EUROPE", "delete", now=_day(4))
    return t.changes(1, 4)


ARRAY_ROWS = 250_000       # documents of one array, about 100 MB of text
ARRAY_BLOCK = 256 << 10    # bytes of a block, and the number of blocks from which they grow instead
ARRAY_BLOCKS = 1024


def json_array_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Sensor documents in large JSON arrays (one, up to ``ARRAY_ROWS`` documents), each read in blocks by several tasks,
    piped into the raw VARIANT table and cleaned (A2 in parallel, A5, A12, P4)."""
    landing = scratch_path(spark, "iot_array")
    fixtures.write_json_arrays(mapping.iot_docs(spark, d), landing, rows_per_file=ARRAY_ROWS)
    table = RawTable(spark, scratch_path(spark, "raw_iot"), "row_col variant")
    size = loads.listing(spark, landing).agg(F.sum("length")).first()[0] or 0
    with settings(spark, {"spark.sql.files.maxPartitionBytes": str(max(ARRAY_BLOCK, size // ARRAY_BLOCKS))}):
        Pipe(spark, "pipe_for_iot", landing, loads.json_reader("row_col"), table, scratch_path(spark, "iot_pipe_ckpt")) \
            .start("availableNow", now=lambda _id: _day(1)).awaitTermination()
    return silver.iot_readings(table.read(), None, now=catalog.LOAD_1)


BAD_YEAR, LATE_YEAR = 1996, 1998


def _pos_pipe(spark: SparkSession, d: str) -> Pipe:
    """POS files, one a ship year; those of ``BAD_YEAR`` hold a quantity that is no number, those of ``LATE_YEAR`` land
    after the pipe's run, and one file is empty."""
    rows = mapping.pos_raw(spark, d, with_version=True).withColumn("ship_year", F.year("_shipdate")).drop("_shipdate")
    broken = (F.col("ship_year") == BAD_YEAR) & (F.col("loyalty_points") == 1)
    rows = rows.withColumn("quantity", F.when(broken, "many").otherwise(F.col("quantity").cast("string")))
    landing = scratch_path(spark, "pos_pipe_landing")

    def put(df: DataFrame) -> None:
        # A task writes its years' files side by side as rows come, instead of sorting all its rows by year first.
        with settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": "64"}):
            repacked(df, ["ship_year"]).write.mode("append").option("header", True).partitionBy("ship_year").csv(landing)

    put(rows.where(F.col("ship_year") != LATE_YEAR))
    spark.createDataFrame([], "value string").coalesce(1).write.text(f"{landing}/ship_year=0")
    table = RawTable(spark, scratch_path(spark, "pos_transaction"), sc.POS_RAW)
    pipe = Pipe(spark, "external_pipe", landing, loads.csv_reader(sc.POS_RAW), table, scratch_path(spark, "pos_pipe_ckpt"), 2)
    pipe.start("availableNow", now=lambda _id: _day(1)).awaitTermination()
    put(rows.where(F.col("ship_year") == LATE_YEAR))
    return pipe


def pipe_skip_file(spark: SparkSession, d: str) -> DataFrame:
    """What a pipe has loaded: all rows of the files that parse, none of the others' (A5, A1)."""
    return _pos_pipe(spark, d).table.read()


def pipe_status(spark: SparkSession, d: str) -> DataFrame:
    """What a pipe says of each landed file: loaded, skipped, pending."""
    year = F.regexp_extract("file", r"ship_year=(\d+)", 1).cast("int")
    return _pos_pipe(spark, d).status().groupBy(year.alias("ship_year"), "status").agg(
        F.sum("rows_loaded").alias("rows_loaded"), F.sum("error_count").alias("error_count"),
        F.min(F.col("size") > 0).alias("has_bytes"), F.count_if(F.col("first_error").isNotNull()).alias("files_with_errors"))
