import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators.merge import merge, src, update_where
from strata.plans import silver
from strata import schemas as sc

T0 = dt.datetime(2024, 1, 1)
T1 = dt.datetime(2024, 1, 2)
SCHEMA_T = "k string, v int, created_at timestamp_ntz, updated_at timestamp_ntz"
SCHEMA_S = "k string, v int, _action string"


def _tgt(spark, data):
    return spark.createDataFrame([(k, v, T0, T0) for k, v in data], SCHEMA_T)


def _as_map(df):
    return {r.k: (r.v, r.created_at, r.updated_at) for r in df.collect()}


def test_outcome_table(spark):
    # SURVEY 2.9.1, one row per line of the table.
    target = _tgt(spark, [("keep", 1), ("del", 2), ("upd", 3), ("noop", 4)])
    source = spark.createDataFrame(
        [("del", 20, "DELETE"), ("upd", 30, "INSERT"), ("noop", 40, None),
         ("new", 50, "INSERT"), ("ghost", 60, "DELETE")], SCHEMA_S)
    act = src("_action")
    out = _as_map(merge(target, source, ["k"], columns=["k", "v"], delete_when=act == "DELETE",
                        update_when=act == "INSERT", insert_when=act == "INSERT", now=T1))
    assert out == {
        "keep": (1, T0, T0),     # target only: unchanged
        "upd": (30, T0, T1),     # update: created_at kept, updated_at = now
        "noop": (4, T0, T0),     # matched, no clause true (NULL action): unchanged
        "new": (50, T1, T1),     # insert
    }                            # "del" removed, "ghost" (unknown DELETE) ignored


def test_null_keys_never_match(spark):
    target = spark.createDataFrame([(None, 1, T0, T0)], SCHEMA_T)
    source = spark.createDataFrame([(None, 2, "INSERT")], SCHEMA_S)
    for spread in (False, True):
        got = sorted(r.v for r in merge(target, source, ["k"], columns=["k", "v"], now=T1,
                                        spread_null_keys=spread).collect())
        assert got == [1, 2]


def test_merge_twice_is_idempotent(spark):
    target = _tgt(spark, [("a", 1), ("b", 2)])
    source = spark.createDataFrame([("b", 20, "INSERT"), ("c", 30, "INSERT")], SCHEMA_S)
    once = merge(target, source, ["k"], columns=["k", "v"], now=T1)
    twice = merge(once, source, ["k"], columns=["k", "v"], now=T1)
    assert _as_map(once) == _as_map(twice)


def test_duplicate_source_keys_raise(spark):
    source = spark.createDataFrame([("a", 1, "INSERT"), ("a", 2, "INSERT")], SCHEMA_S)
    with pytest.raises(ValueError):
        merge(None, source, ["k"], columns=["k", "v"], now=T1, check_unique=True).collect()


def test_update_where_touches_only_hits(spark):
    df = _tgt(spark, [("ORD_000001", 1), ("ORD_000002", 2)])
    out = _as_map(update_where(df, F.col("k") == "ORD_000001", {"v": 99}))
    assert out == {"ORD_000001": (99, T0, T0), "ORD_000002": (2, T0, T0)}
    out = _as_map(update_where(df, F.col("k") == "ORD_000001", {"v": 99}, now=T1, touch="updated_at"))
    assert out == {"ORD_000001": (99, T0, T1), "ORD_000002": (2, T0, T0)}


def _pos(spark, rows):
    base = {c: None for c in sc.names(sc.POS_COLUMNS)}
    data = []
    for r in rows:
        d = dict(base, **r)
        data.append(tuple(d[c] for c in sc.names(sc.POS_COLUMNS)))
    return spark.createDataFrame(data, sc.POS_RAW)


def test_clean_pos_late_batch_overwrites(spark):
    # No event-time guard -- a later batch with an older time still wins.
    d = dt.date(2024, 1, 5)
    b1 = _pos(spark, [dict(transaction_id="T1", transaction_date=d, transaction_time="12:00:00",
                           store_id="S1"),
                      dict(transaction_id="T1", transaction_date=d, transaction_time="09:00:00",
                           store_id="S0"),
                      dict(transaction_id="T1", transaction_date=dt.date(2024, 1, 6),
                           transaction_time="08:00:00", store_id="S9"),
                      dict(transaction_id=None, transaction_date=d, store_id="SN")])
    t1 = silver.clean_pos(b1, None, now=T0)
    got = {(r.transaction_id, r.transaction_date): r.store_id for r in t1.collect()}
    assert got == {("T1", d): "S1", ("T1", dt.date(2024, 1, 6)): "S9", (None, d): "SN"}
    b2 = _pos(spark, [dict(transaction_id="T1", transaction_date=d, transaction_time="07:00:00",
                           store_id="S2"),
                      dict(transaction_id=None, transaction_date=d, store_id="SN2")])
    t2 = silver.clean_pos(b2, t1, now=T1).collect()
    late = [r for r in t2 if r.transaction_id == "T1" and r.transaction_date == d][0]
    assert late.store_id == "S2" and late.created_at == T0 and late.updated_at == T1
    # NULL transaction ids never match, so they are inserted again
    assert sorted(r.store_id for r in t2 if r.transaction_id is None) == ["SN", "SN2"]


def test_pos_merge_ignores_actions_and_null_time_wins(spark):
    # A DELETE row of the change stream is upserted like any other row;
    # Within a batch the NULL time is the latest.
    d = dt.date(2024, 1, 5)
    b = _pos(spark, [dict(transaction_id="T1", transaction_date=d, transaction_time="12:00:00",
                          store_id="S1"),
                     dict(transaction_id="T1", transaction_date=d, transaction_time=None,
                          store_id="SNULL")]).withColumn("_action", F.lit("DELETE"))
    out = silver.clean_pos(b, None, now=T0).collect()
    assert [(r.transaction_id, r.store_id) for r in out] == [("T1", "SNULL")]


def test_erp_cast_list_rounds_and_types(spark):
    raw = spark.createDataFrame(
        [("ORD_000001", dt.datetime(2024, 1, 1, 8), 2.7, 2.5, 3, 12345, "INSERT")],
        "order_id string, order_date timestamp_ntz, quantity_ordered double, "
        "quantity_received double, lead_time_days int, store_id long, _action string")
    for c in ["order_status", "category", "product_sku", "store_city", "supplier_id",
              "supplier_name", "supplier_city", "warehouse_id"]:
        raw = raw.withColumn(c, F.lit(None).cast("string"))
    raw = (raw.withColumn("expected_delivery", F.lit(None).cast("date"))
              .withColumn("actual_delivery", F.lit(None).cast("date"))
              .withColumn("is_late", F.lit(None).cast("boolean"))
              .withColumn("unit_cost", F.lit("1.005").cast("decimal(12,3)"))
              .withColumn("total_cost", F.lit("2.675").cast("decimal(13,3)")))
    r = silver.erp_typed(raw).first()
    assert r.quantity_ordered == 3 and r.quantity_received == 3 and r.lead_time_days == 3
    assert str(r.unit_cost) == "1.01" and str(r.total_cost) == "2.68"
    assert r.store_id == "12345"
