import decimal

import pytest
from pyspark.sql import functions as F

from strata.functions.expr import clamp_floor, to_number
from strata.functions.paths import vget, vget_lenient, vitems

D = decimal.Decimal


def test_clamp_floor_keeps_null(spark):
    # H2: the dialect's greatest() is NULL when an argument is NULL.
    df = spark.createDataFrame([(D("-3.50"),), (D("2.25"),), (None,)], "x decimal(12,2)")
    got = [r.y for r in df.select(clamp_floor("x").alias("y")).collect()]
    assert got == [D("0.00"), D("2.25"), None]


def test_to_number_rounds_half_up(spark):
    # dialect INT is a 38-digit decimal: 2.7 -> 3, 2.5 -> 3, -2.5 -> -3
    df = spark.createDataFrame([(2.7,), (2.5,), (-2.5,), (2.4,)], "x double")
    got = [r.y for r in df.select(to_number("x").alias("y")).collect()]
    assert got == [D(3), D(3), D(-3), D(2)]


def test_to_number_overflow_raises(spark):
    # store_floor 1000 does not fit NUMBER(3,0)
    df = spark.createDataFrame([(1000,)], "x int")
    with pytest.raises(Exception):
        df.select(to_number("x", 3).alias("y")).collect()


def test_variant_paths(spark):
    df = spark.createDataFrame(
        [('{"a": 1, "m": {"f": "2.7"}, "arr": [1, 2], "n": null}',),
         ('{"a": "x"}',)], "j string").select(F.parse_json("j").alias("v"))
    got = df.select(vget_lenient("v", "a", "int").alias("a"),
                    vget("v", "m.f", "varchar").alias("f"),
                    vget("v", "missing", "varchar").alias("missing"),
                    vget("v", "n", "varchar").alias("n"),
                    F.size(vitems("v", "arr")).alias("k")).collect()
    assert got[0].a == D(1) and got[0].f == "2.7" and got[0].missing is None
    assert got[0].n is None and got[0].k == 2
    assert got[1].a is None  # lenient: a string that is not a number
    with pytest.raises(Exception):  # strict cast raises
        df.select(vget("v", "a", "int")).collect()


def test_ts_lit_ignores_session_time_zone(spark):
    import datetime as dt
    from strata.functions.expr import ts_lit
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        v = dt.datetime(2024, 2, 1, 0, 0)
        got = spark.range(1).select(ts_lit(v).alias("t"), ts_lit("2024-02-01 00:00:00")
                                    .alias("u")).first()
        assert got.t == v and got.u == v
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
