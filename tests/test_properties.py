"""Randomised checks against brute-force Python models (small fixtures)."""

import datetime as dt
import decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from naive import pos_iot_sensor_data_naive
from strata.functions.expr import order_desc
from strata.operators.dedup import latest_per_key
from strata.operators.merge import merge, src
from strata.plans import gold

D = decimal.Decimal
SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
keys = st.sampled_from(["a", "b", "c", None])
times = st.one_of(st.none(), st.integers(0, 5))
vals = st.integers(-3, 3)


@SETTINGS
@given(st.lists(st.tuples(keys, times, vals), max_size=12))
def test_latest_per_key_matches_brute_force(spark, data):
    df = spark.createDataFrame(data, "k string, t int, v int")
    got = sorted(((r.k, r.t, r.v) for r in
                  latest_per_key(df, ["k"], [order_desc("t")]).collect()), key=str)
    best = {}
    for k, t, v in data:
        # NULL time first, then larger time; ties: smaller t (asc), smaller v
        rank = (0 if t is None else 1, -(t or 0), v)
        if k not in best or rank < best[k][0]:
            best[k] = (rank, (k, t, v))
    assert got == sorted((b[1] for b in best.values()), key=str)


@SETTINGS
@given(st.dictionaries(st.sampled_from("abcde"), vals, max_size=5),
       st.dictionaries(st.sampled_from("abcdef"),
                       st.tuples(vals, st.sampled_from(["INSERT", "DELETE", None])), max_size=6))
def test_merge_matches_model(spark, target, source):
    t0, t1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    tdf = spark.createDataFrame([(k, v, t0, t0) for k, v in target.items()],
                                "k string, v int, created_at timestamp_ntz, updated_at timestamp_ntz")
    sdf = spark.createDataFrame([(k, v, a) for k, (v, a) in source.items()],
                                "k string, v int, _action string")
    act = src("_action")
    got = {r.k: (r.v, r.created_at, r.updated_at) for r in
           merge(tdf, sdf, ["k"], columns=["k", "v"], delete_when=act == "DELETE",
                 update_when=act == "INSERT", insert_when=act == "INSERT", now=t1).collect()}
    want = {k: (v, t0, t0) for k, v in target.items()}
    for k, (v, a) in source.items():
        if k in target and a == "DELETE":
            del want[k]
        elif k in target and a == "INSERT":
            want[k] = (v, t0, t1)
        elif k not in target and a == "INSERT":
            want[k] = (v, t1, t1)
    assert got == want


money = st.one_of(st.none(), st.integers(-500, 500).map(lambda c: D(c) / 100))


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["S1", "S2", None]), st.integers(0, 3), money),
                max_size=8),
       st.lists(st.tuples(st.sampled_from(["S1", "S2", "S3", None]), st.sampled_from(["t", "h"]),
                          money), max_size=8))
def test_sensor_rewrite_matches_naive(spark, sales, sensors):
    pos = spark.createDataFrame(
        [(s, dt.date(2024, 1, 1) + dt.timedelta(days=d), a) for s, d, a in sales],
        "store_id string, transaction_date date, total_amount decimal(12,2)")
    iot = spark.createDataFrame([(s, "n", n, v) for s, n, v in sensors],
                                "store_id string, store_name string, sensor_name string, "
                                "sensor_value decimal(10,2)")
    key = ("store_id", "store_name", "sensor_name", "transaction_date")

    def as_map(df):
        return {tuple(r[k] for k in key):
                (r.total_revenue, r.sensor_value_total,
                 None if r.average_sensor_value is None else round(float(r.average_sensor_value), 5))
                for r in df.collect()}
    assert as_map(gold.pos_iot_sensor_data(iot, pos, ordered=False)) == \
        as_map(pos_iot_sensor_data_naive(iot, pos))
