import datetime as dt
import decimal
import json

import pytest
from pyspark.sql import functions as F

from strata.plans import silver

TS = "2024-01-05T10:00:00"


def doc(eid, readings="missing", alerts="missing", floor=1, ts=TS):
    d = {"store_id": "S1", "store_name": "Store 1", "device_id": "D1", "event_id": eid,
         "event_type": "temp", "timestamp": ts,
         "metadata": {"store_floor": floor, "battery_pct": 80, "signal_rssi": -60,
                      "firmware": "fw"}}
    if readings != "missing":
        d["readings"] = readings
    if alerts != "missing":
        d["alerts"] = alerts
    return json.dumps(d)


def R(s, v):
    return {"sensor": s, "value": v, "unit": "C"}


def A(t, sev="HIGH"):
    return {"alert_type": t, "severity": sev, "triggered_at": TS}


def raw(spark, docs):
    return spark.createDataFrame([(d,) for d in docs], "j string") \
        .select(F.parse_json("j").alias("row_col"))


def test_flatten_cardinality(spark):
    # readings inner, alerts outer: rows = sum |readings| * max(1, |alerts|)
    docs = [doc("E1"),                                   # no readings -> vanishes
            doc("E2", readings=[]),                      # empty readings -> vanishes
            doc("E3", readings=[R("t", 1.5), R("h", 2)]),  # alerts missing
            doc("E4", readings=[R("t", 3)], alerts=None),
            doc("E5", readings=[R("t", 4)], alerts=[]),
            doc("E6", readings=[R("t", 5), R("h", 6)], alerts=[A("TEMP_BREACH"), A("X", "LOW")])]
    flat = silver.iot_flatten(raw(spark, docs)).collect()
    per = {}
    for r in flat:
        per[r.event_id] = per.get(r.event_id, 0) + 1
    assert per == {"E3": 2, "E4": 1, "E5": 1, "E6": 4}
    e5 = [r for r in flat if r.event_id == "E5"][0]
    assert e5.alert_type is None and e5._apos is None and e5.triggere_at is None
    e3 = sorted((r.sensor_name, r.sensor_value) for r in flat if r.event_id == "E3")
    assert e3 == [("h", decimal.Decimal("2.00")), ("t", decimal.Decimal("1.50"))]
    assert flat[0].event_timestamp == dt.datetime(2024, 1, 5, 10)


def test_iot_dedup_first_alert_and_timestamps(spark):
    # One event with two alerts gives two rows per sensor; the first alert wins.
    # Within a batch the newest timestamp of (event, sensor) replaces older ones.
    docs = [doc("E1", readings=[R("t", 5)], alerts=[A("LOW_BATTERY", "LOW"), A("TEMP_BREACH")]),
            doc("E2", readings=[R("t", 1)], ts="2024-01-05T09:00:00"),
            doc("E2", readings=[R("t", 2)], ts="2024-01-05T11:00:00")]
    out = {r.event_id: r for r in silver.dedup_iot(silver.iot_flatten(raw(spark, docs))).collect()}
    assert out["E1"].alert_type == "LOW_BATTERY"
    assert out["E2"].sensor_value == decimal.Decimal("2.00")


def test_iot_merge_new_timestamp_adds_row(spark):
    # Across batches a new timestamp is a new merge key -> an extra row.
    b1 = raw(spark, [doc("E1", readings=[R("t", 1)], ts="2024-01-05T09:00:00")])
    b2 = raw(spark, [doc("E1", readings=[R("t", 2)], ts="2024-01-05T11:00:00"),
                     doc("E1", readings=[R("t", 3)], ts="2024-01-05T11:00:00")])
    t1 = silver.iot_readings(b1, None, now=dt.datetime(2024, 2, 1))
    t2 = silver.iot_readings(b2, t1, now=dt.datetime(2024, 2, 2)).collect()
    assert len(t2) == 2


def test_store_floor_overflow_raises(spark):
    with pytest.raises(Exception):
        silver.iot_flatten(raw(spark, [doc("E1", readings=[R("t", 1)], floor=1000)])).collect()


def test_bad_number_raises(spark):
    with pytest.raises(Exception):
        silver.iot_flatten(raw(spark, [doc("E1", readings=[R("t", "abc")])])).collect()
