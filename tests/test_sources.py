import datetime as dt
import decimal
import os
import tempfile

from strata import schemas as sc
from strata.plans import silver
from strata.sources import files
from strata.sources.audit import ingest_audit, stream_status
from strata.streaming.ingest import ingest_stream

HEADER = ",".join(sc.names(sc.POS_COLUMNS))


def _write(dirpath, name, text):
    os.makedirs(dirpath, exist_ok=True)
    with open(os.path.join(dirpath, name), "w") as f:
        f.write(text)


def test_pos_csv_by_position_quotes_literal(spark):
    d = tempfile.mkdtemp(prefix="pos-csv-")
    _write(d, "a.csv", HEADER + "\n"
           'T1,S1,"Main",City,Reg,C1,K1,2024-01-05,10:00:00,P1,Widget,cat,sub,2,1.50,0.10,2.70,CARD,3\n'
           "T2,S1,,City,Reg,C1,K2,2024-01-05,,P1,Widget,cat,sub,1,1.50,0.00,-1.50,CASH,\n")
    got = {r.transaction_id: r for r in files.read_pos_csv(spark, d).collect()}
    assert got["T1"].store_name == '"Main"'                 # no enclosure: quotes stay
    assert got["T1"].quantity == decimal.Decimal(2)
    assert got["T1"].transaction_date == dt.date(2024, 1, 5)
    assert got["T2"].store_name is None and got["T2"].transaction_time is None
    assert got["T2"].total_amount == decimal.Decimal("-1.50")
    audit = ingest_audit(files.read_pos_csv(spark, d)).collect()
    assert len(audit) == 1 and audit[0].rows_loaded == 2


def test_json_array_typed_and_variant(spark):
    d = tempfile.mkdtemp(prefix="iot-json-")
    _write(d, "a.json", '[{"event_id": "E1", "timestamp": "2024-01-05T10:00:00", '
                        '"readings": [{"sensor": "t", "value": 1.25, "unit": "C"}], "alerts": null},'
                        ' {"event_id": "E2", "timestamp": "2024-01-05T11:00:00", "readings": []}]')
    typed = files.read_json_array(spark, d, sc.IOT_DOC).collect()
    assert [r.event_id for r in typed] == ["E1", "E2"]
    var = files.read_json_array(spark, d)
    flat = silver.iot_flatten(var).collect()
    assert [(r.event_id, r.sensor_value) for r in flat] == [("E1", decimal.Decimal("1.25"))]


def test_json_stream_and_batch_read_alike(spark):
    """Schema on read in both: rounding, numbers as text, missing and extra fields."""
    d = tempfile.mkdtemp(prefix="iot-alike-")
    _write(d, "a.json", '[{"event_id": "E1", "timestamp": "2024-01-05T10:00:00", "extra": {"x": 1}, "metadata": '
                        '{"store_floor": 2.7, "battery_pct": "80"}, "readings": [{"sensor": "t", "value": "21.5"}]},'
                        ' {"event_id": "E2", "readings": [{"sensor": "t", "value": 1}]}]')
    batch = silver.dedup_iot(silver.iot_flatten(files.read_json_array(spark, d)))
    out = tempfile.mkdtemp(prefix="iot-alike-out-")
    seen = []
    stream = spark.readStream.schema(sc.IOT_VARIANT).option("multiLine", True).json(d)
    stream.writeStream.foreachBatch(lambda b, i: seen.append(silver.iot_source_from_docs(b).collect())) \
        .option("checkpointLocation", out).trigger(availableNow=True).start().awaitTermination()
    key = lambda r: r.event_id
    rows = sorted(batch.collect(), key=key)
    assert rows == sorted(seen[0], key=key)
    assert (rows[0].store_floor, rows[0].battery_pct, rows[0].sensor_value) == \
        (decimal.Decimal(3), decimal.Decimal(80), decimal.Decimal("21.50"))
    assert rows[1].store_floor is None


def test_ingest_stream_loads_new_files_once(spark):
    land = tempfile.mkdtemp(prefix="land-")
    out, ckpt = tempfile.mkdtemp(prefix="sink-"), tempfile.mkdtemp(prefix="ckpt-")
    row = "T{0},S1,n,c,r,C,K,2024-01-05,10:00:00,P,N,cat,sub,1,1.00,0.00,1.00,CARD,1\n"
    _write(land, "a.csv", HEADER + "\n" + row.format(1))
    q = ingest_stream(spark, "csv", land, sc.POS_RAW, ckpt, out)
    q.awaitTermination()
    assert stream_status(q)["last_progress"]["numInputRows"] == 1
    assert spark.read.parquet(out).count() == 1
    ingest_stream(spark, "csv", land, sc.POS_RAW, ckpt, out).awaitTermination()
    assert spark.read.parquet(out).count() == 1            # restart: nothing new
    _write(land, "b.csv", HEADER + "\n" + row.format(2) + row.format(3))
    ingest_stream(spark, "csv", land, sc.POS_RAW, ckpt, out).awaitTermination()
    assert spark.read.parquet(out).count() == 3
