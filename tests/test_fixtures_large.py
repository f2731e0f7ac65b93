"""Input files that are written row by row, whatever their size."""

import json
import tempfile

from pyspark.sql import functions as F

from strata.plans import fixtures, workloads as W


def test_an_array_is_written_by_elements(spark):
    path = tempfile.mkdtemp(prefix="arrays-")
    docs = spark.range(1000).select("id", F.lit("a,\"b\n").alias("t"))
    fixtures.write_json_arrays(docs, path, rows_per_file=1000)
    files = spark.read.text(path, wholetext=True).collect()
    assert sorted(x["id"] for x in json.loads(files[0].value)) == list(range(1000)) and len(files) == 1
    # No value holds an array: the longest is an element.
    assert spark.read.text(path).agg(F.max(F.length("value"))).first()[0] < 100
    fixtures.write_json_arrays(docs.limit(0), path)
    assert spark.read.text(path).count() == 0


def test_large_arrays_are_several(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(fixtures, "write_json_arrays", lambda df, path, rows_per_file: seen.append(rows_per_file) or 1 / 0)
    monkeypatch.setattr(W.mapping, "iot_docs", lambda spark, d: None)
    try:
        W.json_array_blocks(spark, "")
    except ZeroDivisionError:
        pass
    assert seen[0] <= 1_000_000
