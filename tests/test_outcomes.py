"""The stored table against the merge operator, for every sequence of actions; double retention; two writers."""

import datetime as dt
import itertools
import tempfile

from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators import history as H
from strata.operators.merge import merge, src
from strata.sources.change_table import ChangeTable

KV = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.IntegerType()),
                   T.StructField("created_at", T.TimestampNTZType()), T.StructField("updated_at", T.TimestampNTZType())])
ACTIONS = ["INSERT", "DELETE", None, "OTHER"]


def day(d):
    return dt.datetime(2024, 2, d)


def table(spark):
    return ChangeTable(spark, tempfile.mkdtemp(prefix="changes-"), ["k"], KV)


def content(df):
    return sorted(tuple(r) for r in df.select("k", "v", "created_at", "updated_at").collect())


def test_every_sequence_of_four_actions(spark):
    """One key for each of the 256 sequences; batch by batch, as the merge clauses say."""
    sequences = list(itertools.product(ACTIONS, repeat=4))
    t, merged = table(spark), None
    for step in range(4):
        rows = [(f"k{i}", 10 * step + i, s[step]) for i, s in enumerate(sequences)]
        batch = spark.createDataFrame(rows, "k string, v int, _action string").repartition(2)
        t.merge(batch, f"c{step}", now=day(step + 1))
        act = src("_action")
        merged = merge(merged, batch, ["k"], columns=["k", "v"], delete_when=act == "DELETE", update_when=act == "INSERT",
                       insert_when=act == "INSERT", now=day(step + 1)).checkpoint()
        assert content(t.as_of(day(step + 1))) == content(merged)
    assert content(t.read()) == content(merged)
    # The operator alone gives the same history when the other actions are still among its changes.
    raw = [(f"k{i}", 10 * step + i, a, f"c{step}", step + 1, day(step + 1))
           for i, s in enumerate(sequences) for step, a in enumerate(s)]
    changes = spark.createDataFrame(raw, "k string, v int, _action string, commit_id string, commit_seq long, committed_at timestamp_ntz")
    assert content(H.current(H.history_from_changes(changes, ["k"]), ["k"])) == content(merged)


def test_second_retention_run_writes_nothing(spark):
    t = table(spark)
    row = lambda v: spark.createDataFrame([("a", v, "INSERT")], "k string, v int, _action string")
    t.merge(row(1), "c1", now=day(1))
    t.merge(row(2), "c2", now=day(2))
    assert t.expire(1, now=day(4)) == 2
    files = sorted(t.spark.read.parquet(f"{t.path}/changes").inputFiles())
    assert t.expire(1, now=day(4)) == 0 and t.expire(1, now=day(6)) == 0
    assert sorted(t.spark.read.parquet(f"{t.path}/changes").inputFiles()) == files
    t.merge(row(3), "c3", now=day(7))
    assert t.expire(1, now=day(9)) == 1 and content(t.read()) == [("a", 3, day(1), day(7))]


def test_commits_with_one_number_are_told_apart(spark):
    t = table(spark)
    row = lambda v: spark.createDataFrame([("a", v, "INSERT")], "k string, v int, _action string")
    t.merge(row(0), "o", now=day(1))
    seq = t._next("p")                                     # both writers look before either writes
    for name, v, at in (("p", 1, day(2)), ("q", 2, day(3))):
        own = row(v).withColumn(H.ROW, F.lit(None).cast("long"))
        t._put(own, name, seq, at)
    assert [r.v for r in t.read().collect()] == [2]
    assert [r.v for r in t.before_commit("q").collect()] == [1]
    assert [r.v for r in t.before_commit("p").collect()] == [0]
    assert [r._op for r in sorted(t.history().collect(), key=lambda r: r.committed_at)] == ["INSERT", "UPDATE", "UPDATE"]


def test_before_offset_of_the_table_raises_beyond_the_horizon(spark):
    import pytest
    t = table(spark)
    row = lambda v: spark.createDataFrame([("a", v, "INSERT")], "k string, v int, _action string")
    t.merge(row(1), "c1", now=day(1))
    t.merge(row(2), "c2", now=day(5))
    assert [r.v for r in t.before_offset(3600, day(5)).collect()] == [1]
    t.expire(1, now=day(4))
    assert [r.v for r in t.before_offset(3600, day(5)).collect()] == [1]
    with pytest.raises(ValueError, match="horizon"):
        t.before_offset(3600, day(3))
