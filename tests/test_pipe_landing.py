"""Landed files of the pipe queries: one a year, written without sorting a task's rows."""

from contextlib import contextmanager

from strata.plans import workloads as W

SF = "/root/testdata/sf0.001"


def test_files_of_years_are_written_side_by_side(spark, monkeypatch):
    held = []
    real = W.settings

    @contextmanager
    def noted(s, values):
        with real(s, values):
            held.append(values)
            yield

    monkeypatch.setattr(W, "settings", noted)
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", None)
    pipe = W._pos_pipe(spark, SF)
    assert [int(v["spark.sql.maxConcurrentOutputFileWriters"]) > 7 for v in held] == [True, True]
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", None) == before
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(pipe.landing).inputFiles()
    years = [f.split("ship_year=")[1].split("/")[0] for f in files if "ship_year=" in f and ".csv" in f]
    assert len(years) == len(set(years)) > 3
