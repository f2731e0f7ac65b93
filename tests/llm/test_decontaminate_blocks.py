"""Spans of a benchmark in one block and in many."""

from pyspark.sql import functions as F

from strata.llm import decontaminate


def test_spans_are_cut_alike_with_one_block_and_many(spark):
    w = [f"w{i}" for i in range(60)]
    items = [(k, " ".join(w[5 * k:5 * k + 20])) for k in range(6)]
    items += [(k, " ".join(f"x{k}y{i}" for i in range(12))) for k in range(6, 12)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    # A cut that closes up a window of another block, and a text that is nothing else.
    inner = " ".join(f"x6y{i}" for i in range(12))
    closing = " ".join([*(f"x7y{i}" for i in range(6)), inner, *(f"x7y{i}" for i in range(6, 12))])
    docs = [" ".join(w[:n]) + " tail" for n in (12, 15, 25, 33, 47)] + [f"a {closing} b", closing, "clean text", None, ""]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").withColumn("row", F.lit("kept"))
    cut = lambda size: sorted(map(str, decontaminate.remove_spans(df, bench, block_bytes=size).collect()))
    one = cut(decontaminate.BLOCK_BYTES)
    assert cut(700) == one and cut(150) == one and len(one) == len(docs) - 1
    assert decontaminate.scan(decontaminate.remove_spans(df, bench, block_bytes=150), bench).where("n_hit > 0").isEmpty()
