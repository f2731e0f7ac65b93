"""Vectors of other lengths."""

from pyspark.sql import functions as F

from strata.llm import vectors


def test_a_stray_short_vector_does_not_set_the_length(spark):
    rows = spark.createDataFrame([(0, [-5.0])] + [(i, [float(i), 1.0, 0.5]) for i in range(1, 40)],
                                 "vec_id long, embedding array<float>")
    got = vectors.search(rows, rows.where("vec_id < 3"), k=4).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.vec_id) for r in got] == [(q, v) for q in (1, 2) for v in (39, 38, 37, 36)]
    # Copies of a vector count as rows.
    many = rows.withColumn("embedding", F.when(F.col("vec_id") > 5, F.array(F.lit(1.0).cast("float"))).otherwise(F.col("embedding")))
    assert vectors.search(many, many.where("vec_id = 6"), k=50).count() == 34
