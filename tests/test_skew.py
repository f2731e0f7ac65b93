"""One key holding a third of all rows: results equal the naive forms."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from naive import pos_iot_sensor_data_naive
from strata.functions.expr import clamp_floor, order_desc
from strata.operators.dedup import latest_per_key
from strata.plans import gold

N = 30000


def skewed_pos(spark):
    i = F.col("id")
    return spark.range(N).select(
        F.when(i % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("S"), (i % 50).cast("string")))
         .alias("store_id"),
        F.lit("name").alias("store_name"),
        F.date_add(F.lit("2024-01-01").cast("date"), (i % 90).cast("int")).alias("transaction_date"),
        ((i % 200) - 50).cast("decimal(12,2)").alias("total_amount"),
        (i % 7).cast("decimal(10,0)").alias("quantity"),
        (i % 400).cast("string").alias("customer_id"),
        F.lit("c").alias("category"), F.lit("r").alias("store_region"),
        F.lit("x").alias("store_city"), (i % 11).cast("string").alias("product_sku"))


def test_running_total_equals_naive_window(spark):
    pos = skewed_pos(spark)
    fast = gold.running_total(pos)
    w = (Window.partitionBy("store_id").orderBy(F.unix_date("trans_date")).rangeBetween(-29, 0))
    naive = (pos.select("store_id", "store_name", F.col("transaction_date").alias("trans_date"),
                        "total_amount")
                .select("store_id", "store_name", "trans_date",
                        clamp_floor("total_amount").cast("decimal(12,2)").alias("total_amount"),
                        F.sum("total_amount").over(w).cast("decimal(38,2)")
                         .alias("running_total")))
    assert fast.count() == N
    assert fast.exceptAll(naive).isEmpty() and naive.exceptAll(fast).isEmpty()


def test_top1_on_hot_key(spark):
    df = spark.range(N).select(F.when(F.col("id") % 3 == 0, "HOT")
                                .otherwise((F.col("id") % 100).cast("string")).alias("k"),
                               (F.col("id") * 7 % N).alias("t"))
    top = latest_per_key(df, ["k"], [order_desc("t")])
    plan = top._jdf.queryExecution().executedPlan().toString()
    # a partial WindowGroupLimit runs before the exchange: the hot key sends
    # at most one row per map task through the shuffle
    assert plan.count("WindowGroupLimit") == 2
    want = df.groupBy("k").agg(F.max("t").alias("t"))
    assert top.exceptAll(want).isEmpty() and want.exceptAll(top).isEmpty()


def test_sensor_rewrite_on_hot_store(spark):
    pos = skewed_pos(spark)
    iot = spark.range(300).select(
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("S"), (F.col("id") % 50)
                                                              .cast("string"))).alias("store_id"),
        F.lit("name").alias("store_name"),
        F.when(F.col("id") % 2 == 0, "t").otherwise("h").alias("sensor_name"),
        (F.col("id") % 37).cast("decimal(10,2)").alias("sensor_value"))
    cols = ["store_id", "store_name", "sensor_name", "transaction_date", "total_revenue",
            "sensor_value_total"]
    fast = gold.pos_iot_sensor_data(iot, pos, ordered=False).select(*cols)
    naive = pos_iot_sensor_data_naive(iot, pos).select(*cols)
    assert fast.exceptAll(naive).isEmpty() and naive.exceptAll(fast).isEmpty()


def test_daily_sales_hot_group(spark):
    pos = skewed_pos(spark).withColumn("store_id", F.lit("HOT"))   # one store: all rows
    got = gold.daily_sales(pos, ordered=False).agg(F.sum("unique_customers")).first()[0]
    want = pos.select("transaction_date", "customer_id").distinct().count()
    assert got == want
