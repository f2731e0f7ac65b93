"""Named silver tables built from the test inputs (one change batch each).

``silver_*`` load the whole bronze input as a single batch into an empty
table, which is what the gold views read.  ``*_batches`` split the same
input by ship date (or event time) into two consecutive change batches for
the merge queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.plans import mapping, silver

# Fixed audit times of the test loads (keeps results repeatable).
LOAD_1 = "2024-02-01 00:00:00"
LOAD_2 = "2024-02-02 00:00:00"


def silver_pos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.clean_pos(mapping.pos_raw(spark, sf_dir), None, now=LOAD_1, alone=True)


def silver_erp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.erp_orders(mapping.erp_raw(spark, sf_dir), None, now=LOAD_1, alone=True)


def silver_iot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.iot_readings(mapping.iot_raw(spark, sf_dir), None, now=LOAD_1, alone=True)


def split_by_ship_date(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """First and second change batch of POS / ERP rows (``_shipdate``)."""
    split = F.col("_shipdate") < F.lit(mapping.BATCH_SPLIT).cast("timestamp_ntz")
    return raw.filter(split).drop("_shipdate"), raw.filter(~split).drop("_shipdate")


def split_by_event_time(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """First and (overlapping, re-sent) second batch of sensor documents."""
    first = F.col("_ts") < F.lit(mapping.IOT_FIRST_BATCH_END).cast("timestamp_ntz")
    second = F.col("_ts") >= F.lit(mapping.IOT_SECOND_BATCH_START).cast("timestamp_ntz")
    return raw.filter(first).drop("_ts"), raw.filter(second).drop("_ts")


def two_batch_pos(raw: DataFrame) -> DataFrame:
    b1, b2 = split_by_ship_date(raw)
    return silver.clean_pos(b2, silver.clean_pos(b1, None, now=LOAD_1), now=LOAD_2)


def two_batch_erp(raw: DataFrame) -> DataFrame:
    b1, b2 = split_by_ship_date(raw)
    return silver.erp_orders(b2, silver.erp_orders(b1, None, now=LOAD_1), now=LOAD_2)


def two_batch_iot(raw: DataFrame) -> DataFrame:
    b1, b2 = split_by_event_time(raw)
    return silver.iot_readings(b2, silver.iot_readings(b1, None, now=LOAD_1), now=LOAD_2)


def merged_pos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return two_batch_pos(mapping.pos_raw(spark, sf_dir, with_version=True))


def merged_erp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return two_batch_erp(mapping.erp_raw(spark, sf_dir))


def merged_iot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return two_batch_iot(mapping.iot_raw(spark, sf_dir))
