"""Bronze-layer inputs derived from the driver's test tables.

The pipeline's real inputs are point-of-sale CSV, sensor JSON and ERP
Parquet files.  For tests and benchmarks they are derived, with Spark, from
the TPC-H-like tables, so every query's work grows with the scale factor:

* POS rows      = lineitem x orders x supplier x nation x region x part
* ERP orders    = lineitem x orders x part, one purchase order per line
* ERP inventory = lineitem x part, one snapshot row per line
* sensor events = events x supplier, one JSON document per event

Duplicated ``(l_orderkey, l_linenumber)`` pairs in lineitem become repeated
deliveries of one POS transaction / ERP order; ``l_shipdate`` orders them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the mapping (shared with the DuckDB oracle).
VERSION_EPOCH = "1995-01-01"      # day 0 of the version clock
SECONDS_PER_VERSION_DAY = 30      # one ship day later = 30 s later in the day
EVENT_SHIFT_YEARS = 24            # events (2024) are moved onto the sales years
BATCH_SPLIT = "1998-06-01"        # POS / ERP changes: first and second batch by ship date
IOT_FIRST_BATCH_END = "2000-01-16"   # IoT: first batch before, second batch from ...
IOT_SECOND_BATCH_START = "2000-01-10"  # ... this day (the overlap is re-sent)


ALERTS_TYPE = "array<struct<alert_type:string,severity:string,triggered_at:timestamp_ntz>>"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def version_seconds(shipdate: Column) -> Column:
    """Seconds into the day that encode the ship date (monotone in it)."""
    days = F.datediff(F.to_date(shipdate), F.lit(VERSION_EPOCH).cast("date"))
    return F.pmod(days * SECONDS_PER_VERSION_DAY, F.lit(86400))


def hhmmss(secs: Column) -> Column:
    return F.format_string("%02d:%02d:%02d", F.floor(secs / 3600).cast("int"),
                           F.pmod(F.floor(secs / 60), F.lit(60)).cast("int"),
                           F.pmod(secs, F.lit(60)).cast("int"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate",
                                             "o_orderstatus")
    return li.join(o, li.l_orderkey == o.o_orderkey, "inner")


def pos_raw(spark: SparkSession, sf_dir: str, with_version: bool = False) -> DataFrame:
    """Point-of-sale rows in the raw CSV layout."""
    lo = _lines(spark, sf_dir)
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand",
                                           "p_retailprice")
    # The large tables first, while rows are narrow: they move twice, without the stores' names.
    j = (lo.join(p, lo.l_partkey == p.p_partkey)
           .join(s, lo.l_suppkey == s.s_suppkey)
           .join(n, F.col("s_nationkey") == n.n_nationkey)
           .join(r, F.col("n_regionkey") == r.r_regionkey))
    net = (F.col("l_extendedprice").cast("decimal(12,2)")
           * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))).cast("decimal(12,2)")
    sign = F.when(F.col("l_returnflag") == "R", F.lit(-1)).otherwise(F.lit(1))
    cols = [
        F.concat(F.lit("TXN_"), F.col("l_orderkey").cast("string"), F.lit("_"),
                 F.col("l_linenumber").cast("string")).alias("transaction_id"),
        F.col("l_suppkey").cast("string").alias("store_id"),
        F.col("s_name").alias("store_name"),
        F.col("n_name").alias("store_city"),
        F.col("r_name").alias("store_region"),
        F.concat(F.lit("CSH_"), F.col("l_linestatus")).alias("cashier_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.to_date("o_orderdate").alias("transaction_date"),
        hhmmss(version_seconds(F.col("l_shipdate"))).alias("transaction_time"),
        F.col("l_partkey").cast("string").alias("product_sku"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("subcategory"),
        F.col("l_quantity").cast("decimal(10,0)").alias("quantity"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("unit_price"),
        (F.col("l_discount").cast("decimal(4,2)") * F.lit(100)).cast("decimal(9,2)")
            .alias("discount_pct"),
        (sign * net).cast("decimal(12,2)").alias("total_amount"),
        F.when(F.col("l_linestatus") == "O", "CARD").otherwise("CASH").alias("payment_method"),
        F.col("l_linenumber").cast("decimal(10,0)").alias("loyalty_points"),
    ]
    if with_version:
        cols.append(F.col("l_shipdate").alias("_shipdate"))
    return j.select(*cols)


def erp_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ERP purchase-order change rows, as the source system writes them.

    Types are the source's (doubles, longs, decimals of scale 3); the silver
    extraction applies the reference's cast list.  ``_action`` is the change
    action (a returned line cancels its order).
    """
    lo = _lines(spark, sf_dir)
    p = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand", "p_retailprice")
    j = lo.join(p, lo.l_partkey == p.p_partkey)
    secs = version_seconds(F.col("l_shipdate"))
    price = F.col("p_retailprice").cast("decimal(10,2)")
    expected = F.date_add(F.to_date("o_orderdate"), 30)
    return j.select(
        F.concat(F.lit("ORD_"), F.col("l_orderkey").cast("string"), F.lit("_"),
                 F.col("l_linenumber").cast("string")).alias("order_id"),
        (F.col("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs))
            .alias("order_date"),
        F.col("o_orderstatus").alias("order_status"),
        expected.alias("expected_delivery"),
        F.to_date("l_shipdate").alias("actual_delivery"),
        (F.to_date("l_shipdate") > expected).alias("is_late"),
        F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate")).alias("lead_time_days"),
        F.col("p_type").alias("category"),
        F.col("l_partkey").alias("product_sku"),
        F.col("l_quantity").alias("quantity_ordered"),
        F.when(F.col("l_linestatus") == "F", F.col("l_quantity") * F.lit(0.9))
         .otherwise(F.lit(0.0)).alias("quantity_received"),
        (price * F.lit(0.6).cast("decimal(1,1)")).alias("unit_cost"),
        (F.col("l_quantity").cast("decimal(10,0)") * price * F.lit(0.6).cast("decimal(1,1)"))
            .alias("total_cost"),
        F.col("l_suppkey").alias("store_id"),
        F.lit(None).cast("string").alias("store_city"),
        F.col("p_brand").alias("supplier_id"),
        F.concat(F.col("p_brand"), F.lit(" Supply")).alias("supplier_name"),
        F.lit(None).cast("string").alias("supplier_city"),
        F.concat(F.lit("WH_"), F.col("l_linestatus")).alias("warehouse_id"),
        F.when(F.col("l_returnflag") == "R", "DELETE").otherwise("INSERT").alias("_action"),
        F.col("l_shipdate").alias("_shipdate"),
    )


def inventory_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ERP inventory snapshot rows in the source's types."""
    li = table(spark, sf_dir, "lineitem")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    j = li.join(p, li.l_partkey == p.p_partkey)
    return j.select(
        F.col("l_shipdate").alias("snapshot_date"),
        F.col("l_suppkey").alias("store_id"),
        F.concat(F.lit("WH_"), F.col("l_linestatus")).alias("warehouse_id"),
        F.col("p_type").alias("category"),
        F.col("l_partkey").alias("product_sku"),
        (F.col("l_quantity") * F.lit(2.7)).alias("quantity_on_hand"),
        (F.col("l_quantity") * F.lit(0.3)).alias("reorder_level"),
        (F.col("l_quantity") * F.lit(4.0)).alias("max_stock_level"),
        F.date_sub(F.to_date("l_shipdate"), F.col("l_linenumber")).alias("last_received_date"),
    )


def iot_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One typed sensor document per event (the elements of a JSON file).

    Readings: the event's own value under the event type, plus a ``k``
    reading from ``props`` for clicks.  Alerts by event type: error one
    TEMP_BREACH, click LOW_BATTERY then TEMP_BREACH, view one DOOR_OPEN,
    purchase an empty list, signup none (NULL).
    """
    ev = table(spark, sf_dir, "events")
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    n_sup = sup.select(F.count(F.lit(1))).scalar()
    j = ev.join(sup, F.pmod(ev.user_id, n_sup) == sup.s_suppkey)
    ts = F.col("ts") - F.make_ym_interval(F.lit(EVENT_SHIFT_YEARS), F.lit(0))
    et = F.col("event_type")
    sev = F.when(F.col("value") > 40, "HIGH").otherwise("LOW")

    def reading(sensor: Column, value: Column, unit: str) -> Column:
        return F.struct(sensor.alias("sensor"), value.cast("decimal(10,2)").alias("value"),
                        F.lit(unit).alias("unit"))

    def alert(kind: str, severity: Column) -> Column:
        return F.struct(F.lit(kind).alias("alert_type"), severity.alias("severity"),
                        ts.alias("triggered_at"))

    own = reading(et, F.col("value"), "C")
    k = reading(F.lit("k"), F.get_json_object("props", "$.k"), "n")
    alerts = (F.when(et == "error", F.array(alert("TEMP_BREACH", sev)))
               .when(et == "click", F.array(alert("LOW_BATTERY", F.lit("LOW")),
                                            alert("TEMP_BREACH", sev)))
               .when(et == "view", F.array(alert("DOOR_OPEN", sev)))
               .when(et == "purchase", F.array().cast(ALERTS_TYPE)))
    return j.select(
        F.col("s_suppkey").cast("string").alias("store_id"),
        F.col("s_name").alias("store_name"),
        F.concat(F.lit("DEV_"), F.col("user_id").cast("string")).alias("device_id"),
        F.concat(F.lit("EVT_"), F.col("event_id").cast("string")).alias("event_id"),
        et.alias("event_type"),
        ts.alias("timestamp"),
        F.struct(F.pmod(F.col("user_id"), F.lit(4)).cast("int").alias("store_floor"),
                 (F.lit(100) - F.pmod(F.col("event_id"), F.lit(100))).cast("int")
                     .alias("battery_pct"),
                 (F.lit(-40) - F.pmod(F.col("user_id"), F.lit(50))).cast("int")
                     .alias("signal_rssi"),
                 F.concat(F.lit("fw-"), F.pmod(F.col("user_id"), F.lit(3)).cast("string"))
                     .alias("firmware")).alias("metadata"),
        F.when(et == "click", F.array(own, k)).otherwise(F.array(own)).alias("readings"),
        alerts.alias("alerts"),
    )


def iot_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensor documents as the raw single-VARIANT-column table (``row_col``)."""
    d = iot_docs(spark, sf_dir)
    return d.select(F.to_variant_object(F.struct(*d.columns)).alias("row_col"),
                    F.col("timestamp").alias("_ts"))
