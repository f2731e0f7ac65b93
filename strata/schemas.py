"""Fixed schemas of the raw and cleaned tables.

Column lists and types follow the reference DDL.  VARCHAR lengths are strings whose width stands in the field's
metadata and is enforced where a stored table is written (``strata.sources.widths``); ``TIME`` travels as an
``HH:mm:ss`` string (zero padded, so it sorts like the time).
"""

from __future__ import annotations

from pyspark.sql import types as T

S, D, TS, B = T.StringType(), T.DateType(), T.TimestampNTZType(), T.BooleanType()


def dec(p: int, s: int = 0) -> T.DecimalType:
    return T.DecimalType(p, s)


def _struct(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


# Widths of the text columns; a name has one width in all tables.
WIDTHS = {
    "transaction_id": 50, "store_id": 20, "store_name": 100, "store_city": 100, "store_region": 100, "cashier_id": 20,
    "customer_id": 20, "product_sku": 50, "product_name": 255, "category": 100, "subcategory": 100, "payment_method": 50,
    "order_id": 50, "order_status": 50, "supplier_id": 20, "supplier_name": 150, "supplier_city": 100, "warehouse_id": 20,
    "alert_type": 20, "severity": 20, "device_id": 50, "event_id": 50, "event_type": 50, "firmware_version": 20,
    "sensor_name": 50, "sensor_unit": 20,
}


def _declared(*cols) -> T.StructType:
    """A table's columns; text ones with their declared width."""
    return T.StructType([T.StructField(n, t, True, {"varchar": WIDTHS[n]} if t is S and n in WIDTHS else None) for n, t in cols])


AUDIT = [("created_at", TS), ("updated_at", TS)]

# Raw point-of-sale rows, in file order (the CSV is read by position).
POS_COLUMNS = [
    ("transaction_id", S), ("store_id", S), ("store_name", S), ("store_city", S),
    ("store_region", S), ("cashier_id", S), ("customer_id", S),
    ("transaction_date", D), ("transaction_time", S), ("product_sku", S),
    ("product_name", S), ("category", S), ("subcategory", S),
    ("quantity", dec(10)), ("unit_price", dec(10, 2)), ("discount_pct", dec(9, 2)),
    ("total_amount", dec(12, 2)), ("payment_method", S), ("loyalty_points", dec(10)),
]
POS_RAW = _declared(*POS_COLUMNS)
POS_KEYS = ["transaction_id", "transaction_date"]
POS_CLEAN = _declared(*POS_COLUMNS, *AUDIT)

# Purchasing orders (ERP), typed extraction of the Parquet rows.
ERP_COLUMNS = [
    ("order_id", S), ("order_date", TS), ("order_status", S),
    ("expected_delivery", D), ("actual_delivery", D), ("is_late", B),
    ("lead_time_days", dec(5)), ("category", S), ("product_sku", S),
    ("quantity_ordered", dec(10)), ("quantity_received", dec(10)),
    ("unit_cost", dec(10, 2)), ("total_cost", dec(12, 2)), ("store_id", S),
    ("store_city", S), ("supplier_id", S), ("supplier_name", S),
    ("supplier_city", S), ("warehouse_id", S),
]
ERP_KEYS = ["order_id"]
ERP_CLEAN = _declared(*ERP_COLUMNS, *AUDIT)
ACTION = "_action"

# Inventory snapshots; no key, appended as they come.
INVENTORY_COLUMNS = [
    ("snapshot_date", D), ("store_id", S), ("warehouse_id", S), ("category", S),
    ("product_sku", S), ("quantity_on_hand", dec(10)), ("reorder_level", dec(10)),
    ("max_stock_level", dec(10)), ("last_received_date", D),
]
INVENTORY = _declared(*INVENTORY_COLUMNS)

# One row per sensor reading (and alert) of a device event.  ``triggere_at``
# is spelled as in the reference DDL.
IOT_COLUMNS = [
    ("alert_type", S), ("severity", S), ("triggere_at", TS), ("store_id", S),
    ("store_name", S), ("device_id", S), ("event_id", S), ("event_type", S),
    ("event_timestamp", TS), ("store_floor", dec(3)), ("battery_pct", dec(3)),
    ("signal_rssi", dec(4)), ("firmware_version", S), ("sensor_name", S),
    ("sensor_value", dec(10, 2)), ("sensor_unit", S),
]
IOT_KEYS = ["event_id", "sensor_name", "event_timestamp"]
IOT_DEDUP_KEYS = ["event_id", "sensor_name"]
IOT_CLEAN = _declared(*IOT_COLUMNS, *AUDIT)

# The top-level fields of a raw sensor JSON document that the silver stream reads, each as it is
# (VARIANT); a stream needs its schema ahead.  ``read_json_array`` finds the fields of its files itself.
IOT_VARIANT = T.StructType([T.StructField(n, T.VariantType()) for n in (
    "store_id", "store_name", "device_id", "event_id", "event_type", "timestamp", "metadata",
    "readings", "alerts")])

# Typed form of one raw sensor JSON document (the array elements of a file).
IOT_DOC = T.StructType([
    T.StructField("store_id", S), T.StructField("store_name", S),
    T.StructField("device_id", S), T.StructField("event_id", S),
    T.StructField("event_type", S), T.StructField("timestamp", TS),
    T.StructField("metadata", _struct(("store_floor", T.IntegerType()),
                                      ("battery_pct", T.IntegerType()),
                                      ("signal_rssi", T.IntegerType()),
                                      ("firmware", S))),
    T.StructField("readings", T.ArrayType(_struct(("sensor", S), ("value", dec(10, 2)),
                                                  ("unit", S)))),
    T.StructField("alerts", T.ArrayType(_struct(("alert_type", S), ("severity", S),
                                                ("triggered_at", TS)))),
])


def names(cols) -> list[str]:
    return [n for n, _ in cols]
