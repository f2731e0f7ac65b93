"""Silver layer: typed extraction, deduplication and merges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata import schemas as sc
from strata.functions.expr import normalise_time, order_desc, to_number
from strata.functions.paths import vget, vget_lenient, vitems
from strata.operators.dedup import latest_packed, latest_per_key
from strata.operators.flatten import unnest
from strata.operators.merge import merge, src
from strata.sources.files import as_variant

# Fixed values: (target column, source path, dialect cast, stored type), the reference's
# cast lists for the ERP order and inventory extractions.  Paths are the columns' names.
ERP_EXTRACT = [(n, n, cast, stored) for n, cast, stored in [
    ("order_id", "varchar", "string"),
    ("order_date", "timestamp", "timestamp_ntz"),
    ("order_status", "varchar", "string"),
    ("expected_delivery", "date", "date"),
    ("actual_delivery", "date", "date"),
    ("is_late", "boolean", "boolean"),
    ("lead_time_days", "int", "decimal(5,0)"),
    ("category", "varchar", "string"),
    ("product_sku", "varchar", "string"),
    ("quantity_ordered", "int", "decimal(10,0)"),
    ("quantity_received", "int", "decimal(10,0)"),
    ("unit_cost", "number(10,2)", "decimal(10,2)"),
    ("total_cost", "number(12,2)", "decimal(12,2)"),
    ("store_id", "varchar", "string"),
    ("store_city", "varchar", "string"),
    ("supplier_id", "varchar", "string"),
    ("supplier_name", "varchar", "string"),
    ("supplier_city", "varchar", "string"),
    ("warehouse_id", "varchar", "string"),
]]

INVENTORY_EXTRACT = [(n, n, cast, stored) for n, cast, stored in [
    ("snapshot_date", "date", "date"),
    ("store_id", "varchar", "string"),
    ("warehouse_id", "varchar", "string"),
    ("category", "varchar", "string"),
    ("product_sku", "varchar", "string"),
    ("quantity_on_hand", "number", "decimal(10,0)"),
    ("reorder_level", "number", "decimal(10,0)"),
    ("max_stock_level", "number", "decimal(10,0)"),
    ("last_received_date", "date", "date"),
]]


def dialect_cast(c: Column, dialect: str) -> Column:
    """The reference's ``::type`` on an already typed column."""
    t = dialect.lower()
    if t in ("int", "integer", "number"):
        return to_number(c)
    if t.startswith("number("):
        return c.cast("decimal" + t[t.index("("):])
    return c.cast({"varchar": "string", "timestamp": "timestamp_ntz"}.get(t, t))


def extract(df: DataFrame, spec: Sequence[tuple], variant_col: str | None = None,
            keep: Sequence[str] = (), lenient: bool = False) -> DataFrame:
    """Typed projection of raw rows.

    With ``variant_col`` the paths are read from that VARIANT column
    (``col:path::type``); otherwise the raw rows are already columnar
    (Parquet) and the same cast list is applied to the columns.  Casts are
    strict: a value that does not fit raises.  ``lenient=True`` turns a
    value that does not cast into NULL instead (``try_variant_get`` /
    ``try_cast``).
    """
    cols = []
    for name, path, dialect, stored in spec:
        if variant_col:
            c = (vget_lenient if lenient else vget)(variant_col, path, dialect)
        else:
            c = dialect_cast(F.col(path), dialect)
        cols.append((c.try_cast(stored) if lenient else c.cast(stored)).alias(name))
    return df.select(*cols, *keep)


# ---------------------------------------------------------------- P1 POS
def _latest(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], tiebreak, alone: bool) -> DataFrame:
    """``latest_per_key``; ``alone``: nobody joins the result by the keys, so large inputs may move packed."""
    return latest_packed(rows, keys, order) if alone and tiebreak is True else latest_per_key(rows, keys, order, tiebreak)


def dedup_pos(changes: DataFrame, tiebreak=True, alone: bool = False) -> DataFrame:
    """Latest row per (transaction_id, transaction_date), time descending.

    ``transaction_time`` is normalised first, so its text sorts like the time."""
    rows = changes.select(*sc.names(sc.POS_COLUMNS)) \
        .withColumn("transaction_time", normalise_time("transaction_time"))
    return _latest(rows, sc.POS_KEYS, [order_desc("transaction_time")], tiebreak, alone)


def clean_pos(changes: DataFrame, target: DataFrame | None = None, now=None, alone: bool = False) -> DataFrame:
    """``cleaned_pos_transaction`` after one change batch (dedup, upsert).

    Change actions are not looked at (the reference upserts every row).
    """
    return merge(target, dedup_pos(changes, alone=alone), sc.POS_KEYS,
                 columns=sc.names(sc.POS_COLUMNS), now=now)


# ---------------------------------------------------------------- P2 ERP orders
def erp_typed(changes: DataFrame, variant_col: str | None = None,
              keep: Sequence[str] = ()) -> DataFrame:
    """Typed ERP change rows plus their ``_action`` (and ``keep`` columns).

    Rows of an append feed carry no action: they are inserts."""
    if sc.ACTION not in changes.columns:
        changes = changes.withColumn(sc.ACTION, F.lit("INSERT"))
    return extract(changes, ERP_EXTRACT, variant_col, keep=[sc.ACTION, *keep])


def dedup_erp(typed: DataFrame, tiebreak=True, alone: bool = False) -> DataFrame:
    """Latest change per order: INSERT rows first, then newest order_date."""
    first = F.when(F.col(sc.ACTION) == "INSERT", 0).otherwise(1)
    return _latest(typed, sc.ERP_KEYS, [first.asc(), order_desc("order_date")], tiebreak, alone)


def erp_orders(changes: DataFrame, target: DataFrame | None = None, now=None,
               variant_col: str | None = None, alone: bool = False) -> DataFrame:
    """``erp_orders`` after one change batch: delete / update / insert."""
    source = dedup_erp(erp_typed(changes, variant_col), alone=alone)
    act = src(sc.ACTION)
    return merge(target, source, sc.ERP_KEYS, columns=sc.names(sc.ERP_COLUMNS),
                 delete_when=act == "DELETE", update_when=act == "INSERT",
                 insert_when=act == "INSERT", now=now)


# ---------------------------------------------------------------- P3 inventory
def inventory(raw: DataFrame, variant_col: str | None = None) -> DataFrame:
    """``inventory_snapshots`` rows: typed extraction only, no key, no dedup."""
    return extract(raw, INVENTORY_EXTRACT, variant_col)


# ---------------------------------------------------------------- P4 IoT
def iot_events(raw: DataFrame, variant_col: str = "row_col") -> DataFrame:
    """Event-level fields of each sensor document (B3, B4) plus its two arrays.

    ``metadata`` fields are nested object paths; the dialect's ``::INT`` is a
    rounding 38-digit decimal, narrowed to the stored width (overflow raises).
    """
    v = variant_col
    return raw.select(
        vget(v, "store_id", "varchar").alias("store_id"),
        vget(v, "store_name", "varchar").alias("store_name"),
        vget(v, "device_id", "varchar").alias("device_id"),
        vget(v, "event_id", "varchar").alias("event_id"),
        vget(v, "event_type", "varchar").alias("event_type"),
        vget(v, "timestamp", "timestamp").alias("event_timestamp"),
        to_number(vget(v, "metadata.store_floor", "int"), 3).alias("store_floor"),
        to_number(vget(v, "metadata.battery_pct", "int"), 3).alias("battery_pct"),
        to_number(vget(v, "metadata.signal_rssi", "int"), 4).alias("signal_rssi"),
        vget(v, "metadata.firmware", "varchar").alias("firmware_version"),
        vitems(v, "readings").alias("_readings"),
        vitems(v, "alerts").alias("_alerts"),
    )


def iot_flatten(raw: DataFrame, variant_col: str = "row_col", position: str = "_apos") -> DataFrame:
    """One row per reading x alert of every sensor document.

    Event-level fields are extracted before the arrays are unnested so they
    are computed once per document.  Readings are unnested inner (a document
    without readings vanishes), alerts outer (a NULL alert row when alerts
    are missing, null or empty); ``position`` keeps the alert's index.
    Unnesting is narrow: it runs in the scan stage, before any shuffle.
    """
    r = unnest(iot_events(raw, variant_col), "_readings", "_r")
    a = unnest(r, "_alerts", "_a", outer=True, position=position)
    return a.select(
        vget("_a", "alert_type", "varchar").alias("alert_type"),
        vget("_a", "severity", "varchar").alias("severity"),
        vget("_a", "triggered_at", "timestamp").alias("triggere_at"),
        "store_id", "store_name", "device_id", "event_id", "event_type", "event_timestamp",
        "store_floor", "battery_pct", "signal_rssi", "firmware_version",
        vget("_r", "sensor", "varchar").alias("sensor_name"),
        vget("_r", "value", "number(10,2)").alias("sensor_value"),
        vget("_r", "unit", "varchar").alias("sensor_unit"),
        position,
    )


def dedup_iot(flat: DataFrame, position: str = "_apos", tiebreak=True, alone: bool = False) -> DataFrame:
    """Latest reading per (event_id, sensor_name); the first alert wins a tie."""
    out = _latest(flat, sc.IOT_DEDUP_KEYS, [order_desc("event_timestamp"), F.col(position).asc_nulls_last()],
                  tiebreak, alone)
    return out.drop(position)


def iot_source_from_docs(docs: DataFrame) -> DataFrame:
    """Merge source from sensor documents (a JSON-array file stream):
    each document becomes one VARIANT value, then flatten and dedup."""
    return dedup_iot(iot_flatten(as_variant(docs)))


def iot_readings(changes: DataFrame, target: DataFrame | None = None, now=None,
                 variant_col: str = "row_col", alone: bool = False) -> DataFrame:
    """``device_event_readings_from_IOT`` after one batch of documents."""
    source = dedup_iot(iot_flatten(changes, variant_col), alone=alone)
    return merge(target, source, sc.IOT_KEYS, columns=sc.names(sc.IOT_COLUMNS), now=now)
