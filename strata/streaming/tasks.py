"""The silver tasks of the pipeline as Structured Streaming queries.

``start_silver_tasks`` starts, for one landing / silver folder layout:

* POS CSV files      -> dedup -> merge into ``cleaned_pos_transaction``;
* ERP order Parquet  -> cast list -> action-aware dedup -> delete / update /
  insert merge into ``erp_orders``;
* sensor JSON arrays -> VARIANT rows -> flatten -> dedup -> merge into
  ``device_event_readings_from_IOT``;
* inventory Parquet  -> cast list -> append to ``inventory_snapshots``.

Each is an ordinary streaming query with its own checkpoint; the trigger is
the reference's one-minute schedule by default, ``availableNow`` for a
catch-up run that stops by itself.  Empty micro-batches are skipped.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from strata import schemas as sc
from strata.plans import silver
from strata.sources.change_table import ChangeTable
from strata.streaming.cdc import cdc_into
from strata.streaming.ingest import change_stream


@dataclass
class Layout:
    """Folder layout: where files land, where tables and checkpoints live."""

    landing: str
    silver: str
    checkpoints: str
    max_files_per_trigger: int | None = None     # delays files of a backlog, never drops them

    def land(self, name: str) -> str:
        return f"{self.landing.rstrip('/')}/{name}"

    def table(self, name: str) -> str:
        return f"{self.silver.rstrip('/')}/{name}"

    def ckpt(self, name: str) -> str:
        return f"{self.checkpoints.rstrip('/')}/{name}"


def tables(spark: SparkSession, layout: Layout) -> dict[str, ChangeTable]:
    return {
        "pos": ChangeTable(spark, layout.table("cleaned_pos_transaction"), sc.POS_KEYS, sc.POS_CLEAN),
        "erp": ChangeTable(spark, layout.table("erp_orders"), sc.ERP_KEYS, sc.ERP_CLEAN),
        "iot": ChangeTable(spark, layout.table("device_event_readings_from_IOT"), sc.IOT_KEYS,
                           sc.IOT_CLEAN),
    }


def start_silver_tasks(spark: SparkSession, layout: Layout, erp_schema: T.StructType | None,
                       inventory_schema: T.StructType | None,
                       trigger: str | None = "1 minute",
                       which: tuple[str, ...] = ("pos", "erp", "iot", "inventory"),
                       ) -> dict[str, StreamingQuery]:
    """Start the silver tasks; returns the running queries by name.

    ``erp_schema`` / ``inventory_schema`` are the source systems' Parquet
    schemas (a file stream needs one up front; it can be taken from a file
    already landed with ``spark.read.parquet(path).schema``).
    """
    t = tables(spark, layout)
    out: dict[str, StreamingQuery] = {}
    if "pos" in which:
        stream = change_stream(spark, layout.land("pos"), "csv", sc.POS_RAW, layout.max_files_per_trigger)
        out["pos"] = cdc_into(stream, t["pos"], silver.dedup_pos, "pos_merge",
                              layout.ckpt("pos_merge"), trigger)
    if "erp" in which:
        stream = change_stream(spark, layout.land("erp"), "parquet", erp_schema, layout.max_files_per_trigger)
        out["erp"] = cdc_into(stream, t["erp"],
                              lambda b: silver.dedup_erp(silver.erp_typed(b)), "erp_merge",
                              layout.ckpt("erp_merge"), trigger)
    if "iot" in which:
        stream = change_stream(spark, layout.land("iot"), "json", sc.IOT_VARIANT, layout.max_files_per_trigger,
                               multiLine="true", mode="FAILFAST")
        out["iot"] = cdc_into(stream, t["iot"], silver.iot_source_from_docs, "iot_merge",
                              layout.ckpt("iot_merge"), trigger)
    if "inventory" in which:
        # A plain insert (no key, no dedup): a projection of the stream into
        # the file sink, which commits each micro-batch exactly once through
        # its own metadata log -- no foreachBatch needed.
        stream = change_stream(spark, layout.land("inventory"), "parquet", inventory_schema,
                               layout.max_files_per_trigger)
        w = (silver.inventory(stream).writeStream.format("parquet")
                   .option("checkpointLocation", layout.ckpt("inventory_append"))
                   .queryName("inventory_append"))
        w = w.trigger(availableNow=True) if trigger in (None, "availableNow") \
            else w.trigger(processingTime=trigger)
        out["inventory"] = w.start(layout.table("inventory_snapshots"))
    return out


def read_silver(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    """The current silver tables (for the gold views)."""
    t = tables(spark, layout)
    return {"pos": t["pos"].read(), "erp": t["erp"].read(), "iot": t["iot"].read(),
            "inventory": spark.read.parquet(layout.table("inventory_snapshots"))}


# The table names the silver layer is queried by.
TABLE_NAMES = {
    "pos": "cleaned_pos_transaction",
    "erp": "erp_orders",
    "inventory": "inventory_snapshots",
    "iot": "device_event_readings_from_IOT",
}


def register_tables(spark: SparkSession, layout: Layout) -> list[str]:
    """Temp views for the silver tables (by their table names) and the gold
    views, so existing SQL runs unchanged through ``spark.sql``."""
    from strata.plans import gold

    t = read_silver(spark, layout)
    for key, name in TABLE_NAMES.items():
        t[key].createOrReplaceTempView(name)
    return list(TABLE_NAMES.values()) + gold.register_views(t["pos"], t["erp"], t["iot"])
