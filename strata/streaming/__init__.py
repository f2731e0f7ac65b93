"""Structured Streaming ingestion and change processing."""

from strata.streaming.ingest import change_stream, ingest_stream
from strata.streaming.cdc import run_cdc, cdc_into
from strata.streaming.tasks import Layout, start_silver_tasks, read_silver, register_tables

__all__ = ["change_stream", "ingest_stream", "run_cdc", "cdc_into", "Layout",
           "start_silver_tasks", "read_silver", "register_tables"]
