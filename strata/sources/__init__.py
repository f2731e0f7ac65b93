"""File sources, sinks and load audit."""

from strata.sources.files import (
    read_pos_csv, read_json_array, read_parquet_raw, read_table, append, write_csv,
)
from strata.sources.audit import ingest_audit, stream_status

__all__ = ["read_pos_csv", "read_json_array", "read_parquet_raw", "read_table", "append",
           "write_csv", "ingest_audit",
           "stream_status"]
