"""strata: a PySpark-native retail medallion pipeline.

Raw point-of-sale CSV, sensor JSON and purchasing/inventory Parquet land in a
bronze area; ``plans.silver`` cleans them (deduplication, nested-array
flattening, insert/update/delete merges, change history); ``plans.gold``
computes the analytic views.  Everything is expressed with DataFrames so that
Catalyst plans the joins, shuffles and scans.
"""

from strata.session import build_session, scratch_path

__all__ = ["build_session", "scratch_path"]
