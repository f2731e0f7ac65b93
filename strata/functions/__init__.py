"""Column-level helpers (all built from ``pyspark.sql.functions``)."""

from strata.functions.expr import (
    clamp_floor, to_number, to_date, order_desc, normalise_time, as_cents_avg, shift,
)
from strata.functions.paths import vget, vget_lenient, vitems

__all__ = ["clamp_floor", "to_number", "to_date", "order_desc", "normalise_time",
           "as_cents_avg", "shift", "vget", "vget_lenient", "vitems"]
