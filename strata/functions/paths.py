"""Semi-structured paths over VARIANT columns.

``vget(col, "metadata.store_floor", "int")`` is the dialect's
``col:metadata.store_floor::INT``.  A JSON null and a missing field both give
SQL NULL.  The strict form raises on a value that cannot be cast (the
dialect's behaviour); ``vget_lenient`` returns NULL instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Dialect type names on the left, the Spark type extracted from the variant on
# the right.  ``int`` and ``number`` are 38-digit decimals in the dialect.
DIALECT_TYPES = {
    "varchar": "string",
    "string": "string",
    "int": "decimal(38,0)",
    "integer": "decimal(38,0)",
    "number": "decimal(38,0)",
    "boolean": "boolean",
    "date": "date",
    "timestamp": "timestamp_ntz",
    "timestamp_ntz": "timestamp_ntz",
}


def _spark_type(t: str) -> str:
    t = t.strip().lower()
    if t.startswith("number(") or t.startswith("decimal("):
        return "decimal" + t[t.index("("):]
    return DIALECT_TYPES.get(t, t)


def _json_path(path: str) -> str:
    return path if path.startswith("$") else "$." + path


def vget(col, path: str, dtype: str = "string") -> Column:
    """Strict typed extraction of ``path`` from a VARIANT column."""
    c = F.col(col) if isinstance(col, str) else col
    return F.variant_get(c, _json_path(path), _spark_type(dtype))


def vget_lenient(col, path: str, dtype: str = "string") -> Column:
    """Like :func:`vget` but NULL on a value that does not cast."""
    c = F.col(col) if isinstance(col, str) else col
    return F.try_variant_get(c, _json_path(path), _spark_type(dtype))


def vitems(col, path: str) -> Column:
    """The array at ``path`` as ``array<variant>`` (NULL when absent/null)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.variant_get(c, _json_path(path), "array<variant>")
