"""Unnesting of array columns (the reference's LATERAL FLATTEN)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unnest(df: DataFrame, array_col, alias: str, *, outer: bool = False,
           position: str | None = None) -> DataFrame:
    """One row per element of ``array_col``.

    ``outer=False`` drops rows whose array is NULL or empty (inner lateral
    join); ``outer=True`` keeps them once with a NULL element (and NULL
    position).  ``position`` names a column with the 0-based element index.
    The generator is narrow: no shuffle, and it runs inside the scan stage.
    """
    c = F.col(array_col) if isinstance(array_col, str) else array_col
    if position:
        gen = F.posexplode_outer(c) if outer else F.posexplode(c)
        return df.select("*", gen.alias(position, alias))
    gen = F.explode_outer(c) if outer else F.explode(c)
    return df.select("*", gen.alias(alias))
