"""Scalar expressions with the reference dialect's semantics.

Every helper returns a ``Column`` built from JVM-side functions, so the
expressions stay inside whole-stage code generation.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ts_lit(value) -> Column:
    """A ``TIMESTAMP_NTZ`` literal from a naive ``datetime``, a date or a string.

    Goes through the ISO text, so no session or process time zone is
    involved (``F.lit(datetime)`` would make a zoned TIMESTAMP first).
    """
    if isinstance(value, Column):
        return value
    if isinstance(value, dt.datetime):
        value = value.isoformat(sep=" ")
    elif isinstance(value, dt.date):
        value = value.isoformat()
    return F.lit(value).cast("timestamp_ntz")


def clamp_floor(x, floor=0) -> Column:
    """``greatest(x, floor)`` that stays NULL when ``x`` is NULL.

    The reference dialect returns NULL when any argument of ``greatest`` is
    NULL; Spark's ``greatest`` skips NULLs and would return ``floor``.
    """
    x = _c(x)
    return F.when(x.isNotNull(), F.greatest(x, F.lit(floor)))


def to_number(x, precision: int = 38, scale: int = 0) -> Column:
    """Dialect ``::INT`` / ``::NUMBER(p, s)``: a rounding decimal cast.

    The dialect's integer is a 38-digit decimal, so ``2.7::INT`` is 3.  Going
    through ``decimal(38, s)`` rounds half up; the final narrowing cast raises
    under ANSI mode when the value does not fit (for example a floor of 1000
    into ``NUMBER(3,0)``).
    """
    wide = _c(x).cast(f"decimal(38,{scale})")
    return wide if precision == 38 else wide.cast(f"decimal({precision},{scale})")


def normalise_time(x) -> Column:
    """A ``TIME`` text as ``HH:mm:ss`` (fractions of a second kept); raises for anything else."""
    c = F.trim(_c(x))
    pattern = r"^([01]?[0-9]|2[0-3]):([0-5]?[0-9])(?::([0-5]?[0-9])(\.[0-9]{1,9})?)?$"
    part = lambda k: F.lpad(F.regexp_extract(c, pattern, k), 2, "0")
    # Most times are written in full already: one expression, not five.
    return F.when(c.isNull(), F.lit(None).cast("string")) \
            .when(c.rlike(r"^(?:[01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]$"), c) \
            .when(c.rlike(pattern), F.concat(part(1), F.lit(":"), part(2), F.lit(":"), part(3),
                                             F.regexp_extract(c, pattern, 4))) \
            .otherwise(F.raise_error(F.concat(F.lit("not a time: "), c)).cast("string"))


def to_date(x) -> Column:
    """Dialect ``::date`` of a date or timestamp."""
    return _c(x).cast("date")


def order_desc(x) -> Column:
    """Descending order with the dialect's NULL placement (NULLs first)."""
    return _c(x).desc_nulls_first()


def as_cents_avg(total_cents, count) -> Column:
    """``double(sum of cents) / double(100 * count)``.

    Used where an average must be bit-equal across engines: both sums are
    exact decimals, and one IEEE division is done at the end.
    """
    return _c(total_cents).cast("double") / (F.lit(100.0) * _c(count).cast("double"))


def shift(ts, amount: int, unit: str = "HOUR") -> Column:
    """``dateadd(unit, amount, ts)``, e.g. ``shift(now, -1)`` is one hour ago."""
    return F.timestamp_add(unit.upper(), F.lit(amount), ts_lit(ts))
