"""Top-1 per key (the reference's ``QUALIFY row_number() ... = 1``)."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.packed import input_bytes, repacked

PACK_BYTES = 256 << 20         # of input files, from which a dedup packs its rows; below, the passes through Python cost more
_PACKED = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType)
_UNORDERABLE = (T.MapType, T.VariantType)


def tiebreak_columns(df: DataFrame, exclude: Sequence[str]) -> list[Column]:
    """Every orderable column not in ``exclude``, ascending, NULLs last.

    Appended to a dedup order it makes the surviving row deterministic: two
    rows can only still tie when they are equal in every column.
    """
    skip = set(exclude)
    return [F.col(f.name).asc_nulls_last() for f in df.schema.fields
            if f.name not in skip and not isinstance(f.dataType, _UNORDERABLE)]


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                   tiebreak: bool | Sequence[Column] = True) -> DataFrame:
    """Keep the first row of every ``keys`` group under ``order``.

    Planned as ``row_number() = 1``, which Catalyst turns into a
    ``WindowGroupLimit`` on both sides of the shuffle: each map task already
    keeps one row per key, so a key holding a large share of the rows sends
    at most one row per map task through the exchange.

    ``tiebreak=True`` appends every other column (see :func:`tiebreak_columns`);
    a list of columns appends those instead; ``False`` leaves ties arbitrary
    as in the reference.
    """
    order = list(order)
    if tiebreak is True:
        order += tiebreak_columns(df, keys)
    elif tiebreak:
        order += list(tiebreak)
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") == 1)
              .drop("_rn"))


def latest_in_task(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Of the rows of a task, the first of every ``keys`` group under ``order`` and the tie-break; no exchange.

    What is left still holds the first row of every group, so :func:`latest_per_key` gives the same behind it.  For an
    exchange by some of the keys, which several steps can share: a hot key sends a row a task and group.
    """
    rows = df.sortWithinPartitions(*keys, *order, *tiebreak_columns(df, keys))
    return rows.mapInArrow(_firsts(list(keys)), df.schema)


def _firsts(keys: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of rows sorted by ``keys``, the first of every group (NULL equals NULL)."""
    def firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None                                     # the keys of the row before the batch
        for batch in batches:
            if not batch.num_rows:
                continue
            own = pa.Table.from_batches([batch.select(keys)])
            shifted = own.slice(0, own.num_rows - 1)
            shifted = pa.concat_tables([before if before is not None else own.slice(0, 1), shifted])
            same = None
            for k in keys:
                a, b = own.column(k), shifted.column(k)
                eq = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))
                same = eq if same is None else pc.and_(same, eq)
            keep = np.array(pc.invert(same))
            keep[0] |= before is None
            before = own.slice(own.num_rows - 1, 1)
            yield batch.filter(pa.array(keep))
    return firsts


def latest_packed(df: DataFrame, keys: Sequence[str], order: Sequence[Column], least: int | None = None) -> DataFrame:
    """:func:`latest_per_key` with every tie-break column, its rows packed while they move.

    The tie rule needs whole rows behind the exchange, however few columns are read there.  Each task keeps the first row
    of its keys and sends the others as compressed blocks of columns, one for each receiving task; that one unpacks
    and sorts them (in Spark's sort, which spills) and keeps the first again.  The result has no known partitioning: for
    readers that do not join by the same keys.  Inputs below ``least`` bytes of files (default: ``PACK_BYTES``), keys without an equality of bytes and
    types that cannot be packed go by ``latest_per_key``.
    """
    if not (all(isinstance(f.dataType, _PACKED) for f in df.schema.fields)
            and not any(isinstance(df.schema[k].dataType, T.FractionalType) and not isinstance(df.schema[k].dataType, T.DecimalType)
                        for k in keys)
            and input_bytes(df) >= (PACK_BYTES if least is None else least)):
        return latest_per_key(df, keys, order)
    ties = tiebreak_columns(df, keys)
    own = repacked(df.sortWithinPartitions(*keys, *order, *ties), keys, _firsts(list(keys)))
    return own.sortWithinPartitions(*keys, *order, *ties).mapInArrow(_firsts(list(keys)), df.schema)


def latest_per_key_agg(df: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """Top-1 per key as an aggregate: the row with the greatest ``version``,
    a NULL version first (the dialect's DESC order).

    ``max_by`` over a struct is a hash aggregate with a map-side partial
    step, so it also runs as a stateful streaming aggregation where a
    ``row_number`` window is not allowed.  Rows tying on the version are
    picked arbitrarily (the reference leaves ties open, too).
    """
    payload = [c for c in df.columns if c not in keys]
    order = F.struct(F.col(version).isNull().alias("_null"), F.col(version).alias("_v"))
    best = F.max_by(F.struct(*payload), order).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col("_row." + c).alias(c)
                                                       for c in payload])
