"""Top-1 per key of a stream as keyed state: no ``foreachBatch``, no stored table.

The stream is aggregated: a key's state is the first of its rows under (arrival, order, tie rule), so the newest
file's row wins whatever its time (the merge takes the last arrival), within a file the greatest order with NULLs
first, and among equals the first row by all columns, NULLs last.  That is what a dedup and a merge of file
after file give.  The query writes nowhere; the table is its state store, read back with Spark's state reader, so
a restart goes on from the checkpoint and a read costs one scan of the state.  Arrival and order are kept the
other way round, so the row itself is the tie rule: the state holds it once.  It lies on disk (RocksDB), not on the heap.

Rows with a NULL key match no other file's: the file's time is part of their key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from strata.operators.merge import AUDIT
from strata.session import settings

ARRIVED = "_arrived"
ROW = "_row_"                # before the names of a row's own columns in the state
# The state's place; its rows are not counted, which would read each before it is written.  Its files lie in the tasks'
# folders and in the checkpoint, so they are compressed well.
STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
         "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
         "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
         "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true"}


def arriving(stream: DataFrame) -> DataFrame:
    """The rows of a file stream with the time their file was written."""
    return stream.select("*", F.col("_metadata.file_modification_time").alias(ARRIVED))


def descending(column: str, kind: T.DataType) -> Column:
    """A value whose greatest is the column's least: numbers and times negated, texts with their bytes' digits
    mirrored and a sign behind the last one that is greater than any digit."""
    c = F.col(column)
    if isinstance(kind, T.NumericType):
        return -c
    if isinstance(kind, T.BooleanType):
        return ~c
    if isinstance(kind, T.DateType):
        return -F.unix_date(c)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return -F.unix_micros(c.cast("timestamp"))
    return F.concat(F.translate(F.hex(F.encode(c.cast("string"), "UTF-8")), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("G"))


def latest(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row a key: its first row (``top.row``; ``top.best`` holds its arrival, which is the last) and ``created_at``,
    the first arrival.

    ``rows`` has the arrival (``arriving``).  One aggregate over the keys, on a stream and on a batch."""
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    payload = [c for c in rows.columns if c not in (*keys, ARRIVED)]
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    first = [descending(ARRIVED, T.TimestampType()).alias(ARRIVED)]
    for c in order:
        first += [F.col(c).isNotNull().alias(f"_some_{c}"), descending(c, kinds[c]).alias(f"_order_{c}")]
    for c in payload:
        first += [F.col(c).isNull().alias(f"_null_{c}"), F.col(c).alias(f"{ROW}{c}")]
    own = rows.groupBy(*keys, F.when(null_key, F.col(ARRIVED)).alias("_alone")).agg(
        F.min(F.struct(*first)).alias("_first"), F.max(descending(ARRIVED, T.TimestampType())).alias("_created"))
    return own.select(*keys, "_alone", F.struct(
        F.struct(_time(F.col("_first")[ARRIVED]).alias(ARRIVED)).alias("best"),
        F.struct(*[F.col("_first")[f"{ROW}{c}"].alias(c) for c in payload]).alias("row")).alias("top"),
        _time(F.col("_created")).alias(AUDIT[0]))


def _time(c: Column) -> Column:
    """The time that ``descending`` has turned round."""
    return F.timestamp_micros(-c)


def keep_latest(stream: DataFrame, keys: Sequence[str], order: Sequence[str], checkpoint: str, name: str,
                trigger: str | None = "availableNow") -> StreamingQuery:
    """Runs ``latest`` over a stream of rows with their arrival; the state below ``checkpoint`` is the table."""
    w = latest(stream, keys, order).writeStream.format("noop").outputMode("update") \
        .option("checkpointLocation", checkpoint).queryName(name)
    with settings(stream.sparkSession, STORE):           # a query keeps the settings it is started with
        return (w.trigger(availableNow=True) if trigger in (None, "availableNow") else w.trigger(processingTime=trigger)).start()


def read_latest(spark: SparkSession, checkpoint: str, keys: Sequence[str]) -> DataFrame:
    """The table that ``keep_latest`` has kept."""
    state = spark.read.format("statestore").load(checkpoint)
    first, created = (F.col("value")[f] for f in state.schema["value"].dataType.names)       # as they are aggregated
    names = [n.removeprefix(ROW) for n in state.schema["value"].dataType[0].dataType.names if n.startswith(ROW)]
    times = [_time(x).cast("timestamp_ntz").alias(c) for x, c in zip((created, first[ARRIVED]), AUDIT)]
    return state.select(*[F.col("key")[k].alias(k) for k in keys], *[first[f"{ROW}{c}"].alias(c) for c in names], *times)
