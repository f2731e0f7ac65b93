"""An exchange whose rows move as compressed blocks of columns.

A shuffle writes row by row, eight bytes a value and more a text; the same rows by column, compressed together, take a
third of it or less.  A task gathers some rows, cuts them by receiving task and sends a block for each.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

cloudpickle.register_pickle_by_value(sys.modules[__name__])     # executors need no copy of this package

PART = "_part"
GATHERED = 48 << 20            # bytes that a task gathers before it cuts them into blocks
LEVEL = 3                      # of zstd

Batches = Iterator[pa.RecordBatch]


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files (and other leaves) that a plan reads, by Spark's statistics; a leaf of unknown size counts as a large one."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def _planes(values: np.ndarray, width: int) -> bytes:
    """The first bytes of all values, then their second ones: equal bytes stand together."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, width).T).tobytes()


def _unplaned(data: bytes, n: int, width: int) -> pa.Buffer:
    return pa.py_buffer(np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, n).T))


def _encoded(batch: pa.RecordBatch) -> bytes:
    """Rows as bytes, column by column: a byte that tells of NULLs and their bits, then a text's lengths and characters,
    or the values by byte."""
    out, n = [], batch.num_rows
    for a in batch.columns:
        out.append(b"\1" + np.packbits(a.is_valid().to_numpy(zero_copy_only=False)).tobytes() if a.null_count else b"\0")
        kind = a.type
        if pa.types.is_null(kind):
            continue
        if pa.types.is_boolean(kind):
            out.append(np.packbits(a.fill_null(False).to_numpy(zero_copy_only=False)).tobytes())
        elif pa.types.is_string(kind) or pa.types.is_binary(kind):
            at = np.frombuffer(a.buffers()[1], np.int32, n + 1, a.offset * 4)
            out += [_planes(np.diff(at).astype(np.int32), 4), a.buffers()[2].slice(int(at[0]), int(at[-1] - at[0])).to_pybytes() if a.buffers()[2] else b""]
        else:
            width = kind.bit_width // 8
            out.append(_planes(np.frombuffer(a.buffers()[1], np.uint8, n * width, a.offset * width), width))
    return b"".join(out)


def _decoded(data: bytes, n: int, schema: pa.Schema) -> pa.RecordBatch:
    columns, at = [], 0

    def take(k: int) -> bytes:
        nonlocal at
        at += k
        return data[at - k:at]

    bits = -(-n // 8)
    for f in schema:
        valid = None
        if take(1) == b"\1":
            valid = pa.py_buffer(np.packbits(np.unpackbits(np.frombuffer(take(bits), np.uint8), count=n), bitorder="little"))
        if pa.types.is_null(f.type):
            columns.append(pa.nulls(n))
        elif pa.types.is_boolean(f.type):
            own = np.packbits(np.unpackbits(np.frombuffer(take(bits), np.uint8), count=n), bitorder="little")
            columns.append(pa.Array.from_buffers(f.type, n, [valid, pa.py_buffer(own)]))
        elif pa.types.is_string(f.type) or pa.types.is_binary(f.type):
            lengths = np.frombuffer(_unplaned(take(4 * n), n, 4), np.int32)
            offsets = np.concatenate([np.zeros(1, np.int32), np.cumsum(lengths, dtype=np.int32)])
            columns.append(pa.Array.from_buffers(f.type, n, [valid, pa.py_buffer(offsets), pa.py_buffer(take(int(offsets[-1])))]))
        else:
            width = f.type.bit_width // 8
            columns.append(pa.Array.from_buffers(f.type, n, [valid, _unplaned(take(n * width), n, width)]))
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def _pack(before: Callable[[Batches], Batches] | None) -> Callable[[Batches], Batches]:
    def blocks(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        part = rows.column(PART).to_numpy()
        rows = rows.drop_columns([PART]).take(pa.array(np.argsort(part, kind="stable"))).combine_chunks()
        ids, counts = np.unique(part, return_counts=True)
        sizes, packed, at = [], [], 0
        coder = pa.Codec("zstd", LEVEL)
        for n in counts.tolist():
            text = _encoded(rows.slice(at, n).to_batches()[0])
            sizes.append(len(text))
            packed.append(coder.compress(text, asbytes=True))
            at += n
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int32()), pa.array(counts, pa.int32()), pa.array(sizes, pa.int64()), pa.array(packed, pa.binary())],
            names=[PART, "_rows", "_size", "_block"])

    def pack(batches: Batches) -> Batches:
        held, size = [], 0
        for batch in (before(batches) if before else batches):
            if batch.num_rows:
                held.append(batch)
                size += batch.nbytes
            if size >= GATHERED:
                yield blocks(held)
                held, size = [], 0
        if held:
            yield blocks(held)
    return pack


def _unpack(schema: pa.Schema, rows_out: int = 1 << 14) -> Callable[[Batches], Batches]:
    def unpack(batches: Batches) -> Batches:
        coder, held, n = pa.Codec("zstd"), [], 0
        for batch in batches:
            for rows, size, block in zip(batch.column("_rows").to_pylist(), batch.column("_size").to_pylist(), batch.column("_block")):
                held.append(_decoded(coder.decompress(block.as_buffer(), size, asbytes=True), rows, schema))
                n += rows
                if n >= rows_out:
                    yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                    held, n = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
    return unpack


def repacked(df: DataFrame, keys: Sequence[str], before: Callable[[Batches], Batches] | None = None,
             parts: int | None = None) -> DataFrame:
    """The rows of ``df``, those of equal ``keys`` in one task; ``before`` sees a task's batches ahead of the exchange.

    ``parts`` tasks receive them (default: the session's shuffle partitions).  Spark does not know the partitioning."""
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    part = F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")
    own = df.withColumn(PART, part).mapInArrow(_pack(before), f"{PART} int, _rows int, _size long, _block binary")
    arrow = to_arrow_schema(df.schema, timestamp_utc=True)
    return own.repartitionById(parts, PART).mapInArrow(_unpack(arrow), df.schema)
