"""Large JSON arrays, one file read by many tasks.

A file that is one array has no lines to be split at, so it is read as text between commas: Spark splits that at byte
ranges like any text, and a comma is only sometimes the end of an element.  Two passes tell which:

1. each block (file and first byte) is scanned once and summed up: its quotes, and how much deeper its brackets lead, both
   for a block that begins outside a string and for one that begins inside.  Summed over the blocks
   before, this is every block's start state (``states``; one row a block comes to the driver);
2. each block is scanned from its state and cut at the commas of depth one.  Elements within a block are
   whole; the pieces at its borders (one or two a block) are put together by file.

A backslash before a quote hides it wherever it stands, since backslashes stand in strings only.  Elements are texts;
what is not JSON in them shows when they are parsed.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.session import ensure_checkpoint_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])     # executors need no copy of this package

OPEN = np.zeros(256, dtype=np.int8)
OPEN[[0x5B, 0x7B]] = 1
OPEN[[0x5D, 0x7D]] = -1
SUMMARY = "file string, block long, quotes long, outside long, inside long"
PIECE = "file string, block long, no long, kind string, text string"


def _bytes(column: pa.Array) -> np.ndarray:
    """The texts with a comma behind each."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.empty(0, np.uint8)
    return np.insert(raw, at[1:] - at[0], 0x2C)


def _quotes(x: np.ndarray) -> np.ndarray:
    """Which bytes are quotes that no backslash hides."""
    quote = x == 0x22
    slash = x == 0x5C
    if slash.any():
        at = np.arange(len(x))
        run = at - np.maximum.accumulate(np.where(slash, -1, at))      # backslashes up to here
        quote[1:] &= run[:-1] % 2 == 0
    return quote


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, np.ndarray]]:
    """The rows of a batch by file and block, in their order."""
    files, blocks = batch.column("file"), batch.column("block").to_numpy()
    code = files.dictionary_encode().indices.to_numpy()
    cut = np.flatnonzero((np.diff(code) != 0) | (np.diff(blocks) != 0)) + 1
    for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(blocks)]):
        if b > a:
            yield files[a].as_py(), int(blocks[a]), _bytes(batch.column("value").slice(a, b - a))


def _summaries(batches: Iterator[pa.RecordBatch]):
    found: dict[tuple[str, int], list[int]] = {}
    for batch in batches:
        for file, block, x in _runs(batch):
            own = found.setdefault((file, block), [0, 0, 0])
            quote = _quotes(x)
            parity = np.cumsum(quote) & 1
            step = OPEN[x]
            outside, inside = int(step[parity == 0].sum()), int(step[parity == 1].sum())
            if own[0] & 1:                                            # this part of the block begins the other way
                outside, inside = inside, outside
            own[0] += int(quote.sum())
            own[1] += outside
            own[2] += inside
    keys = list(found)
    yield pa.RecordBatch.from_arrays(
        [pa.array([f for f, _ in keys], pa.string()), pa.array([b for _, b in keys], pa.int64()),
         *(pa.array([found[k][i] for k in keys], pa.int64()) for i in range(3))],
        names=["file", "block", "quotes", "outside", "inside"])


class _Cutter:
    """The elements of one block, from its start state."""

    def __init__(self, parity: int, depth: int):
        self.parity, self.depth = parity, depth
        self.held: list[bytes] = []                  # of the element that is not ended yet
        self.kind = "end" if depth > 0 else None     # what the next end of an element makes of it
        self.bad = False

    def feed(self, x: np.ndarray) -> Iterator[tuple[str, bytes]]:
        quote = _quotes(x)
        inside = (np.cumsum(quote) + self.parity) & 1
        step = np.where(inside, 0, OPEN[x])
        depth = self.depth + np.cumsum(step)
        cut = (inside == 0) & (((x == 0x2C) & (depth == 1)) | ((step == 1) & (depth == 1)) | ((step == -1) & (depth == 0)))
        last = 0
        for i in np.flatnonzero(cut).tolist():
            text = x[last:i].tobytes()
            last = i + 1
            if step[i] == 1:                         # the array opens
                self.bad |= bool(text.strip(b" \t\r\n,\xef\xbb\xbf")) or x[i] != 0x5B
                self.kind = "whole"
                continue
            text = b"".join([*self.held, text])
            self.held = []
            if step[i] == -1:                        # and closes: nothing behind the last comma is no element
                if text.strip() or self.kind == "end":
                    yield self.kind, text
                self.kind = None
            else:
                yield self.kind, text
                self.kind = "whole"
        rest = x[last:].tobytes()
        if self.kind is None:
            self.bad |= bool(rest.strip(b" \t\r\n,\xef\xbb\xbf"))
        else:
            self.held.append(rest)
        self.parity = int((self.parity + quote.sum()) & 1)
        self.depth = int(depth[-1]) if len(depth) else self.depth

    def close(self) -> Iterator[tuple[str, bytes]]:
        if self.kind is not None:
            yield ("middle" if self.kind == "end" else "start"), b"".join(self.held)
        if self.bad:
            yield "bad", b""


def _cut(batches: Iterator[pa.RecordBatch], states: dict):
    cutter, at, out, no = None, None, [], 0

    def flush():
        nonlocal out
        rows, out = out, []
        return pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()))],
            names=["file", "block", "no", "kind", "text"])

    def put(pieces):
        nonlocal no
        for kind, text in pieces:
            out.append((*at, no, kind, text.decode("utf-8", "replace")))
            no += 1

    for batch in batches:
        for file, block, x in _runs(batch):
            if (file, block) != at:
                if cutter is not None:
                    put(cutter.close())
                at, no = (file, block), 0
                if at not in states:
                    raise ValueError(f"the blocks of {file} changed while it was read")
                cutter = _Cutter(*states[at])
            put(cutter.feed(x))
        if out:
            yield flush()
    if cutter is not None:
        put(cutter.close())
    if out:
        yield flush()


def states(pieces: DataFrame) -> DataFrame:
    """``file, block, parity, depth`` at the start of every block, and ``balanced``: does the file end outside of all?"""
    sums = pieces.mapInArrow(_summaries, SUMMARY).groupBy("file", "block").agg(
        *[F.sum(c).alias(c) for c in ("quotes", "outside", "inside")])
    w = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    led = sums.withColumn("parity", F.coalesce(F.sum("quotes").over(w), F.lit(0)) % 2) \
        .withColumn("deeper", F.when(F.col("parity") == 0, F.col("outside")).otherwise(F.col("inside")))
    return led.select("file", "block", "parity", F.coalesce(F.sum("deeper").over(w), F.lit(0)).alias("depth"),
                      ((F.sum("quotes").over(whole) % 2 == 0) & (F.sum("deeper").over(whole) == 0)).alias("balanced"))


def read_json_elements(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Columns ``file``, ``text`` (one element of the file's array; NULL for a file that is not one whole array) of JSON
    files.  A file is read in blocks of ``spark.sql.files.maxPartitionBytes`` by as many tasks; the
    setting (and for small inputs the number of cores) has to stay until the result is written."""
    ensure_checkpoint_dir(spark)
    own = spark.read.option("lineSep", ",").option("recursiveFileLookup", "true") \
        .text([paths] if isinstance(paths, str) else list(paths))
    pieces = own.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    found = states(pieces).collect()
    broken = sorted({r["file"] for r in found if not r["balanced"]})
    known = spark.sparkContext.broadcast({(r["file"], r["block"]): (r["parity"], r["depth"]) for r in found})
    cut = pieces.mapInArrow(lambda batches: _cut(batches, known.value), PIECE)
    whole = cut.where("kind = 'whole'").select("file", "text")
    # One or two pieces a block; names of files that are no array come to the driver, which has listed all names.
    rest = cut.where("kind <> 'whole'").checkpoint()
    lost = sorted({*broken, *(r["file"] for r in rest.where("kind = 'bad'").select("file").distinct().collect())})
    border = rest.where("kind <> 'bad'").withColumn("element", F.sum(F.expr("int(kind = 'start')")).over(
        Window.partitionBy("file").orderBy("block", "no")))
    joined = border.groupBy("file", "element").agg(F.array_sort(F.collect_list(F.struct("block", "no", "text"))).alias("p")) \
        .select("file", F.array_join(F.col("p.text"), "").alias("text")).where(F.trim("text") != "")
    elements = whole.unionByName(joined)
    if lost:
        elements = elements.where(~F.col("file").isin(lost)).unionByName(
            spark.createDataFrame([(f, None) for f in lost], "file string, text string"))
    return elements
