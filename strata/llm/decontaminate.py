"""Benchmark decontamination by a broadcast hash set of normalised n-grams.

Words are lower-cased (A-Z) runs of digits, ASCII letters and non-ASCII
characters.  An item's windows are its runs of ``size`` consecutive words (an
item of fewer words, but not none, is one window).  Each task holds the
windows of one block of the benchmark (hash, words, items), hashes every
window of its documents, and compares the words of each hash hit; a document
word inside any occurrence is *hit*.

The broadcast is bounded: the benchmark is cut into blocks of at most
``block_bytes`` of text by item (one item longer than that is a block of its
own) and the documents pass through the blocks one after another, with a
checkpoint between passes, so no pass shuffles and none holds more than a block.  To cut with several
blocks, all mark the uncut text first, it is cut once, and the documents that changed go
through all blocks again until none is hit: the same texts as with one block.

Defined results: a null or word-less document has no words and no hits; a
null or word-less item has no windows; an item with a null id marks words but is
not listed; repeated rows give repeated results; an empty benchmark gives no hits;
columns are taken by the given names and extra columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from strata.llm import words as W
from strata.session import ensure_checkpoint_dir

SIZE = 10
BLOCK_BYTES = 32 << 20
BLOOM_BITS = 20


class Windows:
    """The windows of some items as arrays: for each length sorted hashes, the words of one place each in one text
    buffer, and the items that have it.  About 5 bytes a byte of text."""

    def __init__(self, items: list[tuple[str | None, str]], size: int):
        self.names = [i for i, _ in items]
        raw, offsets = W.text_bytes(pa.array([t for _, t in items], pa.large_string()))
        self.raw = W.lower_ascii(raw)
        starts, ends, found, known = [], [], {}, 0
        for i, j in W.pieces(offsets):
            words = W.Words(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            h = words.hashes()
            other = W.mix(h ^ np.uint64(0x5851F42D4C957F2D))       # windows are told apart by 128 bits
            counts = np.diff(words.first)
            for length in np.unique(np.minimum(counts[counts > 0], size)).tolist():
                at, value = words.windows(h, length)
                _, second = words.windows(other, length)
                own = slice(None) if length == size else counts[words.text[at]] == length
                found.setdefault(length, []).append((value[own], second[own], at[own] + known, words.text[at[own]] + i))
            starts.append(words.start + offsets[i])
            ends.append(words.end + offsets[i])
            known += words.n
        kind = np.int32 if len(raw) < 1 << 31 else np.int64
        self.start, self.end = (np.concatenate([np.empty(0, np.int64), *x]).astype(kind) for x in (starts, ends))
        self.by_length = {}
        for length, parts in found.items():
            value, second, at, item = (np.concatenate(x) for x in zip(*parts))
            order = np.lexsort((item, second, value))
            value, second, at, item = value[order], second[order], at[order], item[order].astype(np.int32)
            new = np.ones(len(value), dtype=bool)
            new[1:] = (value[1:] != value[:-1]) | (second[1:] != second[:-1])
            again = np.zeros(len(value), dtype=bool)
            again[1:] = ~new[1:] & (item[1:] == item[:-1])
            first = np.append(np.cumsum(~again)[new] - 1, np.count_nonzero(~again)).astype(np.int64)
            bloom = np.zeros(1 << BLOOM_BITS, dtype=bool)
            bloom[value >> np.uint64(64 - BLOOM_BITS)] = True
            self.by_length[length] = value[new], at[new].astype(kind), first, item[~again], bloom

    @classmethod
    def of(cls, fields: dict) -> Windows:
        own = cls.__new__(cls)
        vars(own).update(fields)
        return own

    def words(self, at: int, length: int) -> bytes:
        return b" ".join(self.raw[a:b].tobytes() for a, b in zip(self.start[at:at + length].tolist(), self.end[at:at + length].tolist()))

    def hits(self, words: W.Words) -> tuple[np.ndarray, dict[int, set]]:
        """Which words are hit, and the items with occurrences by text number."""
        mark = np.zeros(words.n + 1, dtype=np.int64)
        items: dict[int, set] = {}
        h = words.hashes() if self.by_length else None
        for length, (known, place, first, item, bloom) in self.by_length.items():
            at, value = words.windows(h, length)
            near = np.flatnonzero(bloom[value >> np.uint64(64 - BLOOM_BITS)])
            slot = np.searchsorted(known, value[near])
            same = known[np.minimum(slot, len(known) - 1)] == value[near]
            near, slot = near[same], slot[same]
            for i, k, v in zip(at[near].tolist(), slot.tolist(), value[near].tolist()):
                while k < len(known) and int(known[k]) == v:
                    if words.word_bytes(i, length) == self.words(int(place[k]), length):
                        mark[i] += 1
                        mark[i + length] -= 1
                        items.setdefault(int(words.text[i]), set()).update(item[first[k]:first[k + 1]].tolist())
                        break
                    k += 1
        return np.cumsum(mark[:-1]) > 0, {t: {self.names[x] for x in found} for t, found in items.items()}


def _cut(text: bytes, start: np.ndarray, end: np.ndarray, hit: np.ndarray) -> bytes:
    """The text without the stretches from a run's first hit word to its last."""
    edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    out, last = [], 0
    for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)):
        out.append(text[last:start[a]])
        last = end[b - 1]
    return b"".join([*out, text[last:]])


def _cut_pass(batches: Iterator[pa.RecordBatch], windows: Windows):
    """Cuts hit words of the only block out of the texts."""
    for batch in batches:
        column = batch.column("text")
        raw, offsets = W.text_bytes(column)
        n_words, n_hit, items = [], [], []
        cleaned: dict[int, str] = {}
        for i, j in W.pieces(offsets):
            own = raw[offsets[i]:offsets[j]]
            words = W.Words(own, offsets[i:j + 1] - offsets[i])
            hit, named = windows.hits(words)
            total = np.concatenate([[0], np.cumsum(hit)])
            n_words += np.diff(words.first).tolist()
            n_hit += np.diff(total[words.first]).tolist()
            items += [sorted(x for x in named.get(k, ()) if x is not None) for k in range(j - i)]
            for k in named:
                a, b = words.first[k], words.first[k + 1]
                shift = offsets[i + k] - offsets[i]
                text = own[shift:offsets[i + k + 1] - offsets[i]].tobytes()
                s, e, h = words.start[a:b] - shift, words.end[a:b] - shift, hit[a:b]
                while h.any():      # what closes up after a cut may be a window again
                    text = _cut(text, s, e, h)
                    again = W.Words(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
                    h, _ = windows.hits(again)
                    s, e = again.start, again.end
                cleaned[i + k] = text.decode("utf-8", "replace")
        if cleaned:
            values = column.to_pylist()
            for k, text in cleaned.items():
                values[k] = text
            column = pa.array(values, pa.string())
        out = [batch.column("row"), column.cast(pa.string())]
        n_hit = [a + b for a, b in zip(batch.column("n_hit").to_pylist(), n_hit)]
        yield pa.RecordBatch.from_arrays(
            [*out, pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
             pa.array(items, pa.list_(pa.string())), batch.column("hit").cast(pa.binary())],
            names=["row", "text", "n_words", "n_hit", "items", "hit"])
        W.tidy()


def _mark_pass(batches: Iterator[pa.RecordBatch], windows: Windows):
    """Counts hit words; those of several blocks meet in one bit set a document."""
    for batch in batches:
        raw, offsets = W.text_bytes(batch.column("text"))
        masks = batch.column("hit").to_pylist()
        known = batch.column("items").to_pylist()
        n_words, n_hit, items, bits = [], [], [], []
        for i, j in W.pieces(offsets):
            words = W.Words(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            hit, named = windows.hits(words)
            for k in range(j - i):
                own = hit[words.first[k]:words.first[k + 1]]
                if masks[i + k]:
                    own = own | np.unpackbits(np.frombuffer(masks[i + k], np.uint8),
                                              count=len(own)).astype(bool)
                any_hit = bool(own.any())
                n_words.append(len(own))
                n_hit.append(int(own.sum()) if any_hit else 0)
                bits.append(np.packbits(own).tobytes() if any_hit else None)
                items.append(sorted({*(known[i + k] or ()),
                                     *(x for x in named.get(k, ()) if x is not None)}))
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("text"), pa.array(n_words, pa.int64()),
             pa.array(n_hit, pa.int64()), pa.array(items, pa.list_(pa.string())),
             pa.array(bits, pa.binary())],
            names=["row", "text", "n_words", "n_hit", "items", "hit"])
        W.tidy()


def _cut_marked(batches: Iterator[pa.RecordBatch]):
    """The texts without the words of their bit sets."""
    for batch in batches:
        raw, offsets = W.text_bytes(batch.column("text"))
        masks, out = batch.column("hit").to_pylist(), []
        for i, j in W.pieces(offsets):
            own = raw[offsets[i]:offsets[j]]
            words = W.Words(own, offsets[i:j + 1] - offsets[i])
            for k in range(j - i):
                a, b = words.first[k], words.first[k + 1]
                shift = offsets[i + k] - offsets[i]
                hit = np.unpackbits(np.frombuffer(masks[i + k], np.uint8), count=b - a).astype(bool)
                out.append(_cut(own[shift:offsets[i + k + 1] - offsets[i]].tobytes(), words.start[a:b] - shift,
                                words.end[a:b] - shift, hit).decode("utf-8", "replace"))
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, pa.string())], names=["row", "text"])
        W.tidy()


def _items(benchmark: DataFrame, item: str, text: str, block_bytes: int) -> tuple[DataFrame, int]:
    """The items and the number of blocks they are cut into."""
    own = benchmark.select(F.col(item).cast("string").alias("i"), F.col(text).cast("string").alias("t")) \
        .where(F.col("t").isNotNull())
    total = own.agg(F.sum(F.octet_length("t").cast("long"))).first()[0] or 0
    return own, max(1, -(-2 * total // block_bytes) if total > block_bytes else 1)


def _blocks(own: DataFrame, n: int) -> Iterator[list]:
    """The items, a block at a time."""
    for k in range(n):
        part = own if n == 1 else own.where(F.pmod(F.xxhash64("t"), F.lit(n)) == k)
        yield [(r.i, r.t) for r in part.distinct().collect()]


def _start(docs: DataFrame, text: str) -> DataFrame:
    row = F.struct(F.lit(0).alias(W.free_name(docs.columns)), *[c for c in docs.columns if c != text]).alias("row")
    return docs.select(row, F.col(text).cast("string").alias("text"))


def _run(work: DataFrame, own: DataFrame, n: int, size: int, remove: bool) -> DataFrame:
    """``row`` and ``text`` through all blocks."""
    spark = work.sparkSession
    ensure_checkpoint_dir(spark)
    W.bounded(spark)
    kind = T.StructType([
        T.StructField("row", work.schema["row"].dataType),
        T.StructField("text", T.StringType()), T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()), T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("hit", T.BinaryType())])
    work = work.select(
        "row", "text",
        F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"),
        F.array().cast("array<string>").alias("items"), F.lit(None).cast("binary").alias("hit"))
    for k, block in enumerate(_blocks(own, n)):
        shared = spark.sparkContext.broadcast(vars(Windows(block, size)))
        if remove:
            step = lambda batches, shared=shared: _cut_pass(batches, Windows.of(shared.value))
        else:
            step = lambda batches, shared=shared: _mark_pass(batches, Windows.of(shared.value))
        if k:
            work = work.checkpoint()
        work = work.mapInArrow(step, kind)
    return work


def scan(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
         item_text: str = "text", size: int = SIZE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Columns ``row`` (the document's columns but its text), ``text``, ``n_words``, ``n_hit``, ``items``
    (sorted ids as strings) and ``hit`` (packed bits, one a word; null: no hit)."""
    return _run(_start(docs, text), *_items(benchmark, item, item_text, block_bytes), size, False)


def _rows(docs: DataFrame, text: str) -> list[Column]:
    return [F.col("text").alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns]


def remove_documents(docs: DataFrame, benchmark: DataFrame, max_hit: float = 0.0, text: str = "text",
                     **names) -> DataFrame:
    """The documents whose share of hit words is at most ``max_hit``."""
    return scan(docs, benchmark, text=text, **names) \
        .where(F.col("n_hit") <= F.col("n_words") * F.lit(float(max_hit))).select(*_rows(docs, text))


def remove_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
                 item_text: str = "text", size: int = SIZE,
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents with every hit stretch of words cut out of the text, until no
    window is left; a document that was nothing but benchmark text goes."""
    kept = F.trim(F.regexp_replace("text", r"[\s\p{Punct}]+", " "))
    own, n = _items(benchmark, item, item_text, block_bytes)
    work = _start(docs, text)
    if n == 1:
        out = _run(work, own, n, size, True).where((F.col("n_hit") == 0) | (F.length(kept) > 0))
        return out.select(*_rows(docs, text))
    kind = work.schema
    marked = _run(work, own, n, size, False).checkpoint()
    out = marked.where("n_hit = 0").select("row", "text")
    while not (hit := marked.where("n_hit > 0")).isEmpty():
        # What closes up after a cut may be a window again, of any block.
        marked = _run(hit.select("row", "text", "hit").mapInArrow(_cut_marked, kind), own, n, size, False).checkpoint()
        out = out.unionByName(marked.where((F.col("n_hit") == 0) & (F.length(kept) > 0)).select("row", "text"))
    return out.select(*_rows(docs, text))
