"""Alignment of two tokenizers' tokens over the same bytes, with corpus-wide link counts.

Tokenizer A is a byte-level BPE vocabulary of the tokenizers library and sees a space and the text;
B is a SentencePiece model and sees the text, before which it puts that space itself.  A token's bytes end
at an offset; where A and B tokens both end the text is cut into groups.  The walk over the two arrays of
ends skips along diagonals: at the current index shift it compares stretches of doubling length, halves
back to the first difference, and so jumps over whole stretches of one-to-one groups; only an irregular group
is resolved token by token, and the shift is what it was plus the difference of its sides (``irregular``).

A space between two characters that are not white space always begins a new token of both (no piece of B
has a space behind something else, which ``Pair`` checks), so the units between such spaces are encoded and
aligned once a batch for each distinct unit, and a text's groups are those of its units one after another.

A link is a pair of an A and a B token whose bytes overlap: the stretches between neighbouring ends of either
kind.  ``score`` counts linked id pairs over the corpus and looks the counts up in blocks of ``BLOCK_PAIRS``
pairs, each one broadcast, one pass a block (there are at most as many pairs as vocabulary sizes multiplied;
usually one block holds them).  Texts pass Python once: what the second pass needs is stored beside the digests.

Defined results: null and empty texts, and texts whose joined token bytes are not the space and the text (those
that hold U+2581, for instance), have no tokens, groups or links; strings of special tokens are plain text; repeated
rows count as often as they come and give repeated results; extra columns pass through in ``row``.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from strata.llm import bpe, words as W
from strata.session import ensure_checkpoint_dir, scratch_path

STEP = 2_000_000           # bytes that share one set of distinct units
BLOCK_PAIRS = 2_000_000    # id pairs with their counts in one broadcast: 34 MB
SPACE = "▁"


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def irregular(ea: list[int], eb: list[int]) -> Iterator[tuple[int, int, int, int]]:
    """Groups that are not one token to one, as (first, last) of A and of B; the last ends are equal."""
    i = j = 0
    n = len(ea)
    while i < n:
        # Jump along the diagonal: doubling stretches, then halves down to the first difference.
        step = 1
        while i < n and ea[i:i + step] == eb[j:j + step]:
            i, j, step = i + step, j + step, 2 * step
        while step > 1:
            step //= 2
            if ea[i:i + step] == eb[j:j + step]:
                i, j = i + step, j + step
        if i >= n:
            return
        a, b = i, j
        while ea[a] != eb[b]:
            if ea[a] < eb[b]:
                a += 1
            else:
                b += 1
        yield i, a, j, b
        i, j = a + 1, b + 1


def _lists(bounds: np.ndarray, values: pa.Array) -> pa.LargeListArray:
    return pa.LargeListArray.from_arrays(pa.array(bounds, pa.int64()), values)


def _bounds(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts)])


class Pair:
    """Both tokenizers, from the text of A's file and the bytes of B's."""

    def __init__(self, vocabulary: str, model: bytes):
        from sentencepiece import SentencePieceProcessor
        self.a = bpe.Codec(vocabulary)
        self.b = SentencePieceProcessor(model_proto=model)
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("a piece goes over a space")
        self.b_bytes = pa.array([bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace(SPACE, " ").encode()
                                 for k, p in enumerate(pieces)], pa.large_binary())
        self.b_sizes = pc.binary_length(self.b_bytes).to_numpy().astype(np.int64)
        self.names = pa.array([str(k) for k in range(max(len(pieces), len(self.a.sizes)))], pa.large_string())

    def b_ids(self, units: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number for each unit, and which units come back byte for byte."""
        got = self.b.encode([u[1:] for u in units.to_pylist()], num_threads=1)
        return np.fromiter(itertools.chain.from_iterable(got), np.int64), np.fromiter(map(len, got), np.int64, len(got))

    def whole(self, ids: np.ndarray, bounds: np.ndarray, units: pa.LargeStringArray) -> np.ndarray:
        """Which units the B tokens' bytes are equal to."""
        joined = pc.binary_join(_lists(bounds, self.b_bytes.take(pa.array(ids))), pa.scalar(b"", pa.large_binary()))
        return pc.equal(joined, units.cast(pa.large_binary())).to_numpy(zero_copy_only=False)

    def align(self, units: pa.LargeStringArray) -> dict:
        """For each distinct unit: numbers of tokens, groups and links, the groups as text and the links."""
        lists = self.a.unit_ids(units)
        a, n_a = lists.flatten().to_numpy().astype(np.int64), np.diff(lists.offsets.to_numpy())
        b, n_b = self.b_ids(units)
        good = self.whole(b, _bounds(n_b), units)
        a, b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)]
        n_a, n_b = np.where(good, n_a, 0), np.where(good, n_b, 0)
        ea, eb = np.cumsum(self.a.sizes[a]), np.cumsum(self.b_sizes[b])
        inner_a, inner_b = [], []
        for i, last_i, j, last_j in irregular(ea.tolist(), eb.tolist()):
            inner_a.extend(range(i, last_i))
            inner_b.extend(range(j, last_j))
        end_a, end_b = np.ones(len(a), dtype=bool), np.ones(len(b), dtype=bool)
        end_a[inner_a] = False
        end_b[inner_b] = False
        n_groups = np.diff(_bounds(end_a)[_bounds(n_a)])

        def side(ids: np.ndarray, end: np.ndarray) -> pa.Array:
            groups = _lists(np.concatenate([[0], np.flatnonzero(end) + 1]), self.names.take(pa.array(ids)))
            return pc.binary_join(groups, pa.scalar(",", pa.large_string()))

        group = pc.binary_join_element_wise(side(a, end_a), side(b, end_b), pa.scalar("|", pa.large_string()))
        ends = np.union1d(ea, eb)
        links = a[np.searchsorted(ea, ends)] * len(self.b_sizes) + b[np.searchsorted(eb, ends)]
        return {"good": good, "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_a + n_b - n_groups, "links": links,
                "groups": pc.binary_join(_lists(_bounds(n_groups), group), pa.scalar(";", pa.large_string()))}


def pack(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted distinct links with their counts: steps between keys, then counts."""
    both = np.concatenate([np.diff(keys, prepend=0), counts]).astype(np.uint64)
    small = both.astype(np.uint32) if not len(both) or both.max() < 1 << 32 else both
    return bytes([small.itemsize]) + len(both).to_bytes(8, "little") + pa.compress(small.tobytes(), codec="zstd", asbytes=True)


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    size, n = data[0], int.from_bytes(data[1:9], "little")
    both = np.frombuffer(pa.decompress(data[9:], n * size, codec="zstd", asbytes=True), f"<u{size}").astype(np.int64)
    return np.cumsum(both[:n // 2]), both[n // 2:]


def _align(batches: Iterator[pa.RecordBatch], vocabulary, model):
    pair = Pair(vocabulary.value, model.value)
    for batch in batches:
        raw, offsets = W.text_bytes(batch.column("text"))
        for i, j in W.pieces(offsets, STEP):
            own, bounds = raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
            full = np.diff(bounds) > 0
            own = np.insert(own, bounds[:-1][full], 0x20)
            bounds = bounds + _bounds(full)
            cuts = bpe.unit_cuts(own, bounds)
            units = pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(own)))
            coded = units.dictionary_encode()
            at = coded.indices.to_numpy().astype(np.int64)
            found = pair.align(coded.dictionary)
            lists = np.searchsorted(cuts, bounds)                       # units before each text
            whole = np.diff(_bounds(found["good"][at])[lists]) == np.diff(lists)
            counts = {n: np.where(whole, np.diff(_bounds(found[n][at])[lists]), 0) for n in ("n_a", "n_b", "n_groups", "n_links")}
            stays = np.repeat(whole, np.diff(lists))
            taken = pa.array(at[stays])
            groups = pc.binary_join(_lists(_bounds(np.where(whole, np.diff(lists), 0)), found["groups"].take(taken)),
                                    pa.scalar(";", pa.large_string()))
            # All links of the piece, by text: one sort counts the distinct ones of each text.
            size = found["n_links"][at[stays]]
            first = _bounds(found["n_links"])[at[stays]]
            place = np.repeat(first - _bounds(size)[:-1], size) + np.arange(size.sum())
            span = len(pair.a.sizes) * len(pair.b_sizes)
            keys = np.sort(np.repeat(np.arange(j - i), counts["n_links"]) * span + found["links"][place])
            new = np.flatnonzero(np.diff(keys, prepend=-1))
            n = np.diff(np.append(new, len(keys)))
            text, keys = np.divmod(keys[new], span)
            where = np.searchsorted(text, np.arange(j - i + 1))
            packed = [pack(keys[x:y], n[x:y]) for x, y in zip(where[:-1].tolist(), where[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row").slice(i, j - i), *(pa.array(counts[n], pa.int64()) for n in counts),
                 groups.cast(pa.string()), pa.array(packed, pa.binary())], names=["row", *counts, "groups", "links"])
        W.tidy()


def align(docs: DataFrame, text: str = "text", vocabulary: str | None = None, model: str | None = None,
          keep: list[str] | None = None) -> DataFrame:
    """Columns ``row`` (the document's columns ``keep``, all by default), ``n_a``, ``n_b``, ``n_groups``, ``n_links``,
    ``groups`` (``a1,a2|b1;a3|b2,b3``) and ``links`` (packed: distinct ``a * (size of B) + b`` with their numbers).

    ``vocabulary`` is a tokenizers JSON file (A) and ``model`` a SentencePiece model (B); the driver reads both."""
    spark = docs.sparkSession
    with open(model or default_model(), "rb") as f:
        shared_model = spark.sparkContext.broadcast(f.read())
    shared = bpe._shared(docs, vocabulary)
    kind = T.StructType([bpe._row(docs, keep), *(T.StructField(n, T.LongType()) for n in ("n_a", "n_b", "n_groups", "n_links")),
                         T.StructField("groups", T.StringType()), T.StructField("links", T.BinaryType())])
    return docs.select(F.struct(*(keep or ["*"])).alias("row"), F.col(text).cast("string").alias("text")) \
        .mapInArrow(lambda batches: _align(batches, shared, shared_model), kind)


def _summed(batches: Iterator[pa.RecordBatch]):
    """The links of a task with their numbers, each key once."""
    keys, counts = np.empty(0, np.int64), np.empty(0, np.int64)
    waiting: list[tuple] = []
    held = 0

    def merged():
        own = np.concatenate([keys, *(k for k, _ in waiting)])
        n = np.concatenate([counts, *(c for _, c in waiting)])
        order = np.argsort(own)
        own = own[order]
        new = np.flatnonzero(np.diff(own, prepend=-1))
        return own[new], np.add.reduceat(n[order], new) if len(new) else n[:0]

    for batch in batches:
        for data in batch.column("links"):
            if data.is_valid:
                waiting.append(unpack(data.as_py()))
                held += len(waiting[-1][0])
                if held > 2_000_000:
                    keys, counts = merged()
                    waiting, held = [], 0
    keys, counts = merged()
    for i in range(0, len(keys), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(keys[i:i + 100_000]), pa.array(counts[i:i + 100_000])], names=["key", "n"])
    W.tidy()


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """Columns ``key``, ``a``, ``b``, ``n`` (links of the pair over all rows) and ``best`` (no pair of this b has more)."""
    sums = aligned.select("links").mapInArrow(_summed, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")) \
        .withColumn("a", F.expr(f"key div {size_b}")).withColumn("b", F.col("key") % size_b)
    most = sums.groupBy(F.col("b").alias("of")).agg(F.max("n").alias("most"))
    return sums.join(most, sums["b"] == most["of"]).select("key", "a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def _look_up(batches: Iterator[pa.RecordBatch], block):
    known, n, best = block.value
    for batch in batches:
        more_best, more_sum = [], []
        for data in batch.column("links"):
            keys, counts = unpack(data.as_py())
            at = np.searchsorted(known, keys)
            at[at == len(known)] = 0
            hit = known[at] == keys if len(known) else np.zeros(len(keys), dtype=bool)
            at, counts = at[hit], counts[hit]
            more_best.append(int(counts[best[at]].sum()))
            more_sum.append(int((counts * n[at]).sum()))
        done = [pc.add(batch.column(c), pa.array(x, pa.int64())) for c, x in (("n_best", more_best), ("count_sum", more_sum))]
        yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("links"), *done],
                                         names=["row", "links", "n_best", "count_sum"])
        W.tidy()


def score(aligned: DataFrame, size_b: int, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """The aligned rows (read several times: store them first) with ``n_best`` (links whose count is the highest of
    their b) and ``count_sum`` (the sum of the counts over the links)."""
    spark = aligned.sparkSession
    rest = [c for c in aligned.columns if c != "links"]
    ensure_checkpoint_dir(spark)
    counted = pair_counts(aligned, size_b).select("key", "n", "best").checkpoint()
    blocks = max(1, -(-counted.count() // block_pairs))
    work = aligned.select(F.struct(*rest).alias("row"), "links", F.lit(0).cast("long").alias("n_best"),
                          F.lit(0).cast("long").alias("count_sum"))
    kind = work.schema
    for k in range(blocks):
        part = counted if blocks == 1 else counted.where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == k)
        table = part.toArrow().combine_chunks().sort_by("key")
        block = spark.sparkContext.broadcast(tuple(table.column(c).to_numpy() for c in ("key", "n", "best")))
        if k:
            work = work.checkpoint()
        work = work.mapInArrow(lambda batches, block=block: _look_up(batches, block), kind)
    return work.select("row.*", "n_best", "count_sum")


def size_of(model: str | None = None) -> int:
    from sentencepiece import SentencePieceProcessor
    return SentencePieceProcessor(model_file=model or default_model()).get_piece_size()


def aligned_and_scored(docs: DataFrame, text: str = "text", vocabulary: str | None = None, model: str | None = None,
                       keep: list[str] | None = None, digest: bool = False, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """``align`` stored in the shared folder, then ``score``.  With ``digest`` the groups are kept as their SHA-256 only
    (``groups_sha256``, empty without tokens)."""
    found = align(docs, text, vocabulary, model, keep)
    if digest:
        sha = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise(F.lit(""))
        found = found.withColumn("groups_sha256", sha).drop("groups")
    path = scratch_path(docs.sparkSession, "aligned")
    found.write.parquet(path)
    return score(docs.sparkSession.read.schema(found.schema).parquet(path), size_of(model), block_pairs)
