"""N-gram Jaccard join by chosen paths.

A document is the set of its runs of ``n`` words (fewer words: one run of all);
words as in ``words.WORD``, A-Z in lower case.  Documents with equal sets are one
representative with copies; two representatives are linked if the
Jaccard similarity of their sets is at least ``threshold``.

* Each run of the join samples tokens of every set, a token being chosen with
  probability ``per_run / (threshold * size)`` by its hash alone, so similar sets choose
  the same ones; a chosen token is a path of length one, and the sets on a path a bucket.  A
  pair at the threshold misses a run with probability exp(-per_run) at most; runs are
  repeated until the missed share is below 1 - ``recall``.
* Buckets of more than ``SPLIT`` sets (or ``SPLIT_WEIGHT`` tokens) are split again by a second and a
  third chosen token, so sets that share no more than a passage part.  A set whose tokens most of its bucket has stays in the bucket's core instead,
  since no token would separate it from the others.
* Buckets that hold the same sets count once, and buckets with the same smallest set are put together
  (the many buckets of one group of similar sets); small ones share bins of about
  ``BIN`` tokens, and those over the limit are cut into blocks whose pairs are bins.  A bin is
  compared by brute force, as products of token incidence matrices; no pair leaves it:
  it returns links a set has and the smallest set of its local component.  A pair that meets
  in several bins is counted in the smallest of them (each set knows its bins).
* Components come from label propagation with pointer jumping over those local trees.

Tokens are compared as 40-bit hashes of 64-bit window hashes: within a pair of sets with m
tokens each, a false match has probability m*m / 2**40 at most.

Defined results: null, empty and word-less texts have no set, no link and are a class of their own;
repeated rows are copies of each other; ids may be of any type that has an order (a class
of documents with null ids only has a null id); an empty table gives no row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from strata.llm import words as W
from strata.session import ensure_checkpoint_dir

NGRAM = 5
THRESHOLD = 0.8
RECALL = 1 - 1e-5
PER_RUN = 4.0
SPLIT = 4000               # sets of a bucket from which on it is split again
SPLIT_WEIGHT = 4_000_000   # the same in tokens
BLOCK = 1500               # sets of a block; two blocks are compared at a time
WEIGHT = 1_500_000         # tokens of a block
SMALL = 64                 # sets of a bucket that shares a bin
BIN = 600_000              # tokens of a shared bin
DEPTH = 3
CORE, LEAVE = 0.25, 0.6    # shares of common tokens: from CORE on in the core, below LEAVE split on
BROADCAST = 32 << 20       # bytes
SPARSE = 32                # tokens of at most so many sets are counted pair by pair
STRIPE = 256               # rows of a bin's matrix that are judged at a time


def token_sets(raw: np.ndarray, offsets: np.ndarray, n: int) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """Sorted distinct window hashes of each text, some texts at a time."""
    for i, j in W.pieces(offsets):
        words = W.Words(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
        h = words.hashes()
        at, value = words.windows(h, n)
        bounds = np.searchsorted(at, words.first)
        total, inverse = W.prefix_hash(h)
        sets = []
        for k in range(j - i):
            a, b = words.first[k], words.first[k + 1]
            if 0 < b - a < n:
                own = W.mix((total[b:b + 1] - total[a:a + 1]) * inverse[a:a + 1])
            else:
                own = value[bounds[k]:bounds[k + 1]]
            sets.append(np.unique(own))
        yield i, j, sets


def set_key(own: np.ndarray) -> bytes | None:
    """128 bits of a set: two sums over its mixed tokens."""
    if not len(own):
        return None
    a = W.mix(own ^ np.uint64(0x51ED270B9F2D1A35)).sum(dtype=np.uint64)
    b = W.mix(own ^ np.uint64(0x2545F4914F6CDD1D)).sum(dtype=np.uint64)
    return np.array([a, b], dtype=">u8").tobytes()


def chosen(own: np.ndarray, runs: int, per_run: float, threshold: float) -> np.ndarray:
    """The tokens that some run samples."""
    share = min(per_run / (threshold * max(len(own), 1)), 1.0)
    bar = np.uint64(min(int(share * 2.0 ** 64), 2 ** 64 - 1))
    take = np.zeros(len(own), dtype=bool)
    for r in range(runs):
        take |= W.mix(own + W.mix(np.array([r + 1], dtype=np.uint64))) <= bar
    return own[take].view(np.int64)


def _describe(batches, n: int, runs: int, per_run: float, threshold: float):
    for batch in batches:
        raw, offsets = W.text_bytes(batch.column("text"))
        for i, j, sets in token_sets(raw, offsets, n):
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").slice(i, j - i), batch.column("hash").slice(i, j - i),
                 pa.array([set_key(s) for s in sets], pa.binary()),
                 pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([chosen(s, runs, per_run, threshold) for s in sets], pa.list_(pa.int64()))],
                names=["id", "hash", "k", "n", "pool"])
        W.tidy()


def _payload(batches, n: int):
    for batch in batches:
        raw, offsets = W.text_bytes(batch.column("text"))
        for _, _, sets in token_sets(raw, offsets, n):
            short = [np.ascontiguousarray((s >> np.uint64(24)).view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()
                     for s in sets]
            yield pa.RecordBatch.from_arrays(
                [pa.array([set_key(s) for s in sets], pa.binary()), pa.array(short, pa.binary())],
                names=["k", "tokens"])
        W.tidy()


def overlaps(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """How many values any two of n rows share, from (value, row) entries."""
    out = np.zeros((n, n), dtype=np.float32)
    if not len(values):
        return out
    order = np.argsort(values, kind="stable")
    values, rows = values[order], rows[order]
    new = np.concatenate([[True], values[1:] != values[:-1]])
    column = np.cumsum(new) - 1
    size = np.bincount(column)
    often = size > SPARSE
    dense = often[column]
    if dense.any():
        place = np.cumsum(often) - 1
        c, r = place[column[dense]], rows[dense]
        for first in range(0, int(often.sum()), 2048):
            own = (c >= first) & (c < first + 2048)
            m = np.zeros((n, 2048), dtype=np.float32)
            m[r[own], c[own] - first] = 1
            out += m @ m.T
    few = ~dense & (size > 1)[column]
    column, rows = column[few], rows[few]
    flat = out.reshape(-1)
    for d in range(1, SPARSE):
        same = np.flatnonzero(column[d:] == column[:-d])
        if not len(same):
            break
        a, b = rows[same].astype(np.int64), rows[same + d].astype(np.int64)
        np.add.at(flat, a * n + b, 1)
        np.add.at(flat, b * n + a, 1)
    np.fill_diagonal(out, 0)
    return out


def _lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    return column.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(column)), sizes)


def compare(table: pa.Table, threshold: float) -> pa.Table:
    """Links and local component of each set of one bin."""
    _, once = np.unique(np.array(table.column("k").to_pylist(), dtype=object), return_index=True)
    table = table.take(np.sort(once))
    keys = table.column("k").to_pylist()
    count = len(keys)
    tokens = [np.frombuffer(x, np.uint8).reshape(-1, 5) for x in table.column("tokens").to_pylist()]
    size = np.array([len(x) for x in tokens], dtype=np.int64)
    wide = np.zeros((int(size.sum()), 8), dtype=np.uint8)
    np.concatenate(tokens, out=wide[:, :5])
    common = overlaps(wide.view(np.uint64).reshape(-1), np.repeat(np.arange(count), size), count)
    linked = np.empty((count, count), dtype=bool)
    for i in range(0, count, STRIPE):                    # in float64: float32 loses pairs at the threshold
        own = common[i:i + STRIPE].astype(np.float64)
        both = size[i:i + STRIPE, None] + size[None, :]
        linked[i:i + STRIPE] = (own * (1 + threshold) >= threshold * both - 1e-6) & (own > 0)
    del common, wide
    bins, of = _lists(table.column("bins"))
    earlier = bins < table.column("bin")[0].as_py()
    counted = linked & (overlaps(bins[earlier], of[earlier], count) == 0)
    copies = table.column("copies").to_numpy().astype(np.float64)
    label = np.arange(count)
    order = np.argsort(np.array(keys, dtype=object))
    rank = np.empty(count, np.int64)
    rank[order] = np.arange(count)                       # labels are ranks: the smallest key wins
    label = rank.copy()
    some = np.flatnonzero(linked.any(axis=1))
    while len(some):
        least = np.minimum(label[some], np.where(linked[some], label[None, :], count).min(axis=1))
        least = np.minimum(least, label[order[least]])
        if (least == label[some]).all():
            break
        label[some] = least
    return pa.table({"k": pa.array(keys, pa.binary()), "links": pa.array((counted @ copies).astype(np.int64)),
                     "root": pa.array([keys[order[x]] for x in label], pa.binary())})


def _compared(bin_: pa.Table, threshold: float) -> pa.Table:
    out = compare(bin_, threshold)
    W.tidy()
    return out


def _leaves(reps: DataFrame) -> DataFrame:
    """(k, n, leader): the sets to compare; leader is the smallest set on a path."""
    rows = reps.select(F.explode("pool").alias("path"), "k", "n")
    leaves = None
    for depth in range(1, DEPTH + 1):
        buckets = rows.groupBy("path").agg(
            F.count("*").alias("c"), F.sum("n").alias("w"),
            F.min("k").alias("leader"), F.bit_xor(F.xxhash64("k")).alias("x"),
            F.sum(F.shiftright(F.xxhash64("k", F.lit(7)), 24)).alias("s")) \
            .where("c > 1").groupBy("c", "w", "leader", "x", "s").agg(F.min("path").alias("path"))
        rows = rows.join(buckets.select("path", "leader", "c", "w"), "path").checkpoint()
        heavy = (F.col("c") > SPLIT) | (F.col("w") > SPLIT_WEIGHT)
        own = (rows.where(~heavy) if depth < DEPTH else rows).select("k", "n", "leader")
        leaves = own if leaves is None else leaves.unionByName(own)
        rows = rows.where(heavy)
        if depth == DEPTH or rows.isEmpty():
            break
        tokens = rows.join(reps.select("k", "pool"), "k") \
            .select("path", "k", "n", "c", F.explode("pool").alias("token"))
        shares = tokens.groupBy("path", "token").agg(F.count("*").alias("m")).where("m > 1")
        tokens = tokens.join(shares, ["path", "token"], "left").checkpoint()
        alike = tokens.groupBy("path", "k").agg(
            F.avg((F.coalesce("m", F.lit(1)) - 1) / (F.col("c") - 1)).alias("alike"))
        core = rows.select("path", "k", "n").join(alike.where(F.col("alike") >= CORE), ["path", "k"])
        leaders = core.groupBy("path").agg(F.min("k").alias("leader"))
        leaves = leaves.unionByName(core.join(leaders, "path").select("k", "n", "leader"))
        # A third of the tokens, chosen by path and token, lead on.
        rows = tokens.where((F.col("m") > 1) & (F.col("token") != F.col("path"))
                            & (F.pmod(F.xxhash64("path", "token"), F.lit(3)) == 0)) \
            .join(alike.where(F.col("alike") < LEAVE), ["path", "k"]) \
            .select(F.xxhash64("path", "token").alias("path"), "k", "n")
    return leaves


def _bins(leaves: DataFrame) -> DataFrame:
    """(k, bins): where each set is compared."""
    # The buckets of one group of similar sets mostly have the same smallest set: they are one.
    own = leaves.groupBy(F.xxhash64("leader").alias("path"), "k").agg(F.first("n").alias("n")).checkpoint()
    sizes = own.groupBy("path").agg(F.count("*").alias("c"), F.sum("n").alias("w"))
    leaves = own.join(sizes, "path").checkpoint()
    small = (F.col("c") <= SMALL) & (F.col("w") <= BIN // 4)
    weight = leaves.where(small).agg(F.sum("n")).first()[0] or 0
    shared = max(1, -(-weight // BIN))
    blocks = F.when((F.col("c") <= 2 * BLOCK) & (F.col("w") <= 2 * WEIGHT), 1).otherwise(
        F.greatest(F.ceil(F.col("c") / BLOCK), F.ceil(F.col("w") / WEIGHT))).cast("int")
    own = F.pmod(F.xxhash64("k"), blocks.cast("long")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), blocks - 1), lambda j: F.xxhash64(
        "path", F.least(own, j), F.greatest(own, j)))
    return leaves.select("k", F.explode(
        F.when(small, F.array(F.xxhash64(F.pmod(F.col("path"), F.lit(shared))))).otherwise(pairs)).alias("bin")) \
        .groupBy("k").agg(F.sort_array(F.collect_set("bin")).alias("bins"))


def components(trees: DataFrame) -> DataFrame:
    """(k, label): the smallest k of each k's component, from pairs (k, root)."""
    edges = trees.where("k <> root").select("k", F.col("root").alias("other")).distinct()
    edges = edges.unionByName(edges.select(F.col("other").alias("k"), F.col("k").alias("other"))) \
        .distinct().checkpoint()
    labels = edges.groupBy("k").agg(F.min("other").alias("m")) \
        .select("k", F.least("k", "m").alias("label")).checkpoint()
    while True:
        near = edges.join(labels.select(F.col("k").alias("other"), F.col("label").alias("far")), "other") \
            .groupBy("k").agg(F.min("far").alias("far"))
        step = labels.join(near, "k").select("k", F.col("label").alias("old"), F.least("label", "far").alias("label"))
        jump = labels.select(F.col("k").alias("label"), F.col("label").alias("next"))
        step = step.join(jump, "label", "left") \
            .select("k", "old", F.least("label", F.coalesce("next", "label")).alias("label")).checkpoint()
        labels = step.select("k", "label")
        if step.where("old <> label").isEmpty():
            return labels


def _small(df: DataFrame, row_bytes: int) -> DataFrame:
    """A hint to broadcast where the number of rows, counted, allows it."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST else df


def classes(docs: DataFrame, row_id: str = "doc_id", text: str = "text", ngram: int = NGRAM,
            threshold: float = THRESHOLD, recall: float = RECALL, per_run: float = PER_RUN) -> DataFrame:
    """One row per document: ``id``, ``class_id`` (the smallest id of its component of links and copies),
    ``n_links`` (other documents whose sets are similar or equal), ``class_key`` (one value a component;
    null without words), ``hash`` (of the text)."""
    ensure_checkpoint_dir(docs.sparkSession)
    W.bounded(docs.sparkSession)
    runs = max(1, math.ceil(-math.log(1 - recall) / per_run))
    own = docs.select(F.col(row_id).alias("id"), F.col(text).cast("string").alias("text"),
                      F.xxhash64(F.col(text)).alias("hash"))
    kind = T.StructType([T.StructField("id", own.schema["id"].dataType), T.StructField("hash", T.LongType())])
    described = own.mapInArrow(
        lambda b: _describe(b, ngram, runs, per_run, threshold),
        kind.add("k", "binary").add("n", "long").add("pool", T.ArrayType(T.LongType()))).checkpoint()
    reps = described.where("k is not null").groupBy("k").agg(
        F.min("id").alias("rep"), F.count("*").alias("copies"), F.first("n").alias("n"),
        F.first("pool").alias("pool")).checkpoint()
    active = _bins(_leaves(reps)).join(reps.select("k", "rep", "copies"), "k").checkpoint()
    texts = own.join(_small(active.select(F.col("rep").alias("id")).distinct(), 64), "id", "left_semi") \
        .unionByName(own.where("id is null")).drop("hash")
    tokens = texts.select("text").mapInArrow(lambda b: _payload(b, ngram), "k binary, tokens binary")
    compared = tokens.join(_small(active.select("k", "copies", "bins"), 256), "k") \
        .select("k", "copies", "bins", "tokens", F.explode("bins").alias("bin")) \
        .groupBy("bin").applyInArrow(lambda t: _compared(t, threshold), "k binary, links long, root binary") \
        .checkpoint()
    links = compared.groupBy("k").agg(F.sum("links").alias("links"))
    labels = components(compared.select("k", "root"))
    sets = reps.select("k", "rep", "copies").join(links, "k", "left").join(labels, "k", "left") \
        .withColumn("label", F.coalesce("label", "k"))
    names = sets.groupBy("label").agg(F.min("rep").alias("class_id"))
    sets = sets.join(names, "label").select(
        "k", "label", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return described.select("id", "hash", "k").join(sets, "k", "left").select(
        "id", F.when(F.col("k").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.col("label").alias("class_key"), "hash")


def keep_one(docs: DataFrame, row_id: str = "doc_id", **names) -> DataFrame:
    """The documents without all but one of each class: that with the smallest id stays (one of them, if rows
    repeat it; of a class with null ids only, one); documents without words all stay."""
    text = names.get("text", "text")
    found = classes(docs, row_id, **names).where("class_key is not null") \
        .select("class_key", F.struct(F.col("id").isNull().alias("none"), "id", "hash").alias("at")).checkpoint()
    best = found.groupBy("class_key").agg(F.min("at").alias("best"))
    stays = F.col("at").eqNullSafe(F.col("best"))
    judged = found.join(best, "class_key")
    gone = judged.where(~stays).select("at").distinct()
    rows = docs.select(F.struct("*").alias("row"), F.struct(
        F.col(row_id).isNull().alias("none"), F.col(row_id).alias("id"),
        F.xxhash64(F.col(text)).alias("hash")).alias("at"))
    kept = rows.join(_small(gone, 64), "at", "left_anti")
    again = judged.where(stays).groupBy("at").agg(F.count("*").alias("c")).where("c > 1").select("at").checkpoint()
    if again.isEmpty():
        return kept.select("row.*")
    # Rows that repeat both id and text: one of them.
    again = _small(again, 64)
    once = kept.join(again, "at", "left_semi").groupBy("at").agg(F.first("row").alias("row"))
    return kept.join(again, "at", "left_anti").select("row.*").unionByName(once.select("row.*"))
