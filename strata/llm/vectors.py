"""Approximate nearest neighbours by learned partitions.

Fit (on a bounded, hash-chosen sample): the exact ``GRAPH_K`` neighbour graph of the sample is
cut into balanced parts (balanced clustering as a start, then moves along graph
edges that keep the sizes within ``SLACK``), and a small classifier (one hidden layer) is
trained to name, for a vector, the parts that hold its neighbours.

Index: every row goes to the part that the classifier finds most probable.  Equal vectors
are one row with their ``k + 1`` smallest ids -- no answer can need more of them --
and parts over ``BLOCK`` rows are cut into blocks, all of which are searched.

Calibration: ``CALIBRATE`` query vectors are compared with all rows, and the fewest parts are
probed that find a share ``recall`` of their true neighbours (vectors without any
structure need most parts; clustered ones a few).

Search: distinct query vectors go to their most probable part, then, with the score that its
answers set as a bar, to the others; within a part and block all rows are ranked by exact inner products
in double precision, and the best of all parts and blocks are kept.  Products are summed in one fixed order, so equal vectors tie exactly.

Defined results: vectors that are null, empty, all zero or hold null, NaN or infinite components take no
part, neither as rows nor as queries; a vector of another length than most
rows have (the smaller of two lengths as frequent) takes no part either; rows with a null id are no candidates; repeated rows
(same id) count once; a query with fewer candidates than k gets all that were found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from strata.session import ensure_checkpoint_dir

SAMPLE = 8192            # most vectors that the partition is learned from
GRAPH_K = 10
PART_ROWS = 1500         # rows aimed at in a part
MAX_PARTS = 64
SLACK = 1.1
BLOCK = 20_000           # rows of a part that are searched in one task
RECALL = 0.95            # share of the true neighbours to find
CALIBRATE = 256          # queries that are compared with all rows to set the number of parts probed
HIDDEN = 128


def balanced(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """A part for each of the sample's vectors; sizes at most SLACK times the mean."""
    rng = np.random.default_rng(seed)
    n, most = len(x), int(np.ceil(SLACK * len(x) / parts))
    centre = x[rng.choice(n, parts, replace=False)]
    part = np.zeros(n, dtype=np.int64)

    def assign(score: np.ndarray) -> np.ndarray:
        # The surest first; a full part passes a vector on to its next choice.
        out, size = np.full(n, -1), np.zeros(parts, dtype=np.int64)
        order = np.argsort(-score, axis=1, kind="stable")
        gain = np.take_along_axis(score, order[:, :1], 1)[:, 0]
        for i in np.argsort(-gain, kind="stable"):
            for p in order[i]:
                if size[p] < most:
                    out[i], size[p] = p, size[p] + 1
                    break
        return out

    for _ in range(4):
        part = assign(x @ centre.T - 0.5 * (centre ** 2).sum(axis=1))
        for p in range(parts):
            if (part == p).any():
                centre[p] = x[part == p].mean(axis=0)
    for _ in range(rounds):                  # towards the part of most neighbours, while sizes allow it
        votes = np.zeros((n, parts), dtype=np.float64)
        np.add.at(votes, (np.repeat(np.arange(n), graph.shape[1]), part[graph].reshape(-1)), 1)
        np.add.at(votes, (graph.reshape(-1), np.repeat(part, graph.shape[1])), 1)
        votes[np.arange(n), part] += 0.5
        new = assign(votes + 1e-3 * (x @ centre.T))
        if (new == part).mean() > 0.999:
            break
        part = new
        for p in range(parts):
            if (part == p).any():
                centre[p] = x[part == p].mean(axis=0)
    return part


def neighbours(x: np.ndarray, k: int) -> np.ndarray:
    """The k rows with the largest inner products with each row, itself left out."""
    out = np.empty((len(x), min(k, len(x) - 1)), dtype=np.int64)
    for i in range(0, len(x), 1024):
        s = x[i:i + 1024] @ x.T
        s[np.arange(len(s)), np.arange(i, i + len(s))] = -np.inf
        out[i:i + 1024] = np.argpartition(-s, out.shape[1] - 1, axis=1)[:, :out.shape[1]]
    return out


def train(x: np.ndarray, target: np.ndarray, epochs: int = 8, seed: int = 7) -> dict[str, np.ndarray]:
    """A network with one hidden layer that gives ``target``, a distribution over parts (Adam, mini-batches)."""
    rng = np.random.default_rng(seed)
    d, parts = x.shape[1], target.shape[1]
    mean, scale = x.mean(axis=0), x.std() + 1e-12
    w = {"a": rng.normal(0, (2 / d) ** 0.5, (d, HIDDEN)), "b": np.zeros(HIDDEN),
         "c": rng.normal(0, (2 / HIDDEN) ** 0.5, (HIDDEN, parts)), "d": np.zeros(parts)}
    m = {k: np.zeros_like(v) for k, v in w.items()}
    v = {k: np.zeros_like(x) for k, x in w.items()}
    z, t = (x - mean) / scale, 0
    for _ in range(epochs):
        order = rng.permutation(len(z))
        for i in range(0, len(z), 256):
            t += 1
            own = z[order[i:i + 256]]
            h = np.maximum(own @ w["a"] + w["b"], 0)
            o = h @ w["c"] + w["d"]
            p = np.exp(o - o.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            e = (p - target[order[i:i + 256]]) / len(own)
            back = (e @ w["c"].T) * (h > 0)
            grad = {"c": h.T @ e, "d": e.sum(axis=0), "a": own.T @ back, "b": back.sum(axis=0)}
            for k, g in grad.items():
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                w[k] -= 2e-3 * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)
    return {**w, "mean": mean, "scale": np.array(scale)}


def route(model: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """Scores of the parts for each vector."""
    z = (x - model["mean"]) / model["scale"]
    return np.maximum(z @ model["a"] + model["b"], 0) @ model["c"] + model["d"]


def usable(v: Column) -> Column:
    """Not null, not empty, not zero, all components there and finite."""
    return v.isNotNull() & (F.size(v) > 0) & F.forall(
        v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))) & F.exists(v, lambda c: c != 0)


def fit(rows: DataFrame, sample: int = SAMPLE, part_rows: int = PART_ROWS) -> dict:
    """The classifier, from ``rows`` (columns ``v``, distinct vectors of one length); at most about ``sample`` of
    them."""
    n = rows.count()
    own = rows.select("v")
    if n > sample:
        own = own.where(F.pmod(F.xxhash64("v", F.lit(11)), F.lit(1 << 20)) < int((1 << 20) * sample / n))
    got = sorted(tuple(r["v"]) for r in own.collect())
    if not got:
        return {"parts": 0, "dim": 0}
    size = len(got[0])
    x = np.array(got, dtype=np.float64).reshape(-1, size)
    parts = int(min(MAX_PARTS, max(1, -(-n // part_rows)), max(1, len(x) // 32)))
    if parts == 1:
        return {"parts": 1, "dim": size}
    graph = neighbours(x, GRAPH_K)
    part = balanced(x, graph, parts)
    target = np.zeros((len(x), parts))
    np.add.at(target, (np.repeat(np.arange(len(x)), graph.shape[1]), part[graph].reshape(-1)), 1)
    target[np.arange(len(x)), part] += 1
    target /= target.sum(axis=1, keepdims=True)
    return {"parts": parts, "dim": size, **train(x, target)}


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _routed(batches: Iterator[pa.RecordBatch], shared, probes: int):
    model = shared.value
    for batch in batches:
        if model["parts"] == 1:
            top = np.zeros((batch.num_rows, 1), dtype=np.int32)
        else:
            score = route(model, _matrix(batch.column("v"), model["dim"]))
            top = np.argsort(-score, axis=1, kind="stable")[:, :probes].astype(np.int32)
        flat = pa.array(top.reshape(-1), pa.int32())
        at = pa.array(np.arange(0, top.size + 1, max(top.shape[1], 1), dtype=np.int32)[:batch.num_rows + 1])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.ListArray.from_arrays(at, flat)], names=[*batch.schema.names, "parts"])


def _nearest(batches: Iterator[pa.RecordBatch], shared, k: int, dim: int):
    """The k best rows of each batch for each calibration query, with their parts."""
    q = shared.value
    own = {v.tobytes(): i for i, v in enumerate(q)}
    for batch in batches:
        x = _matrix(batch.column("v"), dim)
        score = q @ x.T
        for j, v in enumerate(x):
            i = own.get(v.tobytes())
            if i is not None:
                score[i, j] = -np.inf
        top = np.argsort(-score, axis=1, kind="stable")[:, :k]
        part = batch.column("part").to_numpy()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(q)), top.shape[1])),
             pa.array(np.take_along_axis(score, top, 1).reshape(-1)), pa.array(part[top].reshape(-1))],
            names=["i", "score", "part"])


def calibrate(placed: DataFrame, queries: DataFrame, model: dict, k: int, recall: float) -> int:
    """How many parts have to be probed; at most CALIBRATE * k rows come back."""
    if model["parts"] == 1:
        return 1
    got = queries.select("v").orderBy(F.xxhash64("v", F.lit(5)), "v").limit(CALIBRATE).collect()
    if not got:
        return 1
    q = np.array([r["v"] for r in got], dtype=np.float64)
    shared, dim = placed.sparkSession.sparkContext.broadcast(q), model["dim"]
    near = placed.select("v", "part").mapInArrow(
        lambda b: _nearest(b, shared, k, dim), "i long, score double, part int") \
        .withColumn("r", F.row_number().over(Window.partitionBy("i").orderBy(F.desc("score"), "part"))) \
        .where((F.col("r") <= k) & (F.col("score") > float("-inf"))).select("i", "part").collect()
    rank = np.argsort(np.argsort(-route(model, q), axis=1, kind="stable"), axis=1)
    needed = np.bincount([rank[r["i"], r["part"]] for r in near], minlength=model["parts"])
    found = np.cumsum(needed) / max(len(near), 1)
    return int(min(np.searchsorted(found, recall) + 1, model["parts"]))


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k largest scores, largest first, ties to the smaller id."""
    return np.lexsort((ids, -scores))[:k]


def _search(rows: pa.Table, queries: pa.Table, k: int, dim: int) -> pa.Table:
    """Both sides of one part and block: the k best rows of each distinct query vector, as far
    as they reach the query's bar."""
    empty = pa.table({"q": pa.array([], pa.int64()), "id": pa.array([], pa.int64()),
                      "score": pa.array([], pa.float64())})
    if not rows.num_rows or not queries.num_rows:
        return empty
    x = _matrix(rows.column("v"), dim)
    ids = rows.column("ids").combine_chunks()
    counts = np.diff(ids.offsets.to_numpy())
    flat = ids.flatten().to_numpy()
    first = np.concatenate([[0], np.cumsum(counts)])
    q = _matrix(queries.column("v"), dim)
    keys = queries.column("q")
    least = queries.column("bar").to_numpy()
    out_q, out_id, out_score = [], [], []
    for i in range(0, len(q), 512):
        rough = q[i:i + 512] @ x.T
        for j in range(len(rough)):
            own = rough[j]
            # Summation order of a matrix product is not fixed: take all that may be among the best.
            bar = np.partition(own, len(own) - k)[len(own) - k] if len(own) > k else -np.inf
            bar = max(bar, least[i + j])
            near = np.flatnonzero(own >= bar - 1e-9 * max(1.0, abs(bar)) if np.isfinite(bar) else own > -np.inf)
            if not len(near):
                continue
            exact = exact_products(x[near], q[i + j])
            exact = np.repeat(exact, counts[near])
            mine = np.concatenate([flat[first[p]:first[p + 1]] for p in near])
            top = best(exact, mine, k)
            out_q.append(np.full(len(top), i + j))
            out_id.append(mine[top])
            out_score.append(exact[top])
    if not out_q:
        return empty
    return pa.table({"q": keys.take(pa.array(np.concatenate(out_q))), "id": pa.array(np.concatenate(out_id)),
                     "score": pa.array(np.concatenate(out_score))})


def exact_products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products, summed component after component."""
    total = np.zeros(len(x))
    for c in range(x.shape[1]):
        total += x[:, c] * q[c]
    return total


def search(rows: DataFrame, queries: DataFrame, k: int = 20, row_id: str = "vec_id", vector: str = "embedding",
           sample: int = SAMPLE, part_rows: int = PART_ROWS, recall: float = RECALL, block: int = BLOCK,
           exact: bool = False) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest rows (largest inner product) found for each query,
    the query's own id left out.  ``exact`` searches every part (for measuring recall)."""
    ensure_checkpoint_dir(rows.sparkSession)
    spark = rows.sparkSession
    pick = lambda df: df.select(F.col(row_id).cast("long").alias("id"), F.col(vector).alias("v")) \
        .where(usable(F.col("v")) & F.col("id").isNotNull())
    # The k + 1 smallest ids of each distinct vector; the limit by rank works before the shuffle too.
    by_vector = Window.partitionBy("v").orderBy("id")
    base = pick(rows).distinct().withColumn("r", F.row_number().over(by_vector)).where(F.col("r") <= k + 1) \
        .groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).checkpoint()
    lengths = base.select(F.size("v").alias("n")).distinct().limit(2).collect()
    if len(lengths) > 1:                     # that of most rows, copies counted
        lengths = pick(rows).groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
        base = base.where(F.size("v") == lengths[0]["n"])
    model = fit(base, sample, part_rows)
    if not model["dim"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    shared = spark.sparkContext.broadcast(model)
    element = rows.schema[vector].dataType.simpleString()
    fits = F.size("v") == model["dim"]
    placed = base.where(fits).mapInArrow(
        lambda b: _routed(b, shared, 1), f"v {element}, ids array<bigint>, parts array<int>") \
        .select("v", "ids", F.col("parts")[0].alias("part")).checkpoint()
    asked = pick(queries).where(fits).select("id", "v").distinct().withColumn("q", F.xxhash64("v")).checkpoint()
    m = model["parts"] if exact else calibrate(placed, asked, model, k, recall)
    blocks = placed.groupBy("part").agg(F.ceil(F.count("*") / block).alias("blocks"))    # one row a part
    placed = placed.join(F.broadcast(blocks), "part").select(
        "part", F.pmod(F.xxhash64("v"), F.col("blocks")).alias("block"), "v", "ids")
    distinct = asked.dropDuplicates(["v"]).select("q", "v").mapInArrow(
        lambda b: _routed(b, shared, m), f"q long, v {element}, parts array<int>").checkpoint()
    dim = model["dim"]

    def among(questions: DataFrame) -> DataFrame:
        questions = questions.join(F.broadcast(blocks), "part").select(
            "q", "v", "bar", "part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
        return placed.groupBy("part", "block").cogroup(questions.groupBy("part", "block")).applyInArrow(
            lambda key, a, b: _search(a, b, k + 1, dim), "q long, id long, score double")

    # The most probable part first: what it finds is a bar for all others.
    first = among(distinct.select("q", "v", F.col("parts")[0].alias("part"),
                                  F.lit(float("-inf")).alias("bar"))).checkpoint()
    bars = first.groupBy("q").agg(F.count("*").alias("c"), F.min("score").alias("bar")) \
        .where(F.col("c") > k).select("q", "bar")
    rest = distinct.select("q", "v", F.explode(F.slice("parts", 2, max(m - 1, 1))).alias("part")) \
        .join(bars, "q", "left").select("q", "v", "part", F.coalesce("bar", F.lit(float("-inf"))).alias("bar"))
    nearest = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    found = first.unionByName(among(rest)) \
        .withColumn("r", F.row_number().over(nearest)).where(F.col("r") <= k + 1).checkpoint()
    own = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return asked.select(F.col("id").alias("query_id"), "q").join(found, "q") \
        .where(F.col("query_id") != F.col("id")) \
        .select("query_id", F.col("id").alias("vec_id"), "score") \
        .withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
