"""Ordinal cumulative-link regression on graded ratings.

A document's features are hashed: its words and the runs of other characters between them (each
once, to 2**18 places), and classes of its length, of the share of distinct words and of
the share of capitals.  All grades share one weight vector; ordered thresholds cut its
score: P(grade >= g) = logistic(w . x - b_g), b_1 < b_2 < ...  From these follow the expected
grade and the tail probabilities by which documents are selected.

Fitted by Adam over all gradients of a bounded sample of rated documents (about ``max_rows``, taken by
hash of id from all of them; all if fewer).  Thresholds are kept in order by their
parametrisation (the first, and logarithms of the gaps).

Defined results: null text has no words (its class features remain); documents without a rating are scored but
not learned from; a document rated more than once counts with each rating; null grades are
left out; with no or one grade only, every document gets that grade (0 for none) with certainty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from strata.llm import words as W

PLACES = 1 << 18
MAX_ROWS = 10_000
MIN_SEEN = 5              # sample documents that a place has to occur in to get a weight
EPOCHS = 300
RATE = 0.1
RIDGE = 2e-4
STEP = 3_000_000


def features(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all texts of a piece after each other, sorted and distinct within each text, and n+1 bounds."""
    texts = len(offsets) - 1
    words = W.Words(raw, offsets)
    between = W.Words(raw, offsets, ~W.WORD)
    n_words = np.diff(words.first)
    h = words.hashes()
    place = (h >> np.uint64(46)).astype(np.int64)
    other = ((W.mix(between.hashes() ^ np.uint64(0xA5A5A5A5))) >> np.uint64(46)).astype(np.int64)
    # Classes: length, distinct words of all, capitals of all letters.
    order = np.lexsort((h, words.text))
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (words.text[order][1:] != words.text[order][:-1])
    distinct = np.bincount(words.text[order][new], minlength=texts) / np.maximum(n_words, 1)
    share = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[offsets])
    capital = share((raw >= 65) & (raw <= 90))
    letter = capital + share((raw >= 97) & (raw <= 122))
    classes = [np.minimum(np.log2(n_words + 1).astype(np.int64), 31), 100 + (distinct * 20).astype(np.int64),
               200 + (20 * capital / np.maximum(letter, 1)).astype(np.int64)]
    fixed = np.concatenate([(W.mix(c.astype(np.uint64) ^ np.uint64(0x77770000)) >> np.uint64(46)).astype(np.int64)
                            for c in classes])
    key = np.concatenate([words.text * PLACES + place, between.text * PLACES + other,
                          np.tile(np.arange(texts), 3) * PLACES + fixed])
    key = np.unique(key)
    return key % PLACES, np.searchsorted(key, np.arange(texts + 1) * PLACES)


def _pieces(batch: pa.RecordBatch):
    raw, offsets = W.text_bytes(batch.column("text"))
    for i, j in W.pieces(offsets, STEP):
        yield i, j, *features(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])


def _featured(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for i, j, places, bounds in _pieces(batch):
            yield pa.RecordBatch.from_arrays(
                [batch.column("grade").slice(i, j - i),
                 pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(places.astype(np.int32)))],
                names=["grade", "places"])


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


class Model:
    """Weights, thresholds and grades; score before thresholds is ``w . x``."""

    def __init__(self, grades: list[int], weight: np.ndarray, bars: np.ndarray):
        self.grades, self.weight, self.bars = grades, weight, bars

    def tails(self, places: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """P(grade >= g) of each text, for all grades but the lowest."""
        total = np.concatenate([[0.0], np.cumsum(self.weight[places])])
        return logistic((total[bounds[1:]] - total[bounds[:-1]])[:, None] - self.bars[None, :])


def train(places: np.ndarray, bounds: np.ndarray, grade: np.ndarray) -> Model:
    grades = sorted(set(grade.tolist()))
    if len(grades) < 2:
        return Model(grades or [0], np.zeros(PLACES), np.zeros(0))
    y = np.searchsorted(grades, grade)
    m, n = len(grades) - 1, len(grade)
    often = np.bincount(places, minlength=PLACES)[places] >= min(MIN_SEEN, n)
    places, bounds = places[often], np.concatenate([[0], np.cumsum(often)])[bounds]
    row = np.repeat(np.arange(n), np.diff(bounds))
    w, first, gaps = np.zeros(PLACES), 0.0, np.zeros(m - 1)
    state = [[np.zeros_like(x), np.zeros_like(x)] for x in (w, np.zeros(1), gaps)]
    for t in range(1, EPOCHS + 1):
        bars = first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
        score = np.bincount(row, weights=w[places], minlength=n)
        s = logistic(score[:, None] - bars[None, :])
        # Cumulative link: P(y) = s[y-1] - s[y], with s = 1 below the lowest and 0 above the highest grade.
        wide = np.concatenate([np.ones((n, 1)), s, np.zeros((n, 1))], axis=1)
        p = np.maximum(wide[np.arange(n), y] - wide[np.arange(n), y + 1], 1e-12)
        slope = s * (1 - s)
        at = np.zeros((n, m))
        inner = y > 0
        at[inner, y[inner] - 1] += slope[inner, y[inner] - 1] / p[inner]
        inner = y < m
        at[inner, y[inner]] -= slope[inner, y[inner]] / p[inner]
        by_score = -at.sum(axis=1) / n                     # gradient of the mean negative log-likelihood
        by_bar = at.sum(axis=0) / n
        grads = [np.bincount(places, weights=by_score[row], minlength=PLACES) + RIDGE * w,
                 np.array([by_bar.sum()]),
                 np.array([by_bar[k + 1:].sum() for k in range(m - 1)]) * np.exp(gaps)]
        moves = []
        for (a, b), g in zip(state, grads):
            a[:] = 0.9 * a + 0.1 * g
            b[:] = 0.999 * b + 0.001 * g * g
            moves.append(RATE * (a / (1 - 0.9 ** t)) / (np.sqrt(b / (1 - 0.999 ** t)) + 1e-8))
        w, first, gaps = w - moves[0], first - moves[1][0], gaps - moves[2]
    return Model(grades, w, first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))]))


def fit(docs: DataFrame, ratings: DataFrame, row_id: str = "doc_id", text: str = "text", grade: str = "grade",
        max_rows: int = MAX_ROWS) -> Model:
    """Learns from the rated documents of ``ratings`` (columns ``row_id`` and an integer ``grade``)."""
    rated = ratings.select(F.col(row_id).alias("id"), F.col(grade).cast("int").alias("grade")) \
        .where("grade is not null and id is not null")
    n = rated.count()
    if n > max_rows:
        rated = rated.where(F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit(3)), F.lit(1 << 20))
                            < int((1 << 20) * max_rows / n))
    own = docs.select(F.col(row_id).alias("id"), F.col(text).cast("string").alias("text"))
    # The sample is bounded, so the documents meet it where they are.
    got = own.join(F.broadcast(rated), "id").select("grade", "text") \
        .mapInArrow(_featured, "grade int, places array<int>").toArrow()
    lists = got.column("places").combine_chunks()
    return train(lists.flatten().to_numpy().astype(np.int64), np.concatenate(
        [[0], np.cumsum(np.diff(lists.offsets.to_numpy()))]).astype(np.int64), got.column("grade").to_numpy())


def _scored(batches: Iterator[pa.RecordBatch], shared):
    model = Model(*shared.value)
    grades = np.array(model.grades, dtype=np.float64)
    for batch in batches:
        for i, j, places, bounds in _pieces(batch):
            tails = model.tails(places, bounds)
            expected = grades[0] + tails @ np.diff(grades)
            out = pa.ListArray.from_arrays(
                pa.array(np.arange(0, tails.size + 1, max(tails.shape[1], 1), dtype=np.int32)[:j - i + 1]
                         if tails.shape[1] else np.zeros(j - i + 1, np.int32)), pa.array(tails.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column("row").slice(i, j - i), pa.array(expected), out],
                                             names=["row", "expected_grade", "tails"])


def score(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``row`` (the document's columns ``keep``, all by default), ``expected_grade`` and ``tails``:
    P(grade >= g) for every grade but the lowest, in order."""
    shared = docs.sparkSession.sparkContext.broadcast((model.grades, model.weight, model.bars))
    row = F.struct(*(keep or ["*"])).alias("row")
    kind = T.StructType([T.StructField("row", docs.select(row).schema["row"].dataType),
                         T.StructField("expected_grade", T.DoubleType()),
                         T.StructField("tails", T.ArrayType(T.DoubleType()))])
    return docs.select(row, F.col(text).cast("string").alias("text")) \
        .mapInArrow(lambda batches: _scored(batches, shared), kind)
