"""Language identification of mixed-language text.

Words are runs between white space, in lower case.  A word's script (fixed
Unicode ranges) narrows its candidates to the languages that were seen in that script
in training; its score for each candidate is the log-probability of its letter
trigrams (with its edges) under that language, trigrams hashed to 2**16 counts
with add-``SMOOTH`` estimates.  Viterbi over a document's words, with a
penalty for each switch of language, labels spans.  A document's language is the
one with the most labelled letters, its score that language's share of them.

Training counts come from a bounded sample of labelled rows (an even share of about ``max_rows`` for each
language, ``FEW`` at least, taken by hash of id; all if fewer); the counts of one language are 2**16 numbers, so what
reaches the driver is bounded by the number of languages.

Defined results: null text and text without a letter are ``und`` with score 0; rows
with null language, and labels beyond the ``MAX_LABELS`` most frequent ones, are not learned from; a document all of whose letters are of scripts
that no language was seen in gets the language with most training letters and score 0;
ties go to the language first in order; without any training row all is ``und``.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from strata.llm import words as W

BUCKETS = 1 << 16
SMOOTH = 0.5
PENALTY = 4.0            # log-probability lost with each switch
SEEN = 0.005             # share of a language's letters that makes a script one of its own
MAX_ROWS = 20_000
MAX_LABELS = 1_000
FEW = 1_000              # rows to learn a language from, however many languages there are
STEP = 1_000_000         # bytes worked on at a time
SCORES = 4_000_000       # trigram scores looked up at a time

# Script ranges of Unicode (first and last code point).
SCRIPTS = [
    ("latin", 0x41, 0x24F), ("greek", 0x370, 0x3FF), ("cyrillic", 0x400, 0x52F),
    ("armenian", 0x530, 0x58F), ("hebrew", 0x590, 0x5FF), ("arabic", 0x600, 0x6FF),
    ("arabic", 0x750, 0x77F), ("devanagari", 0x900, 0x97F), ("bengali", 0x980, 0x9FF),
    ("gurmukhi", 0xA00, 0xA7F), ("gujarati", 0xA80, 0xAFF), ("tamil", 0xB80, 0xBFF),
    ("telugu", 0xC00, 0xC7F), ("kannada", 0xC80, 0xCFF), ("malayalam", 0xD00, 0xD7F),
    ("thai", 0xE00, 0xE7F), ("lao", 0xE80, 0xEFF), ("georgian", 0x10A0, 0x10FF),
    ("hangul", 0x1100, 0x11FF), ("ethiopic", 0x1200, 0x137F), ("khmer", 0x1780, 0x17FF),
    ("latin", 0x1E00, 0x1EFF), ("greek", 0x1F00, 0x1FFF), ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x4DBF), ("han", 0x4E00, 0x9FFF), ("hangul", 0xAC00, 0xD7AF),
    ("han", 0x20000, 0x2FA1F),
]
SCRIPT_NAMES = list(dict.fromkeys(n for n, _, _ in SCRIPTS)) + ["other"]


def character_table() -> np.ndarray:
    """For each code point: 0 no letter, else 1 + the number of its script."""
    letter = np.fromiter((unicodedata.category(chr(c))[0] in "LM" for c in range(sys.maxunicode + 1)),
                         dtype=bool, count=sys.maxunicode + 1)
    script = np.full(sys.maxunicode + 1, len(SCRIPT_NAMES), dtype=np.uint8)
    for name, a, b in SCRIPTS:
        script[a:b + 1] = SCRIPT_NAMES.index(name) + 1
    return np.where(letter, script, 0).astype(np.uint8)


class Features:
    """The words with letters of some texts: text, script, letters and trigram buckets."""

    def __init__(self, texts: list[str], table: np.ndarray):
        texts = [x.lower() for x in texts]
        joined = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "replace"), np.uint32)
        kind = table[joined]
        ends = np.cumsum(np.fromiter((len(x) + 1 for x in texts), np.int64, len(texts))) - 1
        space = (joined == 32) | ((joined >= 9) & (joined <= 13)) | (joined == 0xA0) | (joined == 0x3000)
        space[ends] = True
        n = len(joined)
        solid = np.concatenate([[False], ~space, [False]])
        start = np.flatnonzero(solid[1:] & ~solid[:-1])[:n]
        end = np.flatnonzero(solid[:-1] & ~solid[1:])
        is_letter = kind > 0
        letters = np.concatenate([[0], np.cumsum(is_letter)])
        count = letters[end] - letters[start]
        keep = count > 0
        start, end, self.letters = start[keep], end[keep], count[keep]
        self.text = np.searchsorted(ends, start)
        self.n = len(start)
        if not self.n:
            self.script = np.empty(0, np.int64)
            return
        # A word's script is that of its first letter.
        at = np.flatnonzero(is_letter)
        self.script = kind[at[letters[start]]].astype(np.int64) - 1
        # Letters only, an edge mark before and after each word: what stands between goes.
        number = np.repeat(np.arange(self.n), self.letters)
        size = self.letters + 2
        first = np.cumsum(size) - size
        chars = np.zeros(int(size.sum()), dtype=np.uint64)
        rank = np.arange(len(number)) - np.repeat(np.cumsum(self.letters) - self.letters, self.letters)
        chars[first[number] + 1 + rank] = joined[at]
        # A trigram is centred on each letter.
        centre = first[number] + 1 + rank
        value = (chars[centre - 1] << np.uint64(42)) | (chars[centre] << np.uint64(21)) | chars[centre + 1]
        self.bucket = (W.mix(value) >> np.uint64(48)).astype(np.int64)
        self.word = number
        self.first = np.cumsum(self.letters) - self.letters


class Model:
    """Log-probabilities (bucket x language), and which languages use a script."""

    def __init__(self, langs: list[str], counts: np.ndarray, scripts: np.ndarray):
        self.langs = langs
        total = counts.sum(axis=0)
        self.log = np.log((counts + SMOOTH) / (total + SMOOTH * BUCKETS)).astype(np.float32)
        share = scripts / np.maximum(scripts.sum(axis=0), 1)
        self.allowed = share >= SEEN                      # script x language
        self.main = int(np.argmax(total)) if langs else 0
        self.table = character_table()

    def label(self, texts: list[str], penalty: float) -> tuple[Features, np.ndarray]:
        """The words of the texts and the language number of each (-1: no candidate)."""
        words = Features(texts, self.table)
        if not words.n:
            return words, np.empty(0, np.int64)
        score = np.empty((words.n, len(self.langs)), np.float32)
        rows = max(1, SCORES // len(self.langs))
        for a, b in _ranges(words.first, len(words.bucket), rows):
            stop = words.first[b] if b < words.n else len(words.bucket)
            own = self.log[words.bucket[words.first[a]:stop]]
            score[a:b] = np.add.reduceat(own, words.first[a:b] - words.first[a], axis=0)
        allowed = self.allowed[words.script]
        some = allowed.any(axis=1)
        score = np.where(allowed, score, np.float32(-1e4))
        score[~some] = 0.0
        return words, np.where(some, viterbi(score, words.text, penalty), -1)


def _ranges(first: np.ndarray, total: int, rows: int) -> Iterator[tuple[int, int]]:
    """Ranges of words that have about ``rows`` trigrams together."""
    a, n = 0, len(first)
    while a < n:
        b = max(a + 1, int(np.searchsorted(first, first[a] + rows)))
        yield a, b
        a = b


def viterbi(score: np.ndarray, text: np.ndarray, penalty: float) -> np.ndarray:
    """Best language of each word; all texts take each step together, longest first."""
    n, k = score.shape
    first = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
    length = np.diff(np.concatenate([first, [n]]))
    order = np.argsort(-length, kind="stable")
    first, length = first[order], length[order]
    back = np.zeros((n, k), dtype=np.int16)
    best = score[first].astype(np.float64)
    active = np.searchsorted(-length, -np.arange(1, int(length[0]) + 1), side="right")
    for t in range(1, int(length[0])):
        m = active[t]
        own = best[:m]
        top = own.argmax(axis=1)
        most = own[np.arange(m), top][:, None] - penalty
        stay = own >= most
        back[first[:m] + t] = np.where(stay, np.arange(k), top[:, None])
        best[:m] = np.where(stay, own, most) + score[first[:m] + t]
    out = np.empty(n, dtype=np.int64)
    state = best.argmax(axis=1)
    for t in range(int(length[0]) - 1, -1, -1):
        m = active[t]
        at = first[:m] + t
        out[at] = state[:m]
        state[:m] = back[at, state[:m]]
    return out


def _texts(batch: pa.RecordBatch, name: str) -> Iterator[tuple[int, list[str]]]:
    """First row and texts of each stretch of about STEP bytes; null is empty.  Only a stretch at a time is Python's."""
    column = batch.column(name)
    _, offsets = W.text_bytes(column)
    for i, j in W.pieces(offsets, STEP):
        yield i, [x or "" for x in column.slice(i, j - i).to_pylist()]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = character_table()
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for first, texts in _texts(batch, "text"):
            words = Features(texts, table)
            if not words.n:
                continue
            own = np.array(langs[first:first + len(texts)])[words.text]
            for lang in np.unique(own):
                is_own = own == lang
                c = counts.setdefault(str(lang), np.zeros(BUCKETS + len(SCRIPT_NAMES), np.int64))
                c[:BUCKETS] += np.bincount(words.bucket[is_own[words.word]], minlength=BUCKETS)
                c[BUCKETS:] += np.bincount(words.script[is_own], weights=words.letters[is_own],
                                           minlength=len(SCRIPT_NAMES)).astype(np.int64)
    for lang, c in counts.items():
        at = np.flatnonzero(c)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(c[at], pa.int64())],
            names=["lang", "at", "n"])


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", row_id: str = "doc_id",
        max_rows: int = MAX_ROWS) -> Model:
    """Learns from the labelled rows of ``docs``: of each language at most about its share of ``max_rows`` (or
    ``FEW``), those whose id hashes lowest (so every part of the table is met)."""
    W.bounded(docs.sparkSession)
    own = docs.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"),
                      F.xxhash64(F.col(row_id).cast("string")).alias("h")) \
        .where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    # Of dirty columns the most frequent labels only, so what is learned stays bounded.
    most_frequent = own.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "lang").limit(MAX_LABELS)
    sizes = {r["lang"]: r["n"] for r in most_frequent.collect()}
    own = own.where(F.col("lang").isin(list(sizes)))
    most = max(max_rows // max(len(sizes), 1), FEW)
    bars = {k: max(1, (1 << 40) * most // n) for k, n in sizes.items() if n > most}
    if bars:
        bar = F.try_element_at(F.create_map(*(F.lit(x) for pair in bars.items() for x in pair)), F.col("lang"))
        own = own.where(bar.isNull() | (F.pmod("h", F.lit(1 << 40)) < bar))
    got = own.select("text", "lang").mapInArrow(_counts, "lang string, at long, n long") \
        .groupBy("lang", "at").agg(F.sum("n").alias("n")) \
        .groupBy("lang").agg(F.collect_list("at").alias("at"), F.collect_list("n").alias("n")) \
        .orderBy("lang").collect()
    counts = np.zeros((BUCKETS + len(SCRIPT_NAMES), len(got)), dtype=np.int64)
    for k, row in enumerate(got):
        counts[row["at"], k] = row["n"]
    return Model([r["lang"] for r in got], counts[:BUCKETS], counts[BUCKETS:])


def _predict(batches: Iterator[pa.RecordBatch], shared, penalty: float, spans: bool, with_text: bool = False):
    model = Model.__new__(Model)
    vars(model).update(shared.value)
    n_langs = max(len(model.langs), 1)
    for batch in batches:
        for first, texts in _texts(batch, "text"):
            if model.langs:
                words, label = model.label(texts, penalty)
                known = label >= 0
                of = np.bincount(words.text[known] * n_langs + label[known], weights=words.letters[known],
                                 minlength=len(texts) * n_langs).reshape(len(texts), n_langs)
                total = np.bincount(words.text, weights=words.letters, minlength=len(texts))
            else:
                of, total = np.zeros((len(texts), 1)), np.zeros(len(texts))
            lang, score = [], []
            # Without any language learned, each text with a letter may be in one.
            share = of.sum(axis=1) / np.maximum(total, 1) if model.langs else np.ones(len(texts))
            for k, text in enumerate(texts):
                if not total[k] or not any(map(str.isalpha, text)):
                    lang.append("und")
                    score.append(0.0)
                elif not of[k].any():
                    lang.append(model.langs[model.main])
                    score.append(0.0)
                else:
                    top = int(of[k].argmax())
                    lang.append(model.langs[top])
                    score.append(float(of[k, top] / total[k]))
            out = [batch.column(k).slice(first, len(texts)) for k in (("row", "text") if with_text else ("row",))]
            out += [pa.array(lang, pa.string()), pa.array(score, pa.float64())]
            if spans:
                out.append(pa.array(_spans(words, label, model.langs, len(texts))
                                    if model.langs else [[] for _ in texts],
                                    pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int64()),
                                                        ("letters", pa.int64())]))))
            if with_text:
                letters = [any(map(str.isalpha, x)) for x in texts]
                out += [pa.array(letters, pa.bool_()), pa.array(share, pa.float64())]
            names = ["row", *["text"] * with_text, "lang_pred", "score", *["spans"] * spans,
                     *["letter", "known"] * with_text]
            yield pa.RecordBatch.from_arrays(out, names=names)
        W.tidy()


def _spans(words: Features, label: np.ndarray, langs: list[str], n: int) -> list[list[dict]]:
    out: list[list[dict]] = [[] for _ in range(n)]
    if not words.n:
        return out
    new = np.flatnonzero(np.concatenate([[True], (label[1:] != label[:-1]) | (words.text[1:] != words.text[:-1])]))
    letters = np.add.reduceat(words.letters, new)
    for a, b, m in zip(new, [*new[1:], words.n], letters):
        out[words.text[a]].append({"lang": langs[label[a]] if label[a] >= 0 else "und",
                                   "words": int(b - a), "letters": int(m)})
    return out


def predict(docs: DataFrame, model: Model, text: str = "text", penalty: float = PENALTY,
            spans: bool = False, keep: list[str] | None = None) -> DataFrame:
    """Columns ``row`` (the document's columns ``keep``, all by default), ``lang_pred`` and ``score``;
    with ``spans`` also the labelled spans: language, words with letters, letters."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))
    row = F.struct(*(keep or ["*"])).alias("row")
    kind = T.StructType([T.StructField("row", docs.select(row).schema["row"].dataType),
                         T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    if spans:
        span = T.StructType().add("lang", T.StringType()).add("words", T.LongType()).add("letters", T.LongType())
        kind = kind.add("spans", T.ArrayType(span))
    return docs.select(row, F.col(text).cast("string").alias("text")) \
        .mapInArrow(lambda batches: _predict(batches, shared, penalty, spans), kind)


def reject(docs: DataFrame, model: Model, min_score: float = 0.0, text: str = "text", lang: str = "lang",
           penalty: float = PENALTY) -> DataFrame:
    """The documents that have a letter and at least a share ``min_score`` of their letters in words labelled with some
    language (mixed texts count all their languages); each with a letter if no language was learned.  A null
    ``lang`` (where there is that column) becomes the predicted language."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))
    # The text goes to the tasks and back once, beside the other columns.
    own = docs.select(F.struct(F.lit(0).alias(W.free_name(docs.columns)), *[c for c in docs.columns if c != text]).alias("row"),
                      F.col(text).cast("string").alias("text"))
    kind = T.StructType([*own.schema.fields, T.StructField("lang_pred", T.StringType()),
                         T.StructField("score", T.DoubleType()), T.StructField("letter", T.BooleanType()),
                         T.StructField("known", T.DoubleType())])
    found = own.mapInArrow(lambda batches: _predict(batches, shared, penalty, False, True), kind)
    said = F.when(F.col("lang_pred") != "und", F.col("lang_pred"))
    columns = {text: F.col("text")}
    if lang in docs.columns and lang != text and isinstance(docs.schema[lang].dataType, T.StringType):
        columns[lang] = F.coalesce(F.col("row")[lang], said)
    return found.where(F.col("letter") & (F.col("known") >= min_score)).select(
        *[columns.get(c, F.col("row")[c]).alias(c) for c in docs.columns])
