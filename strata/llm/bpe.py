"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

A space between two characters that are not white space always begins a new
match of the splitting pattern, so a batch is cut there into units whose
encodings do not depend on their neighbours; the library encodes each distinct
unit of a batch once and Arrow puts the ids of the texts together.  Special
tokens in a text are ordinary text.

Decoding looks up each id's bytes (the vocabulary's characters through the
reversed byte table), joins them and only then reads UTF-8, so a character
split over several tokens comes back whole.  ``offsets`` are character offsets
(first, end) of each token: a token that holds a part of a character's bytes
covers that character.

Defined results: null and empty texts have no tokens; ids outside the vocabulary raise;
repeated rows and extra columns pass through as they are.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from strata.llm import words as W

STEP = 3_000_000         # bytes that share one set of distinct units
CHUNK = 1000             # units encoded as one string


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def byte_table() -> dict[str, int]:
    """The byte of each of the 256 characters that byte-level vocabularies are written in:
    printable bytes stand for themselves, the others for the characters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(rest)}


class Codec:
    """The library's encoder and the bytes of each id, from a vocabulary file's text."""

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"     # a task has one core
        from tokenizers import Tokenizer
        self.encoder = Tokenizer.from_str(vocabulary)
        self.encoder.encode_special_tokens = True
        table = byte_table()
        by_id = {i: bytes(table[c] for c in t) for t, i in json.loads(vocabulary)["model"]["vocab"].items()}
        self.bytes = pa.array([by_id.get(i) for i in range(max(by_id) + 1)], pa.large_binary())
        self.sizes = pc.binary_length(self.bytes).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)

    def ids(self, raw: np.ndarray, offsets: np.ndarray) -> pa.LargeListArray:
        """The ids of each text of one piece."""
        cuts = unit_cuts(raw, offsets)
        units = pa.LargeStringArray.from_buffers(
            len(cuts) - 1, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(raw)))
        coded = units.dictionary_encode()
        own = self.unit_ids(coded.dictionary).take(coded.indices)
        # The units of a text follow each other: only the list bounds change.
        bounds = own.offsets.to_numpy()[np.searchsorted(cuts, offsets)]
        return pa.LargeListArray.from_arrays(pa.array(bounds), own.values)

    def unit_ids(self, units: pa.LargeStringArray) -> pa.LargeListArray:
        """The ids of each unit.  Units that begin with a space before, and end in, something
        that is not white space are encoded many at a time: each is whole again after
        being joined, and the tokens' byte lengths tell where it ends."""
        texts = units.to_pylist()
        joins = np.array([len(x) > 1 and x[0] == " " and not x[1].isspace() and not x[-1].isspace()
                          for x in texts], dtype=bool)
        many, alone = np.flatnonzero(joins), np.flatnonzero(~joins)
        chunks = ["".join(texts[k] for k in many[i:i + CHUNK]) for i in range(0, len(many), CHUNK)]
        got = [np.array(e.ids, np.int32) for e in self.encoder.encode_batch_fast(
            chunks + [texts[k] for k in alone], add_special_tokens=False)]
        flat = np.concatenate(got) if got else np.empty(0, np.int32)
        size = pc.binary_length(units).to_numpy(zero_copy_only=False).astype(np.int64)
        order = np.concatenate([many, alone])               # the order of ``flat``
        ends = np.cumsum(self.sizes[flat])
        stop = np.cumsum(size[order])
        last = np.searchsorted(ends, stop, side="left") + 1
        last[stop == 0] = 0
        if not (ends[last[stop > 0] - 1] == stop[stop > 0]).all():
            raise AssertionError("a token goes over the end of a unit")
        lists = pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], last])), pa.array(flat))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        return lists.take(pa.array(place))

    def decoded(self, ids: pa.LargeListArray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all texts after each other, and the n+1 bounds of the texts."""
        flat = ids.flatten()
        ends = pc.min_max(flat).as_py()
        out = len(flat) > 0 and (ends["min"] is None or ends["min"] < 0 or ends["max"] >= len(self.bytes))
        own = self.bytes.take(flat) if not out else None
        if out or own.null_count:
            raise ValueError("an id is outside the vocabulary")
        _, bounds, data = own.buffers()
        bounds = np.frombuffer(bounds, np.int64)[own.offset:own.offset + len(own) + 1]
        data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
        lists = ids.offsets.to_numpy()
        return data, bounds[lists - lists[0]] if len(own) else np.zeros(len(ids) + 1, np.int64)

    def spans(self, ids: pa.LargeListArray, raw: np.ndarray, offsets: np.ndarray):
        """Character offsets (first, end) of each token within its text."""
        size = self.sizes[ids.flatten().to_numpy()]
        end = np.cumsum(size)
        first = end - size
        char = np.cumsum((raw & 0xC0) != 0x80)              # 1 + the character of each byte
        base = np.repeat(offsets[:-1], np.diff(ids.offsets.to_numpy()))
        before = np.concatenate([[0], char])[base]
        return char[first] - 1 - before, char[end - 1] - before


def unit_cuts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of the units (and the end): every text's start, and each space whose
    neighbours in the text are surely not white space."""
    n = len(raw)
    if n == 0:
        return np.zeros(1, np.int64)
    solid = np.zeros(256, dtype=bool)      # ends or begins a character that is no white space
    solid[0x21:0x7F] = True
    solid[0x80:] = True
    at = np.flatnonzero(raw[1:-1] == 0x20) + 1 if n > 2 else np.empty(0, np.int64)
    a, b = raw[at - 1], raw[np.minimum(at + 1, n - 1)]
    ok = solid[a] & solid[b]
    # Wider white space: C2 85, C2 A0, E1 9A 80, E2 80 xx, E2 81 9F, E3 80 80; whatever
    # shares its first two bytes is left uncut as well.
    wide = np.zeros(1 << 16, dtype=bool)
    wide[[0xC285, 0xC2A0, 0xE19A, 0xE280, 0xE281, 0xE380]] = True
    pair = lambda i: (raw[np.maximum(i, 0)].astype(np.uint16) << 8) | raw[np.minimum(i + 1, n - 1)]
    ok &= ~(wide[pair(at - 2)] | wide[pair(at - 3)] | wide[pair(at + 1)])
    cut = np.zeros(n + 1, dtype=bool)
    cut[offsets] = True
    cut[at[ok]] = True
    return np.flatnonzero(cut)


def _encode(batches: Iterator[pa.RecordBatch], vocabulary, offsets_too: bool):
    codec = Codec(vocabulary.value)
    for batch in batches:
        raw, offsets = W.text_bytes(batch.column("text"))
        for i, j in W.pieces(offsets, STEP):
            own, bounds = raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
            ids = codec.ids(own, bounds)
            out = [batch.column("row").slice(i, j - i), ids.cast(pa.list_(pa.int32()))]
            if offsets_too:
                at = pa.array(ids.offsets.to_numpy().astype(np.int32))
                for x in codec.spans(ids, own, bounds):
                    out.append(pa.ListArray.from_arrays(at, pa.array(x.astype(np.int32))))
            yield pa.RecordBatch.from_arrays(out, names=["row", "ids", "starts", "ends"][:len(out)])
        W.tidy()


def _decode(batches: Iterator[pa.RecordBatch], vocabulary):
    codec = Codec(vocabulary.value)
    for batch in batches:
        ids = batch.column("ids")
        if isinstance(ids, pa.ListArray):
            ids = ids.cast(pa.large_list(ids.type.value_type))
        ids = ids.fill_null([]) if ids.null_count else ids
        for i, j in W.pieces(ids.offsets.to_numpy(), STEP // 3):
            data, bounds = codec.decoded(ids.slice(i, j - i))
            data = data.tobytes()
            texts = [data[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row").slice(i, j - i), pa.array(texts, pa.binary())], names=["row", "bytes"])
        W.tidy()


def _shared(df: DataFrame, vocabulary: str | None):
    W.bounded(df.sparkSession)
    with open(vocabulary or default_vocabulary(), encoding="utf-8") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def _row(df: DataFrame, keep: list[str] | None = None) -> T.StructField:
    return T.StructField("row", df.select(F.struct(*(keep or ["*"])).alias("row")).schema["row"].dataType)


def encode(docs: DataFrame, text: str = "text", vocabulary: str | None = None,
           offsets: bool = False, keep: list[str] | None = None) -> DataFrame:
    """Columns ``row`` (the document's columns ``keep``, all by default) and ``ids`` (array<int>); with ``offsets``
    also ``starts`` and ``ends``, character offsets of each token.

    ``vocabulary`` is a tokenizers JSON file that the driver reads (its size is that
    of a vocabulary, not of the data)."""
    ids = T.ArrayType(T.IntegerType())
    kind = T.StructType([_row(docs, keep), *(T.StructField(n, ids) for n in (
        ("ids", "starts", "ends") if offsets else ("ids",)))])
    shared = _shared(docs, vocabulary)
    return docs.select(F.struct(*(keep or ["*"])).alias("row"), F.col(text).cast("string").alias("text")) \
        .mapInArrow(lambda batches: _encode(batches, shared, offsets), kind)


def decode(tokens: DataFrame, ids: str = "ids", vocabulary: str | None = None,
           keep: list[str] | None = None) -> DataFrame:
    """Columns ``row`` (the input's columns ``keep``, all by default) and ``bytes``, the text that the ids stand for."""
    shared = _shared(tokens, vocabulary)
    kind = T.StructType([_row(tokens, keep), T.StructField("bytes", T.BinaryType())])
    return tokens.select(F.struct(*(keep or ["*"])).alias("row"), F.col(ids).cast("array<int>").alias("ids")) \
        .mapInArrow(lambda batches: _decode(batches, shared), kind)
