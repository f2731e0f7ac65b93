"""Whole-batch word segmentation and hashing with numpy.

A batch of texts is one byte array; words are found, hashed and grouped into
windows by array operations, so no Python code runs per word.  Hashes are 64
bits (a polynomial over the bytes modulo 2**64, then mixed); whoever needs
certainty compares the bytes (``word_bytes``).
"""

from __future__ import annotations

import ctypes
import gc
import re

import numpy as np
import pyarrow as pa

U = np.uint64
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 2 ** 64)
BATCH = 8 << 20           # bytes of rows that go to Python at a time
STEP = 2_000_000          # bytes segmented at a time; a longer text goes alone


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept for the next piece, unless a long text needs more than usual."""
    if base not in _powers or len(_powers[base]) < n:
        out = np.full(max(n, 1), base, dtype=np.uint64)
        out[0] = 1
        np.multiply.accumulate(out, out=out)
        if n > STEP + 1:
            return out
        _powers[base] = out
    return _powers[base][:n]


def prefix_hash(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums that give the hash of any run of ``values`` by one subtraction."""
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.multiply(values, powers(BASE, len(values)), out=total[1:])
    np.cumsum(total, out=total)
    return total, powers(INVERSE, len(values) + 1)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n+1 offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None or len(off) == 0:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[off[0]:off[-1]]
    return raw, off - off[0]


def bounded(spark) -> None:
    """From now on the session sends its rows to Python in batches of ``BATCH`` bytes instead of 64 MB or 10,000 rows: a
    task holds a batch several times on either side.  A smaller setting stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    number, unit = re.fullmatch(r"(\d+)\s*([a-z]?).*", spark.conf.get(key).strip().lower()).groups()
    if int(number) << {"k": 10, "m": 20, "g": 30, "t": 40}.get(unit, 0) > BATCH:
        spark.conf.set(key, str(BATCH))


def tidy() -> None:
    """Give memory back to the system: a worker waits for its next task with it.  What an earlier task's functions
    held (their tables too) is garbage in cycles; Arrow's pool and the C library keep freed pages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass                             # not that C library: its pages stay


def free_name(columns: list[str]) -> str:
    """A column name that none of ``columns`` has."""
    name = "_"
    while name in columns:
        name += "_"
    return name


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table[raw]


# Bytes of a word: digits, ASCII letters and everything outside ASCII.
WORD = np.zeros(256, dtype=bool)
WORD[0x30:0x3A] = WORD[0x41:0x5B] = WORD[0x61:0x7B] = WORD[0x80:] = True
# Bytes of a word between white space.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, 9, 10, 11, 12, 13]] = False


def pieces(offsets: np.ndarray, step: int = STEP):
    """Ranges (first, last) of texts that hold about ``step`` bytes together."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + step, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


class Words:
    """Words of the texts of one piece: byte ranges, text number, hash."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, kind: np.ndarray = WORD, fold: bool = True):
        if fold:
            raw = lower_ascii(raw)
        n = len(raw)
        inside = np.zeros(n + 2, dtype=np.int8)
        inside[1:-1] = kind[raw]
        # A text's first byte starts a word of its own even next to another text.
        edge = np.diff(inside)
        start, end = edge[:-1] == 1, edge == -1
        cut = offsets[1:-1]
        cut = cut[(cut > 0) & (cut < n)]
        cut = cut[(inside[cut] == 1) & (inside[cut + 1] == 1)]
        start[cut] = True
        end[cut] = True
        self.raw = raw
        self.start = np.flatnonzero(start)
        self.end = np.flatnonzero(end)
        self.text = np.searchsorted(offsets, self.start, side="right") - 1
        self.first = np.searchsorted(self.start, offsets)      # words before each text
        self.n = len(self.start)

    def hashes(self) -> np.ndarray:
        total, inverse = prefix_hash(self.raw.astype(np.uint64) + U(1))
        value = (total[self.end] - total[self.start]) * inverse[self.start]
        return mix(value ^ ((self.end - self.start).astype(np.uint64) << U(56)))

    def windows(self, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First words of all windows of ``size`` words within a text, and their hashes."""
        at = np.arange(max(self.n - size + 1, 0))
        at = at[self.text[at] == self.text[at + size - 1]] if len(at) else at
        total, inverse = prefix_hash(hashes)
        return at, mix((total[at + size] - total[at]) * inverse[at])

    def word_bytes(self, i: int, size: int = 1) -> bytes:
        """The words i .. i+size-1 joined by one space."""
        return b" ".join(self.raw[self.start[k]:self.end[k]].tobytes()
                         for k in range(i, i + size))
