"""Substring deduplication: words of passages that already stand earlier, by FM-indexes over shards.

Words are maximal runs without ASCII white space, unchanged.  A window of ``SIZE`` consecutive words of
one document is a repeat if its words also start earlier: in a document of smaller id, or earlier in the
same one.  Words that a repeat covers are removed; all windows are judged on the input.

* A window chooses its smallest run of ``GRAM`` words by hash, so equal windows choose the same run.  The windows of
  a text around one chosen run are a segment (15 windows and 34 words at most); its run sends it to a shard, where all
  windows equal to its own meet.  Runs that would fill half a task's part (``hot_grams``, counted over all texts) are never
  chosen; a window of nothing else goes by the hash of all its words.  So no shard holds more than its part, however
  often a line or passage stands in the corpus: of equal segments a task sends the first only.
* Keys and places are sent first; only segments whose run stands in another one too send their words (``_match``).
* A shard puts its distinct segments, in the order of documents, into one text of word numbers and builds a compressed
  FM-index on it: the suffixes ordered by their first 20 words and then by position, the word before each of them in a
  wavelet matrix of bit vectors with rank counts.  Every segment is streamed through it by backward search: a first search
  leaves out segments of which a few words stand nowhere else; the others get the matching statistics of every end,
  one backward step and one cut to 19 words a window.  The first suffix of a window's interval is its earliest place.
* The intervals above the threshold go back to their documents, which are joined once and cut.

Documents are ordered by id, and rows of one id by a hash of their text.  Words are compared by 64-bit hashes, segments word
by word of those.

Defined results: a null text has no words; a null id comes before all others; rows equal in id and text are one document, each
with the same result; a text of fewer than 20 words loses none; an empty table gives no row; extra columns pass
through in ``row``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from strata.llm import words as W
from strata.session import ensure_checkpoint_dir

SIZE = 20
GRAM = 6
STEP = 4_000_000           # bytes of text cut into segments at a time
PART_WORDS = 8_000_000     # words that go to one task, if half of the corpus repeats
SHARD_WORDS = 2_000_000    # words of one index
NONE = np.uint64(2 ** 64 - 1)


class FMIndex:
    """Backward search over a text of numbers (0 stands between segments), for patterns of up to ``depth`` numbers."""

    def __init__(self, text: np.ndarray, depth: int = SIZE):
        n = len(text)
        self.text, self.n, self.depth = text, n, depth
        # Ranks by the first 2 numbers, then twice as many, then ``depth``.
        rank, of = text.astype(np.int64), 1
        while of < depth:
            more = of if of * 2 <= depth else depth - of
            rank, before = self._ranked(rank, more, n, last=of + more == depth), rank
            of += more
        self.sa = rank
        ahead = lambda r, d: np.concatenate([r[d:], np.zeros(min(d, n), r.dtype)])[:n]
        # Where the first depth - 1 numbers change: half ranks at both ends cover them.
        half, shift = before, depth - 1 - (of - more)
        parts = [half, ahead(half, shift)]
        new = np.ones(n + 1, dtype=bool)
        new[1:-1] = np.logical_or.reduce([p[self.sa[1:]] != p[self.sa[:-1]] for p in parts]) if n else False
        starts = np.flatnonzero(new)
        self.group = np.cumsum(new[:-1]) - 1
        self.group_at = starts
        symbols = text[self.sa - 1] if n else text
        self.base = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=int(text.max(initial=0)) + 1))])
        self.levels = []
        for shift in range(max(1, int(text.max(initial=0)).bit_length()) - 1, -1, -1):
            bit = ((symbols >> shift) & 1).astype(bool)
            packed = np.packbits(bit, bitorder="little")
            blocks = np.frombuffer(np.pad(packed, (0, -len(packed) % 8 + 8)).tobytes(), dtype="<u8")
            ones = np.concatenate([[0], np.cumsum(np.bitwise_count(blocks), dtype=np.int32)[:-1]]).astype(np.int32)
            self.levels.append((shift, blocks, ones, n - int(bit.sum())))
            symbols = np.concatenate([symbols[~bit], symbols[bit]])
        every = np.arange(len(self.base) - 1)
        self.start = self._down(np.zeros(len(every), np.int64), every)

    @staticmethod
    def _ranked(rank: np.ndarray, ahead: int, n: int, last: bool) -> np.ndarray:
        """Ranks of pairs (here, ``ahead`` further on); at the end the suffixes in order, equal ones by position."""
        key = rank * (int(rank.max(initial=0)) + 1)
        key[:n - ahead] += rank[ahead:]
        order = np.argsort(key, kind="stable")
        if last:
            return order
        key = key[order]
        out = np.empty(n, np.int64)
        out[order] = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]])[:n])
        return out

    def _down(self, at: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Positions at the wavelet matrix's bottom."""
        for shift, blocks, ones, zeros in self.levels:
            block = at >> 6
            inside = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            one = ones[block] + np.bitwise_count(blocks[block] & inside).astype(np.int64)
            at = np.where((symbol >> shift) & 1, zeros + one, at - one)
        return at

    def first(self, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.base[symbol], self.base[symbol + 1]

    def before(self, low: np.ndarray, high: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the patterns with ``symbol`` in front."""
        both = self._down(np.concatenate([low, high]), np.concatenate([symbol, symbol]))
        shift = self.base[symbol] - self.start[symbol]
        return both[:len(low)] + shift, both[len(low):] + shift

    def shorter(self, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the first depth - 1 numbers of the patterns at ``low``."""
        group = self.group[low]
        return self.group_at[group], self.group_at[group + 1]


def earliest(index: FMIndex, start: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """For every window (``windows`` of each segment from text position ``start``, after each other) the first place
    in the text where its numbers stand."""
    text, depth = index.text, index.depth
    first = np.concatenate([[0], np.cumsum(windows)])
    out = np.arange(first[-1]) - np.repeat(first[:-1] - start, windows)           # its own place
    # A first window of which some end stands nowhere else: the windows that hold this end are the first of their words.
    live = np.arange(len(start))
    low, high = index.first(text[start + depth - 1])
    for k in range(depth - 2, -1, -1):
        go = (high - low > 1) | (windows[live] - 1 > k + 1)
        live, low, high = live[go], low[go], high[go]
        if not len(live):
            return out
        low, high = index.before(low, high, text[start[live] + k])
    # Matching statistics from the last window to the first.
    at = start[live] + windows[live] - 1
    low, high = index.first(text[at + depth - 1])
    for k in range(depth - 2, -1, -1):
        low, high = index.before(low, high, text[at + k])
    slot = first[live] + windows[live] - 1
    while True:
        out[slot] = index.sa[low]
        go = slot > first[live]
        if not go.any():
            return out
        live, slot, at, low = live[go], slot[go] - 1, at[go] - 1, low[go]
        low, high = index.shorter(low)
        low, high = index.before(low, high, text[at])


def _grams(words: W.Words, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the runs of ``GRAM`` words from each word on, and the sums behind them."""
    total, inverse = W.prefix_hash(h)
    n = max(words.n - GRAM + 1, 0)
    return W.mix((total[GRAM:GRAM + n] - total[:n]) * inverse[:n]) & ~np.uint64(1), total, inverse


def _segments(words: W.Words, h: np.ndarray, hot: np.ndarray):
    """First words, windows, keys and content hashes of the segments."""
    grams, total, inverse = _grams(words, h)
    n = max(words.n - SIZE + 1, 0)
    if not n:
        return [np.empty(0, t) for t in (np.int64, np.int64, np.uint64, np.uint64)]
    if len(hot):
        near = np.minimum(np.searchsorted(hot, grams), len(hot) - 1)
        grams[hot[near] == grams] = NONE
    value, place = grams, np.arange(len(grams))
    for step in (1, 2, 4, 7):                     # the smallest of 15 neighbouring runs, the first of equal ones
        less = value[step:] < value[:-step]
        value = np.where(less, value[step:], value[:-step])
        place = np.where(less, place[step:], place[:-step])
    at = np.flatnonzero(words.text[:n] == words.text[SIZE - 1:])
    value, place = value[at], place[at]
    none = value == NONE
    if none.any():
        own = at[none]
        value[none] = W.mix((total[own + SIZE] - total[own]) * inverse[own])
        place[none] = -1 - own
    new = np.ones(len(at), dtype=bool)
    new[1:] = (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    start, windows = at[first], np.diff(np.append(first, len(at)))
    content = W.mix(((total[start + windows + SIZE - 1] - total[start]) * inverse[start]) ^ windows.astype(np.uint64))
    return start, windows, value[first], content


def _gather(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Positions first, first + 1, ... of runs of the given sizes."""
    ends = np.cumsum(size)
    return np.repeat(first - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


def _pack(*arrays: np.ndarray) -> bytes:
    head = b"".join(len(a).to_bytes(8, "little") for a in arrays)
    return head + pa.compress(b"".join(a.tobytes() for a in arrays), codec="zstd", asbytes=True)


KEYS = (np.int64, np.int64, np.uint32, np.uint32, np.uint8, np.uint64)      # ids, hashes; document, place, windows, key
KINDS = (*KEYS, np.uint64, np.uint32)                                       # and hashes of words, and words by number
SEGMENT = np.dtype([("key", "<u8"), ("place", "<u4"), ("windows", "u1")])


def _unpack(data: bytes, kinds: tuple) -> list[np.ndarray]:
    sizes = [int.from_bytes(data[8 * k:8 * k + 8], "little") for k in range(len(kinds))]
    ends = np.concatenate([[0], np.cumsum([s * np.dtype(k).itemsize for s, k in zip(sizes, kinds)])]).tolist()
    raw = pa.decompress(data[8 * len(kinds):], ends[-1], codec="zstd", asbytes=True)
    return [np.frombuffer(raw, k, s, a) for k, s, a in zip(kinds, sizes, ends)]


def _by_document(ids: np.ndarray, hashes: np.ndarray, doc: np.ndarray, values: np.ndarray, column: str) -> pa.RecordBatch:
    """One row a document with its values' bytes in ``spans`` or ``segments``."""
    order = np.argsort(doc, kind="stable")
    doc, values = doc[order], values[order]
    new = np.flatnonzero(np.diff(doc, prepend=-1))
    packed = pa.array([values[a:b].tobytes() for a, b in zip(new.tolist(), [*new[1:].tolist(), len(doc)])], pa.binary())
    of, none = doc[new], pa.nulls(len(new), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[of]), pa.array(hashes[of]), *((packed, none) if column == "spans" else (none, packed))],
        names=["id", "hash", "spans", "segments"])


def _spans(ids: np.ndarray, hashes: np.ndarray, doc: np.ndarray, first: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    """Removed words: one row a document, its intervals packed."""
    return _by_document(ids, hashes, doc, np.stack([first, end], axis=1).astype("<u4"), "spans")


def _to_parts(rows: list[tuple[int, bytes]], known: pa.RecordBatch | None = None) -> pa.RecordBatch:
    """Rows for parts, or (part -1) for documents."""
    n = len(rows)
    if known is None:
        return pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in rows], pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()),
             pa.array([d for _, d in rows], pa.binary())], names=["part", "id", "hash", "data"])
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(known), -1, np.int32)), known.column("id"), known.column("hash"), known.column("spans")],
        names=["part", "id", "hash", "data"])


def _dealt(key: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """Positions of the keys of each part."""
    part = (W.mix(key) % np.uint64(parts)).astype(np.int64)
    by = np.argsort(part, kind="stable")
    at = np.concatenate([[0], np.flatnonzero(np.diff(part[by])) + 1, [len(by)]]).tolist()
    for a, b in zip(at[:-1], at[1:]):
        if b > a:
            yield int(part[by[a]]), by[a:b]


def _keys(batches: Iterator[pa.RecordBatch], parts: int, hot: np.ndarray):
    """Keys and places of the segments by part, and intervals that the task itself finds repeated (part -1)."""
    sent: dict[tuple[int, int], tuple] = {}            # of segments met more than once: the smallest place so far
    for batch in batches:
        raw, offsets = W.text_bytes(batch.column("text"))
        ids, hashes = (batch.column(c).to_numpy() for c in ("id", "hash"))
        for i, j in W.pieces(offsets, STEP):
            words = W.Words(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], W.NOT_SPACE, fold=False)
            h = words.hashes()
            start, windows, key, content = _segments(words, h, hot)
            if not len(start):
                continue
            doc = words.text[start]
            place = start - words.first[doc]
            own_ids, own_hashes = ids[i:j], hashes[i:j]
            # Equal segments follow each other in the order of their places.
            order = np.lexsort((place, own_hashes[doc], own_ids[doc], content, key))
            k, c, d = key[order], content[order], doc[order]
            again = np.zeros(len(order), dtype=bool)
            again[1:] = (k[1:] == k[:-1]) & (c[1:] == c[:-1])
            # Hash-equal segments are compared word by word.
            a, b = order[np.flatnonzero(again)], order[np.flatnonzero(again) - 1]
            size = windows[a] + SIZE - 1
            if not (h[_gather(start[a], size)] == h[_gather(start[b], size)]).all():
                raise AssertionError("two segments share a hash")
            lead = np.flatnonzero(~again)
            group = np.cumsum(~again) - 1
            head = order[lead[group]]
            same = (own_ids[doc[head]] == own_ids[d]) & (own_hashes[doc[head]] == own_hashes[d]) & (place[head] == place[order])
            done = again & ~same
            stay = ~again
            many = np.diff(np.append(lead, len(order))) > 1
            for g in np.flatnonzero(many).tolist() if len(sent) < 200_000 else []:
                x = order[lead[g]]
                sent.setdefault((int(key[x]), int(content[x])), None)
            for g, x in zip(lead.tolist(), order[lead].tolist()) if sent else ():
                name = int(key[x]), int(content[x])
                if name in sent:
                    here, seen = (int(own_ids[doc[x]]), int(own_hashes[doc[x]]), int(place[x])), sent[name]
                    if seen is not None and here >= seen:
                        stay[g], done[g] = False, here > seen
                    else:
                        sent[name] = here
            x = order[done]
            if len(x):
                yield _to_parts([], _spans(own_ids, own_hashes, doc[x], place[x], place[x] + windows[x] + SIZE - 1))
            x = order[stay]
            out = []
            for part, y in _dealt(key[x], parts):
                y = np.sort(x[y])
                docs, of = np.unique(doc[y], return_inverse=True)
                out.append((part, _pack(own_ids[docs], own_hashes[docs], of.astype(np.uint32), place[y].astype(np.uint32),
                                        windows[y].astype(np.uint8), key[y])))
            yield _to_parts(out)
        W.tidy()


def _together(packs: list[bytes], kinds: tuple) -> list[np.ndarray]:
    """The arrays of all packs after each other; documents are numbered through."""
    found = [_unpack(data, kinds) for data in packs]
    known = np.cumsum([0, *(len(f[0]) for f in found)]).tolist()
    columns = [np.concatenate(c) for c in zip(*(f[:2] for f in found))]
    doc = np.concatenate([f[2].astype(np.int64) + k for f, k in zip(found, known)])
    return [*columns, doc, *(np.concatenate(c) for c in zip(*(f[3:] for f in found)))]


def _match(batches: Iterator[pa.RecordBatch]):
    """The segments whose run stands in another segment too, by document; known intervals pass."""
    packs = []
    for batch in batches:
        for p, data in zip(batch.column("part").to_pylist(), batch.column("data")):
            if p >= 0:
                packs.append(data.as_py())
        gone = batch.filter(pa.compute.less(batch.column("part"), 0))
        if len(gone):
            yield pa.RecordBatch.from_arrays([gone.column("id"), gone.column("hash"), gone.column("data"),
                                              pa.nulls(len(gone), pa.binary())], names=["id", "hash", "spans", "segments"])
    if packs:
        ids, hashes, doc, place, windows, key = _together(packs, KEYS)
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        more = np.zeros(len(order), dtype=bool)
        more[1:] |= same
        more[:-1] |= same
        x = np.sort(order[more])
        if len(x):
            segments = np.empty(len(x), SEGMENT)
            segments["key"], segments["place"], segments["windows"] = key[x], place[x], windows[x]
            yield _by_document(ids, hashes, doc[x], segments, "segments")
    W.tidy()


def _cut_up(batches: Iterator[pa.RecordBatch], parts: int):
    """The named segments with their words, by part."""
    for batch in batches:
        raw, offsets = W.text_bytes(batch.column("text"))
        ids, hashes, named = batch.column("id").to_numpy(), batch.column("hash").to_numpy(), batch.column("segments")
        for i, j in W.pieces(offsets, STEP):
            words = W.Words(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], W.NOT_SPACE, fold=False)
            lists = [np.frombuffer(b"".join(named[k].as_py()), SEGMENT) for k in range(i, j)]
            doc = np.repeat(np.arange(j - i), [len(x) for x in lists])
            found = np.concatenate(lists)
            place, windows, key = found["place"], found["windows"], found["key"]
            start = words.first[doc] + place
            word, code = np.unique(words.hashes(), return_inverse=True)
            out = []
            for part, y in _dealt(key, parts):
                used, short = np.unique(code[_gather(start[y], windows[y].astype(np.int64) + SIZE - 1)], return_inverse=True)
                docs, of = np.unique(doc[y], return_inverse=True)
                out.append((part, _pack(ids[i:j][docs], hashes[i:j][docs], of.astype(np.uint32), place[y], windows[y], key[y],
                                        word[used], short.astype(np.uint32))))
            yield _to_parts(out)
        W.tidy()


def _shard(packs: list[bytes], shard: int, shards: int):
    """The repeats of one index: documents (ids, hashes) and the intervals of each."""
    chosen = []
    for data in packs:
        i, t, d, p, w, k, word, code = _unpack(data, KINDS)
        if shards > 1:
            mine = (W.mix(k) >> np.uint64(40)) % np.uint64(shards) == np.uint64(shard)
            code = code[np.repeat(mine, w.astype(np.int64) + SIZE - 1)]
            d, p, w, k = d[mine], p[mine], w[mine], k[mine]
        chosen.append((i, t, d, p, w, k, word[code]))
    known = np.cumsum([0, *(len(c[0]) for c in chosen)]).tolist()
    doc = np.concatenate([c[2].astype(np.int64) + n for c, n in zip(chosen, known)])
    ids, hashes, _, place, windows, key, text = map(np.concatenate, zip(*chosen))
    windows, place = windows.astype(np.int64), place.astype(np.int64)
    size = windows + SIZE - 1
    first = np.cumsum(size) - size
    total, inverse = W.prefix_hash(text)
    content = W.mix(((total[first + size] - total[first]) * inverse[first]) ^ windows.astype(np.uint64))
    # Equal segments after each other, each group in the order of documents.
    order = np.lexsort((place, hashes[doc], ids[doc], content, key))
    again = np.zeros(len(order), dtype=bool)
    again[1:] = (key[order][1:] == key[order][:-1]) & (content[order][1:] == content[order][:-1])
    lead = np.flatnonzero(~again)
    rest = order[again]
    a, b = rest, order[np.flatnonzero(again) - 1]
    if len(a) and not (text[_gather(first[a], size[a])] == text[_gather(first[b], size[b])]).all():
        raise AssertionError("two segments share a hash")
    head = order[lead[np.cumsum(~again) - 1]][again]
    later = (ids[doc[head]] != ids[doc[rest]]) | (hashes[doc[head]] != hashes[doc[rest]]) | (place[head] != place[rest])
    # The first of each group is indexed, unless nothing here has its run of words.
    alone = np.ones(len(order), dtype=bool)
    alone[1:] &= key[order][1:] != key[order][:-1]
    alone[:-1] &= key[order][:-1] != key[order][1:]
    lead = order[lead][~alone[lead]]
    lead = lead[np.lexsort((place[lead], hashes[doc[lead]], ids[doc[lead]]))]
    if not len(lead):
        return None
    word, code = np.unique(text[_gather(first[lead], size[lead])], return_inverse=True)
    n = size[lead]
    at = np.cumsum(n + 1) - n - 1
    whole = np.zeros(int(n.sum()) + len(n), np.int64)
    whole[_gather(at, n)] = code + 1
    index = FMIndex(whole)
    found = earliest(index, at, windows[lead])
    own = _gather(at, windows[lead])
    # Runs of repeated windows become intervals of words; a later copy of a segment repeats all of it.
    repeated = found < own
    segment = np.repeat(np.arange(len(lead)), windows[lead])
    offset = own - at[segment]
    edge = np.ones(len(own), dtype=bool)
    edge[1:] = (repeated[1:] != repeated[:-1]) | (segment[1:] != segment[:-1])
    runs = np.flatnonzero(edge)
    ends = np.append(runs[1:], len(own)) - 1
    ends, runs = ends[repeated[runs]], runs[repeated[runs]]
    x = lead[segment[runs]]
    rest = rest[later]
    return ids, hashes, np.concatenate([doc[x], doc[rest]]), \
        np.concatenate([place[x] + offset[runs], place[rest]]), \
        np.concatenate([place[x] + offset[ends] + SIZE, place[rest] + size[rest]])


def _search(batches: Iterator[pa.RecordBatch], shard_words: int):
    """Index and search of one part, a shard at a time."""
    packs = [data.as_py() for batch in batches for data in batch.column("data")]
    words = sum(int.from_bytes(data[8 * (len(KINDS) - 1):8 * len(KINDS)], "little") for data in packs)
    shards = max(1, -(-words // shard_words))
    for s in range(shards if packs else 0):
        found = _shard(packs, s, shards)
        if found is not None and len(found[2]):
            yield _spans(*found).select(["id", "hash", "spans"])
        W.tidy()


def _count_grams(batches: Iterator[pa.RecordBatch], share: float):
    """Runs that are more than ``share`` of a piece's words, with their number."""
    for batch in batches:
        raw, offsets = W.text_bytes(batch.column("text"))
        for i, j in W.pieces(offsets, STEP):
            words = W.Words(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], W.NOT_SPACE, fold=False)
            grams, _, _ = _grams(words, words.hashes())
            grams = np.sort(grams)
            first = np.flatnonzero(np.diff(grams, prepend=NONE))
            n = np.diff(np.append(first, len(grams)))
            keep = n > share * words.n
            yield pa.RecordBatch.from_arrays([pa.array(grams[first[keep]].view(np.int64)), pa.array(n[keep])], names=["gram", "n"])
        W.tidy()


def hot_grams(docs: DataFrame, least: int, octets: int) -> np.ndarray:
    """Sorted hashes of runs that stand at ``least`` places (a half more, to be sure) of the texts, which have ``octets``
    bytes.  A task's piece names the runs that have their share of it, so at most ``octets / least`` a piece."""
    found = docs.select("text").mapInArrow(lambda b: _count_grams(b, least / max(octets, 1)), "gram long, n long") \
        .groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return np.sort(found.select("gram").toArrow().column("gram").to_numpy().view(np.uint64))


def _remove(batches: Iterator[pa.RecordBatch]):
    """The texts without the words of their intervals; what is left is joined by one space."""
    for batch in batches:
        raw, offsets = W.text_bytes(batch.column("text"))
        spans = batch.column("spans")
        for i, j in W.pieces(offsets, STEP):
            own, bounds = raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
            words = W.Words(own, bounds, W.NOT_SPACE, fold=False)
            mark = np.zeros(words.n + 1, np.int64)
            for k in range(i, j):
                for data in spans[k].as_py() or ():
                    both = np.frombuffer(data, "<u4").astype(np.int64).reshape(-1, 2) + words.first[k - i]
                    np.add.at(mark, both[:, 0], 1)
                    np.add.at(mark, both[:, 1], -1)
            gone = np.cumsum(mark[:-1]) > 0
            text, start, end = words.text[~gone], words.start[~gone], words.end[~gone]
            last = np.ones(len(text), dtype=bool)
            last[:-1] = text[1:] != text[:-1]
            out = np.array(own)
            out[end[~last]] = 0x20
            edge = np.zeros(len(own) + 1, np.int8)
            edge[start] += 1
            stop = end + ~last
            np.subtract.at(edge, stop, 1)
            keep = np.cumsum(edge[:-1], dtype=np.int8) > 0
            at = np.concatenate([[0], np.cumsum(keep)])[bounds]
            texts = pa.LargeStringArray.from_buffers(j - i, pa.py_buffer(at), pa.py_buffer(out[keep])).cast(pa.string())
            removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[words.first])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row").slice(i, j - i), pa.array(np.diff(words.first)), pa.array(removed), texts],
                names=["row", "n_words", "n_removed", "text"])
        W.tidy()


def remove_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", keep: list[str] | None = None,
                   part_words: int = PART_WORDS, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Columns ``row`` (the document's columns ``keep``, all but the text by default), ``n_words``, ``n_removed`` and
    ``text``, the words that stay joined by one space."""
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    names = keep or [c for c in docs.columns if c != text]
    own: Column = F.col(text).cast("string")
    own = docs.select(F.struct(*[F.col(c).alias(c) for c in names]).alias("row"), own.alias("text"),
                      F.coalesce(F.col(id).cast("long"), F.lit(-2 ** 63)).alias("id"),
                      F.xxhash64(own, F.col(id).isNull()).alias("hash"))
    # A segment comes on 7 words of 6 bytes; 27 words a segment, so part_words / 54 segments fill half a part.
    octets = own.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    segments = octets // 42
    of_keys = max(1, -(-segments // part_words * 4))
    parts = max(1, -(-segments * 27 // (2 * part_words)))
    hot = spark.sparkContext.broadcast(hot_grams(own, part_words // 54, octets) if parts > 1 else np.empty(0, np.uint64))
    by_part = "part int, id long, hash long, data binary"
    to = F.when(F.col("part") >= 0, F.col("part")).otherwise(F.pmod(F.xxhash64("id", "hash"), F.lit(of_keys)).cast("int"))
    found = own.select("id", "hash", "text").mapInArrow(lambda b: _keys(b, of_keys, hot.value), by_part) \
        .repartitionById(of_keys, to).mapInArrow(_match, "id long, hash long, spans binary, segments binary") \
        .groupBy("id", "hash").agg(F.collect_list("spans").alias("spans"), F.collect_list("segments").alias("segments")).checkpoint()
    # Both joins shuffle the documents in the same way, so that is done once.
    searched = own.join(found.where(F.size("segments") > 0).select("id", "hash", "segments"), ["id", "hash"]) \
        .select("row", "text", "id", "hash", "segments").mapInArrow(lambda b: _cut_up(b, parts), by_part) \
        .repartitionById(parts, F.col("part")).mapInArrow(lambda b: _search(b, shard_words), "id long, hash long, spans binary")
    spans = found.select("id", "hash", F.explode("spans").alias("spans")).unionByName(searched) \
        .groupBy("id", "hash").agg(F.collect_list("spans").alias("spans"))
    result = T.StructType([own.schema["row"], T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
                           T.StructField("text", T.StringType())])
    return own.join(spans, ["id", "hash"], "left").select("row", "text", "spans").mapInArrow(_remove, result)
