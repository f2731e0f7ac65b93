"""Scoring by a hierarchical Pitman-Yor language model of words.

Tokens are lower-cased (A-Z) words between white space and one end a text.  A token's
context is the token before it.  Every context is a restaurant of its own; all restaurants share one
parent, the restaurant of words without context, whose base is uniform over the V
training words and one unknown.

Seating is sampled by Gibbs sweeps.  A sweep unseats, for each dish (word) of each restaurant, all
its customers and seats them again one after another by the Chinese-restaurant rule,
given the parent's probabilities and the restaurant's number of tables after the last
sweep (tasks do not see each other's moves within a sweep; see ``seat``).  Tables are
customers of the parent, which is seated in the same sweep.  The predictive probability is
the mean over the sweeps after ``BURN_IN``.

On Spark: words are cut into buckets by hash; counts are aggregated within a task, sent as
packed arrays and merged bucket by bucket (over several groups of tasks first, so a
frequent word's rows stay few).  A bucket holds all that concerns its words except the
restaurants' table numbers, which are sums over the buckets.  Contexts are hashed to ``classes_for`` classes, and each class
is owned by the context most frequent in it (in about ``SAMPLE`` bytes of the text); an owner's sum goes through the driver, a number
a class and sweep (6 MB at most).  All other contexts keep their 64-bit hash, and their sums go by a shuffle: each bucket sends
the tables of those it needs to the contexts' own buckets (a context is a word too) and gets the sums back.  So the
number of contexts has no limit, and who owns a class decides by which way a sum goes and no more.
A sweep stores nothing but those sums: its random numbers are seeded by bucket and sweep, so tasks
(also those run again after a loss) repeat earlier sweeps from the sums.

A dish of one customer has one table whatever the sums are; so after the first sums, which count the pairs of each
context, only contexts that a bucket holds with a word more than once are sent, with their tables beyond the first.

Scoring sends the distinct (word, context) pairs of each piece of text to the buckets, where a bucket with many is
split by ``SPLIT`` and its model goes to each part.  The answers -- customers and tables of each word in the parent, tables of
each word as a context, customers and tables of each pair -- go back to the piece, which has kept its tokens as numbers
and adds up per text (a context has as many customers as the word has tokens, for a token follows each).  So what is sent
grows with the pairs, and nothing is sent per document and bucket.

Words are told apart by 64-bit hashes: among V words the chance of any clash is V*V / 2**65
(hashes below ``SPAN`` would be taken for a class and count as ``SPAN``: one in 2**40).

Defined results: null is empty text (one end token); rows with a null id count as text '' for
the split; repeated rows are scored each, and learned from each; with no training
row every token is unknown and the base is log10(0.5 / 0.5) = 0 each; other columns do not matter.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from strata.llm import words as W
from strata.session import ensure_checkpoint_dir, scratch_path

CLASSES, MOST_CLASSES = 1 << 16, 1 << 18
PER_CLASS = 64               # bytes of training text for each class
SPAN = 1 << 24               # classes are kept in three bytes; from here on a context is its hash
SAMPLE = 32 << 20            # bytes of training text, about, that choose the owners of classes
SWEEPS, BURN_IN = 4, 2
STRENGTH = 1.0
SEED = 20240229
PIECE = 8_500_000            # bytes of text whose counts are packed together
STEP = 2_000_000             # bytes that are cut into words at a time
BUCKET_BYTES = 32 << 20      # bytes of training text for each bucket
SPLIT = 4_000_000            # training tokens of a bucket for each part its questions are cut into
SINGLY = 64                  # customers of a dish that are seated one by one
BROADCAST = 32 << 20         # bytes
END = np.uint64(0x9AE16A3B2F90404F)
START = np.uint64(0xC3A5C85C97CB3127)


def classes_for(octets: int) -> int:
    """How many contexts' sums may go through the driver: a power of two.  It limits no context."""
    return min(max(CLASSES, 1 << (octets // PER_CLASS).bit_length()), MOST_CLASSES)


def tokens(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hash and text number of each token of a piece."""
    parts = []
    for i, j in W.pieces(offsets, STEP):
        word, text = _tokens(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
        parts.append((word, text + np.uint32(i)))
    if not parts:
        return np.empty(0, np.uint64), np.empty(0, np.uint32)
    return tuple(np.concatenate(x) for x in zip(*parts))


def _tokens(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    words = W.Words(raw, offsets, W.NOT_SPACE)
    texts = len(offsets) - 1
    count = np.diff(words.first)
    last = np.cumsum(count + 1) - 1                       # where each text's end token stands
    token = np.empty(words.n + texts, dtype=np.uint64)
    inner = np.ones(len(token), dtype=bool)
    inner[last] = False
    token[inner] = words.hashes()
    token[last] = END
    return token, np.repeat(np.arange(texts, dtype=np.uint32), count + 1)


def class_of(context: np.ndarray, classes: int) -> np.ndarray:
    return (W.mix(context ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(65 - classes.bit_length())).astype(np.uint32)


def keys_of(context: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """Of each context its class, if it owns that, and else its hash."""
    cls = class_of(context, len(owners))
    return np.where(owners[cls] == context, cls.astype(np.uint64), np.maximum(context, np.uint64(SPAN)))


def before(x: np.ndarray, text: np.ndarray, start) -> np.ndarray:
    """The element before each one, ``start`` at the start of a text."""
    out = np.empty_like(x)
    out[1:] = x[:-1]
    out[_runs(text)] = start
    return out


def token_arrays(raw: np.ndarray, offsets: np.ndarray, classes: int = CLASSES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hash, class of the token before, and text number of each token of a piece."""
    word, text = tokens(raw, offsets)
    return word, class_of(before(word, text, START), classes), text


def numbered(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted words of a piece, the number of each token among them, and the text number of each token."""
    word, text = tokens(raw, offsets)
    words, number = np.unique(word, return_inverse=True)
    return words, number.astype(np.int64), text


def pair_codes(number: np.ndarray, text: np.ndarray, words: int) -> np.ndarray:
    """Word and context of each token in one number: contexts are numbered as words are, behind the start."""
    return number * (words + 1) + before(number + 1, text, 0)


def bucket_of(word: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are ranges of the hash: sorted words are sorted by bucket."""
    return ((word >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Firsts of the runs of equal keys (sorted)."""
    new = np.ones(len(keys[0]), dtype=bool)
    if len(new):
        new[1:] = False
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def narrow(x: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as the largest needs, their lowest bytes first; the first byte tells how many."""
    top = int(x.max()) if len(x) else 0
    size = next(b for b in (1, 2, 4, 8) if top < 1 << (8 * b))
    return bytes([size]) + x.astype(f"<u{size}").view(np.uint8).reshape(len(x), size).T.tobytes()


def widen(data: bytes) -> np.ndarray:
    size = data[0]
    return np.ascontiguousarray(np.frombuffer(data, np.uint8, offset=1).reshape(size, -1).T).view(f"<u{size}").reshape(-1)


def three(x: np.ndarray) -> bytes:
    """Numbers below ``SPAN``: the lower two bytes of all, then the third, which holds little, compressed."""
    return len(x).to_bytes(8, "little") + x.astype("<u2").tobytes() \
        + pa.compress((x >> np.uint32(16)).astype(np.uint8).tobytes(), codec="zstd", asbytes=True)


def from_three(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    low = np.frombuffer(data, "<u2", n, 8).astype(np.uint32)
    high = np.frombuffer(pa.decompress(data[8 + 2 * n:], n, codec="zstd", asbytes=True), np.uint8) if n else low
    return low | high.astype(np.uint32) << np.uint32(16)


def pack(word: np.ndarray, cls: np.ndarray, count: np.ndarray) -> dict[str, bytes]:
    """Pairs sorted by word and context (``keys_of``): each word once with its numbers of pairs, all and those behind the
    owners, which are kept as hashes."""
    at = _runs(word)
    sizes = np.diff(np.concatenate([at, [len(word)]]))
    far = cls >= SPAN
    return {"words": word[at].tobytes(), "sizes": _dump(sizes, np.add.reduceat(far, at, dtype=np.int64) if len(at) else sizes),
            "cls": three(cls[~far].astype(np.uint32)), "far": cls[far].astype(np.uint64).tobytes(), "counts": _dump(count)}


def unpack(row: dict[str, bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes, fars = (x.astype(np.int64) for x in _load(row["sizes"], "ii"))
    ends = np.cumsum(sizes)
    far = np.arange(int(sizes.sum())) >= np.repeat(ends - fars, sizes)
    cls = np.empty(len(far), np.uint64)
    cls[~far], cls[far] = from_three(row["cls"]), np.frombuffer(row["far"], np.uint64)
    return np.repeat(np.frombuffer(row["words"], np.uint64), sizes), cls, _load(row["counts"], "i")[0]


def merged(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Pairs of several packs, equal ones added up."""
    word, cls, count = (np.concatenate(x) for x in zip(*parts))
    count = count.astype(np.uint64)
    order = np.lexsort((cls, word))
    word, cls, count = word[order], cls[order], count[order]
    at = _runs(word, cls)
    return word[at], cls[at], np.add.reduceat(count, at) if len(at) else count


PACK = "words binary, sizes binary, cls binary, far binary, counts binary"
FIELDS = ["words", "sizes", "cls", "far", "counts"]


def _pieces(batch: pa.RecordBatch):
    raw, offsets = W.text_bytes(batch.column("text"))
    for i, j in W.pieces(offsets, PIECE):
        yield i, j, raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]


def _seen(batches: Iterator[pa.RecordBatch], classes: int):
    """The words of each piece (no end follows an end), their classes as contexts and their numbers."""
    for batch in batches:
        for _, _, raw, offsets in _pieces(batch):
            words, number, _ = numbered(raw, offsets)
            n = np.bincount(number, minlength=len(words))
            words, n = words[words != END], n[words != END]
            yield pa.RecordBatch.from_arrays(
                [pa.array(class_of(words, classes).astype(np.int32)), pa.array(words.view(np.int64)), pa.array(n.astype(np.int64))],
                names=["cls", "word", "n"])
        W.tidy()


def owners_of(texts: DataFrame, size: int, classes: int) -> np.ndarray:
    """The context that owns each class (0: none)."""
    if size > SAMPLE:
        texts = texts.where(F.pmod(F.xxhash64("text"), F.lit(-(-size // SAMPLE))) == 0)
    best = texts.mapInArrow(lambda b: _seen(b, classes), "cls int, word long, n long").groupBy("cls", "word") \
        .agg(F.sum("n").alias("n")).groupBy("cls").agg(F.max(F.struct("n", "word"))["word"].alias("word")).toArrow()
    out = np.zeros(classes, np.uint64)
    out[best.column("cls").to_numpy()] = best.column("word").to_numpy().view(np.uint64)
    out[class_of(np.array([START]), classes)] = START
    return out


def _counted(batches: Iterator[pa.RecordBatch], buckets: int, groups: int, owners):
    for batch in batches:
        for _, _, raw, offsets in _pieces(batch):
            words, number, text = numbered(raw, offsets)
            keys = keys_of(np.concatenate([[START], words]), owners.value)
            order = np.argsort(keys)
            rank = np.empty_like(order)
            rank[order] = np.arange(len(order))
            code = number * len(keys) + rank[before(number + 1, text, 0)]
            code.sort()
            at = _runs(code)
            count = np.diff(np.append(at, len(code)))
            word, cls = words[code[at] // len(keys)], keys[order][code[at] % len(keys)]
            bounds = np.searchsorted(bucket_of(word, buckets), np.arange(buckets + 1))
            rows = [(b, pack(word[x:y], cls[x:y], count[x:y]))
                    for b, (x, y) in enumerate(zip(bounds[:-1], bounds[1:])) if y > x]
            group = TaskContext.get().partitionId() % groups
            yield pa.RecordBatch.from_arrays(
                [pa.array([b for b, _ in rows], pa.int32()), pa.array([group] * len(rows), pa.int32()),
                 *(pa.array([r[f] for _, r in rows], pa.binary()) for f in FIELDS)],
                names=["bucket", "part", *FIELDS])
        W.tidy()


def _merge(table: pa.Table) -> pa.Table:
    word, cls, count = merged([unpack(r) for r in _rows(table.select(FIELDS))])
    row = pack(word, cls, count)
    return pa.table({"bucket": table.column("bucket").slice(0, 1), "part": table.column("part").slice(0, 1),
                     "tokens": pa.array([int(count.sum())], pa.int64()),
                     **{f: pa.array([row[f]], pa.binary()) for f in FIELDS}})


def seat(count: np.ndarray, weight: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of dishes with ``count`` customers seated one after another: behind k customers at t tables the
    next opens one with probability weight / (weight + k - discount * t).  Behind ``SINGLY`` customers they come
    in blocks of an eighth of those seated, whose new tables are a binomial number at the rate of
    the block's middle, so a dish costs the logarithm of its customers."""
    tables = (count > 0).astype(np.int64)
    some = np.flatnonzero(count > 1)
    n, a = count[some], weight[some]
    k, t = np.ones(len(some), np.int64), np.ones(len(some), np.int64)
    while len(some):
        m = np.minimum(np.where(k < SINGLY, 1, k // 8), n - k)
        p = a / (a + k + (m - 1) / 2 - discount * t)
        t = t + (rng.random(len(some)) < p if (m == 1).all() else rng.binomial(m, p))
        k = k + m
        tables[some] = t
        more = k < n
        some, n, a, k, t = some[more], n[more], a[more], k[more], t[more]
    return tables


class Bucket:
    """A bucket's pairs, and the chain of sweeps over them."""

    def __init__(self, number: int, row: dict[str, bytes]):
        self.number = number
        self.words = np.frombuffer(row["words"], np.uint64)
        word, self.cls, count = unpack(row)
        self.first = _runs(word)
        self.sizes = np.diff(np.append(self.first, len(word)))
        self.of = np.repeat(np.arange(len(self.sizes), dtype=np.int32), self.sizes)
        self.count = count.astype(np.int64)
        far = self.cls >= SPAN
        self.near, self.far = (np.flatnonzero(x).astype(np.int32) for x in (~far, far))
        # Pairs whose seating needs sums from other buckets, and the contexts those are of.
        self.open = self.far[self.count[self.far] > 1]
        self.names, self.name = np.unique(self.cls[self.open], return_inverse=True)

    def start(self) -> dict:
        """Every dish at one table, in both floors."""
        return {"t": np.ones(len(self.cls), np.int64), "c0": self.sizes.copy(),
                "t0": np.ones(len(self.words), np.int64)}

    def parent(self, state: dict, world: dict) -> np.ndarray:
        """The parent's probability of each word of the bucket."""
        d, total, tables = world["d0"], world["C0"], world["T0"]
        return (state["c0"] - d * state["t0"] + (STRENGTH + d * tables) / (world["V"] + 1)) / (STRENGTH + total)

    def sweep(self, state: dict, world: dict, number: int, sums: np.ndarray) -> dict:
        """``sums``: tables of the restaurants in ``names``."""
        rng = np.random.default_rng([SEED, self.number, number])
        weight = self.parent(state, world)[self.of]
        weight[self.near] *= STRENGTH + world["d"] * world["T"][self.cls[self.near]]
        weight[self.open] *= STRENGTH + world["d"] * sums[self.name]
        t = seat(self.count, weight, world["d"], rng)
        c0 = np.add.reduceat(t, self.first) if len(t) else self.sizes.copy()
        base = np.full(len(c0), (STRENGTH + world["d0"] * world["T0"]) / (world["V"] + 1))
        return {"t": t.astype(np.uint32 if t.max(initial=0) < 1 << 32 else np.uint64), "c0": c0, "t0": seat(c0, base, world["d0"], rng)}

    def chain(self, worlds: list[dict], sums: list[np.ndarray] = ()) -> Iterator[dict]:
        """The states after each sweep; sweep i is drawn given worlds[i] and sums[i]."""
        state = self.start()
        yield state
        for i, world in enumerate(worlds):
            state = self.sweep(state, world, i, sums[i] if len(sums) else np.empty(0, np.int64))
            yield state


def _rows(table) -> Iterator[dict]:
    """One row after the other: packs are large."""
    for k in range(table.num_rows):
        yield table.slice(k, 1).to_pylist()[0]


def sums_of(met: list[dict], worlds: int) -> list[np.ndarray]:
    """Tables of a bucket's ``names`` before each sweep: pairs, and the tables beyond the first that sweeps gave them."""
    rows = sorted((r["sweep"], r["home"], r["data"]) for r in met if r["home"] >= 0)
    if not rows:
        return []
    by = [np.concatenate([np.empty(0, np.int64), *(_load(d, "i")[0].astype(np.int64) for k, _, d in rows if k == i)]) for i in range(worlds)]
    return [by[0] if i == 0 else by[0] + x for i, x in enumerate(by)]


def far_tables(words: np.ndarray, met: list[dict], i: int) -> np.ndarray:
    """Tables of the bucket's words as contexts that own no class, after sweep i."""
    out = np.zeros(len(words), np.int64)
    for r in met:
        if r["home"] < 0 and r["sweep"] in (0, i):
            name, n = _load(r["data"], "ii")
            out[np.searchsorted(np.maximum(words, np.uint64(SPAN)), name)] += n.astype(np.int64)
    return out


SENT = pa.schema([("home", pa.int32()), ("bucket", pa.int32()), ("data", pa.binary())])
MET = "bucket int, sweep int, home int, data binary"


def _swept(row: dict, met: list[dict], worlds: list[dict], buckets: int, classes: int) -> pa.RecordBatch:
    """What the next sweep has to know of a bucket: with home -1, what the driver adds up; else, what goes to the buckets of
    contexts that own no class: their names, their tables (after the first sweep, beyond one a pair), and which are asked for."""
    own = Bucket(row["bucket"], row)
    for state in own.chain(worlds, sums_of(met, len(worlds))):
        pass
    near = own.cls[own.near].astype(np.int64)
    tables = np.bincount(near, weights=state["t"][own.near], minlength=classes).astype(np.int64)
    at = np.flatnonzero(tables)
    numbers = [int(state["c0"].sum()), int(state["t0"].sum()), len(own.words)]
    if worlds:
        of_classes = [at, tables[at], at[:0], at[:0]]
        name, n = own.names, np.bincount(own.name, weights=state["t"][own.open].astype(np.int64) - 1, minlength=len(own.names)).astype(np.int64)
        asked = np.ones(len(name), np.uint8)
    else:
        customers = np.bincount(near, weights=own.count[own.near], minlength=classes).astype(np.int64)
        of_classes = [at, tables[at], np.flatnonzero(customers), customers[customers > 0]]
        numbers += [int(own.count.sum()), int((own.count == 1).sum()), int((own.count == 2).sum()),
                    int((own.sizes == 1).sum()), int((own.sizes == 2).sum()), len(own.far)]
        name, n = np.unique(own.cls[own.far], return_counts=True)
        asked = np.zeros(len(name), np.uint8)
        asked[np.searchsorted(name, own.names)] = 1
    bounds = np.searchsorted(bucket_of(name, buckets), np.arange(buckets + 1))
    out = [(-1, own.number, _dump(*of_classes, np.array(numbers)))]
    out += [(h, own.number, _dump(name[x:y], n[x:y], asked[x:y])) for h, (x, y) in enumerate(zip(bounds[:-1], bounds[1:])) if y > x]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], f.type) for k, f in enumerate(SENT)], schema=SENT)


def _swept_alone(batches: Iterator[pa.RecordBatch], shared, buckets: int, classes: int):
    for batch in batches:
        for row in _rows(batch):
            yield _swept(row, [], shared.value, buckets, classes)
        W.tidy()


def _swept_met(packs: pa.Table, met: pa.Table, shared, buckets: int, classes: int) -> pa.Table:
    met = met.to_pylist()
    out = pa.Table.from_batches([_swept(row, met, shared.value, buckets, classes) for row in _rows(packs)], SENT)
    W.tidy()
    return out


def _opened(batches: Iterator[pa.RecordBatch], classes: int):
    """Sums for the driver by key: the tables of each class, its customers behind them, and other numbers from -1 down."""
    for batch in batches:
        for row in _rows(batch):
            at, tables, at_too, customers, numbers = (x.astype(np.int64) for x in _load(row["data"], "iiiii"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([at, at_too + classes, -1 - np.arange(len(numbers))]).astype(np.int32)),
                 pa.array(np.concatenate([tables, customers, numbers]))], names=["key", "n"])


def _meet(sent: pa.Table, sweep: int) -> pa.Table:
    """The sums of a bucket's contexts over all buckets: to each the ones it asks for, and, with home -1, all that are not 0."""
    home = sent.column("home")[0].as_py()
    parts = [(r["bucket"], _load(r["data"], "iii")) for r in _rows(sent)]
    name, of = np.unique(np.concatenate([p[0].astype(np.uint64) for _, p in parts]), return_inverse=True)
    total = np.bincount(of, weights=np.concatenate([p[1] for _, p in parts])).astype(np.int64)
    ends = np.cumsum([len(p[0]) for _, p in parts])
    out = [(home, -1, _dump(name[total > 0], total[total > 0]))]
    out += [(b, home, _dump(total[of[end - len(p[0]):end][p[2] > 0]])) for (b, p), end in zip(parts, ends) if p[2].any()]
    return pa.table({"bucket": pa.array([b for b, _, _ in out], pa.int32()), "sweep": pa.array([sweep] * len(out), pa.int32()),
                     "home": pa.array([h for _, h, _ in out], pa.int32()), "data": pa.array([d for _, _, d in out], pa.binary())})


class Model:
    """``packs`` (DataFrame, a row a bucket), the number of buckets, the owners of classes, the owners' sums before each sweep
    (``worlds``) and those of all other contexts (``met``, by bucket)."""

    def __init__(self, packs: DataFrame, buckets: int, owners: np.ndarray, sweeps: int):
        self.packs, self.buckets, self.owners = packs, buckets, owners
        self.classes = classes = len(owners)
        self.worlds: list[dict] = []
        spark = packs.sparkSession
        self.met = spark.createDataFrame([], MET)
        known: dict = {}
        for sweep in range(sweeps + 1):
            sent = self._sent(spark.sparkContext.broadcast(self.worlds), sweep and known["far"])
            sums = sent.where("home < 0").mapInArrow(lambda b: _opened(b, classes), "key int, n long") \
                .groupBy("key").agg(F.sum("n").alias("n")).toArrow()              # at most 2 * classes + 9 rows
            key, n = sums.column("key").to_numpy(), sums.column("n").to_numpy()
            got = {int(k): int(x) for k, x in zip(key[key < 0], n[key < 0])}

            def of(first: int) -> np.ndarray:
                own = (key >= first) & (key < first + classes)
                out = np.zeros(classes, np.int64)
                out[key[own] - first] = n[own]
                return out.astype(np.int32 if out.max(initial=0) < 1 << 31 else np.int64)

            if not known:
                customers = of(classes)
                rate = lambda a, b: min(max(a / max(a + 2 * b, 1), 0.05), 0.95)
                known = {"c": customers, "N": got.get(-4, 0), "V": got.get(-3, 0), "far": got.get(-9, 0),
                         "d": rate(got.get(-5, 0), got.get(-6, 0)), "d0": rate(got.get(-7, 0), got.get(-8, 0))}
            self.worlds.append({**known, "T": of(0), "C0": got.get(-1, 0), "T0": got.get(-2, 0)})
            if known["far"]:
                self.met = self.met.unionByName(_met(sent, sweep))

    def _sent(self, shared, meet: int) -> DataFrame:
        buckets, classes, kind = self.buckets, self.classes, "home int, bucket int, data binary"
        if not meet:
            return self.packs.mapInArrow(lambda b: _swept_alone(b, shared, buckets, classes), kind).checkpoint()
        return self.packs.groupBy("bucket").cogroup(self.met.groupBy("bucket")).applyInArrow(
            lambda a, b: _swept_met(a, b, shared, buckets, classes), kind).checkpoint()


def _met(sent: DataFrame, sweep: int) -> DataFrame:
    return sent.where("home >= 0").groupBy("home").applyInArrow(lambda t: _meet(t, sweep), MET).checkpoint()


def _by_bucket(packs: DataFrame, buckets: int) -> DataFrame:
    """The packs, stored so that a sweep reads each bucket in one task and moves only what the buckets tell each other."""
    spark, name = packs.sparkSession, f"lm_packs_{uuid.uuid4().hex}"
    packs.write.bucketBy(min(2 * buckets, 10_000), "bucket").option("path", scratch_path(spark, "lm_packs")).saveAsTable(name)
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")                  # the files stay: they are the model's


def fit(docs: DataFrame, text: str = "text", sweeps: int = SWEEPS, bucket_bytes: int = BUCKET_BYTES) -> Model:
    """Counts all texts of ``docs`` and runs the sweeps."""
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    W.bounded(spark)
    own = docs.select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    size = own.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    buckets = max(1, -(-size // bucket_bytes))
    owners = owners_of(own, size, classes_for(size))
    shared = spark.sparkContext.broadcast(owners)
    groups = math.isqrt(buckets) + 1
    counted = own.mapInArrow(lambda b: _counted(b, buckets, groups, shared), f"bucket int, part int, {PACK}")
    for by in (["bucket", "part"], ["bucket"]):
        counted = counted.groupBy(*by).applyInArrow(_merge, f"bucket int, part int, tokens long, {PACK}")
    return Model(_by_bucket(counted.drop("part"), buckets), buckets, owners, sweeps)


def _dump(*arrays: np.ndarray) -> bytes:
    """Arrays after each other, whole numbers as narrow as they can be."""
    parts = [x.astype("<f4").tobytes() if x.dtype.kind == "f" else narrow(x) for x in arrays]
    head = b"".join(len(p).to_bytes(8, "little") for p in parts)
    return head + pa.compress(b"".join(parts), codec="zstd", asbytes=True)


def _load(data: bytes, kinds: str) -> list[np.ndarray]:
    """What ``_dump`` wrote; ``kinds`` has an i or f for each array."""
    ends = np.cumsum([0, *(int.from_bytes(data[8 * k:8 * k + 8], "little") for k in range(len(kinds)))]).tolist()
    raw = pa.decompress(data[8 * len(kinds):], ends[-1], codec="zstd", asbytes=True)
    return [widen(raw[x:y]) if k == "i" else np.frombuffer(raw[x:y], "<f4") for k, x, y in zip(kinds, ends, ends[1:])]


def _named_pieces(batches: Iterator[pa.RecordBatch]):
    """The pieces with a name that is a hash of all they hold, so both passes over the texts know it."""
    for batch in batches:
        for i, j, raw, offsets in _pieces(batch):
            ids = batch.column("id").slice(i, j - i)
            name = hashlib.blake2b(raw.tobytes() + offsets.tobytes() + repr(ids.to_pylist()).encode(), digest_size=16)
            yield name.hexdigest(), ids, raw, offsets
        W.tidy()


def _asked(batches: Iterator[pa.RecordBatch], buckets: int, owners):
    """Distinct (word, context) pairs of each piece, by bucket."""
    for name, _, raw, offsets in _named_pieces(batches):
        words, number, text = numbered(raw, offsets)
        keys = keys_of(np.concatenate([[START], words]), owners.value)
        code = pair_codes(number, text, len(words))
        code.sort()
        code = code[_runs(code)]
        word, cls = code // len(keys), keys[code % len(keys)]
        far = cls >= SPAN
        slot = np.where(far, len(owners.value), cls).astype(np.uint32)
        cuts = np.searchsorted(bucket_of(words, buckets), np.arange(buckets + 1))
        bounds = np.searchsorted(word, cuts)
        rows = []
        for b, (x, y) in enumerate(zip(bounds[:-1], bounds[1:])):
            if y > x:
                rows.append((b, _dump(words[cuts[b]:cuts[b + 1]], np.diff(np.append(_runs(word[x:y]), y - x)),
                                      slot[x:y], cls[x:y][far[x:y]])))
        yield pa.RecordBatch.from_arrays(
            [pa.array([b for b, _ in rows], pa.int32()), pa.array([name] * len(rows), pa.string()),
             pa.array([d for _, d in rows], pa.binary())], names=["bucket", "piece", "data"])


def _own(batches: Iterator[pa.RecordBatch]):
    """The tokens of each piece as numbers of its sorted words, and how many each text has."""
    for name, ids, raw, offsets in _named_pieces(batches):
        _, number, text = numbered(raw, offsets)
        data = _dump(number, np.bincount(text, minlength=len(ids)))
        yield pa.RecordBatch.from_arrays(
            [pa.array([name], pa.string()), pa.array([ids.to_pylist()], pa.list_(ids.type)), pa.array([data], pa.binary())],
            names=["piece", "ids", "data"])


ANSWER = pa.schema([("piece", pa.string()), ("bucket", pa.int32()), ("data", pa.binary())])


def kept_sweeps(sweeps: int, burn_in: int) -> list[int]:
    return list(range(burn_in + 1, sweeps)) or [0]


def _answer(rows: pa.Table, side: pa.Table, shared, burn_in: int) -> pa.Table:
    """For each asking piece: of each word the training count and, in each kept state, customers and tables in the parent and
    tables as a context; of each pair the customers and, in each kept state, the tables."""
    if not rows.num_rows:
        return ANSWER.empty_table()
    worlds, owners = shared.value
    kept = kept_sweeps(len(worlds), burn_in)
    met = [r for r in _rows(side) if r["words"] is None]
    own = next((Bucket(r["bucket"], r) for r in _rows(side) if r["words"] is not None), None)
    if own is not None:
        states = [s for i, s in enumerate(own.chain(worlds[:-1], sums_of(met, len(worlds)))) if i in kept]
        cls = class_of(own.words, len(owners))
        owner = owners[cls] == own.words
        words_have = [np.add.reduceat(own.count, own.first)]
        for i, state in zip(kept, states):
            words_have += [state["c0"], state["t0"], np.where(owner, worlds[i]["T"][cls], far_tables(own.words, met, i))]
        pairs_have = [own.count, *(s["t"] for s in states)]
        near = own.of[own.near].astype(np.int64) * SPAN + own.cls[own.near].astype(np.int64)      # sorted, as pairs are
        names, name = np.unique(own.cls[own.far], return_inverse=True)
        far = own.of[own.far].astype(np.int64) * len(names) + name
    out = []
    for row in _rows(rows):
        words, sizes, cls, far_keys = _load(row["data"], "iiii")
        cls = cls.astype(np.int64)
        words_get = np.zeros((1 + 3 * len(kept), len(words)), np.int64)
        pairs_get = np.zeros((1 + len(kept), len(cls)), np.int64)
        if own is not None:
            place, known = _place(own.words, words.astype(np.uint64))
            for get, have in zip(words_get, words_have):
                get[known] = have[place[known]]
            of = np.repeat(np.arange(len(words)), sizes)
            is_far = cls == len(owners)
            at = np.full(len(cls), -1)
            at_near = ~is_far & known[of]
            found, there = _place(near, place[of[at_near]] * SPAN + cls[at_near])
            at[at_near] = np.where(there, own.near[found] if len(near) else -1, -1)
            rank, some = _place(names, far_keys.astype(np.uint64))
            ask = some & known[of[is_far]]
            at_far = np.flatnonzero(is_far)[ask]
            found, there = _place(far, place[of[at_far]] * len(names) + rank[ask])
            at[at_far] = np.where(there, own.far[found] if len(far) else -1, -1)
            for get, have in zip(pairs_get, pairs_have):
                get[at >= 0] = have[at[at >= 0]]
        out.append((row["piece"], row["bucket"], _dump(*words_get, *pairs_get)))
    W.tidy()
    return pa.Table.from_arrays([pa.array([r[k] for r in out], f.type) for k, f in enumerate(ANSWER)], schema=ANSWER)


def _place(known: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each of ``wanted`` stands in the sorted ``known``, and whether it does."""
    if not len(known):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), dtype=bool)
    place = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    return place, known[place] == wanted


def _combine(rows: pa.Table, answers: pa.Table, worlds: list[dict], id_type) -> pa.Table:
    """The sums of each text of a piece from the answers of all buckets; ``worlds``: the kept ones, c and T of the start only."""
    kinds = pa.schema([("id", id_type), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()),
                       ("score", pa.float64())])
    got = {r["bucket"]: r["data"] for r in _rows(answers)}          # equal pieces ask, and are answered, alike
    n = len(worlds)
    parts = [_load(got[b], "i" * (2 + 4 * n)) for b in sorted(got)]
    have = [np.concatenate(x).astype(np.float64) for x in zip(*parts)] or [np.empty(0)] * (2 + 4 * n)
    of_words, of_pairs = have[:1 + 3 * n], have[1 + 3 * n:]
    count, world = of_words[0], worlds[-1]
    base = np.log10((count + 0.5) / (world["N"] + 0.5 * (world["V"] + 1)))
    out = []
    for row in _rows(rows):
        number, lengths = _load(row["data"], "ii")
        number = number.astype(np.int64)
        text = np.repeat(np.arange(len(lengths)), lengths)
        pairs, of = np.unique(pair_codes(number, text, len(count)), return_inverse=True)
        if int(number.max(initial=-1)) + 1 != len(count) or len(pairs) != len(of_pairs[0]):
            raise ValueError("the texts were dealt into other pieces when they were read again")
        word, context = pairs // (len(count) + 1), pairs % (len(count) + 1)
        p = np.zeros(len(pairs))
        for k, w in enumerate(worlds):
            c0, t0, tables = of_words[1 + 3 * k:4 + 3 * k]
            parent = (c0 - w["d0"] * t0 + (STRENGTH + w["d0"] * w["T0"]) / (w["V"] + 1)) / (STRENGTH + w["C0"])
            here = (STRENGTH + w["d"] * np.append(w["T"], tables)[context]) * parent[word]
            p += (here + of_pairs[0] - w["d"] * of_pairs[1 + k]) / (STRENGTH + np.append(w["c"], count)[context])
        score = np.log10(p / n)
        add = lambda x: np.bincount(text, weights=x, minlength=len(lengths))          # noqa: E731
        out.append(pa.Table.from_arrays(
            [pa.array(row["ids"], id_type), pa.array(lengths.astype(np.int64)),
             pa.array(add((count > 0)[number]).astype(np.int64)), pa.array(add(base[number])), pa.array(add(score[of]))], schema=kinds))
    return pa.concat_tables(out) if out else kinds.empty_table()


def score(docs: DataFrame, model: Model, row_id: str = "doc_id", text: str = "text",
          burn_in: int = BURN_IN, split: int = SPLIT) -> DataFrame:
    """``id, n_tokens, n_known, train_tokens, base_score, score`` (log10 probabilities of the whole text)."""
    spark = docs.sparkSession
    own = docs.select(F.col(row_id).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    kind = own.schema["id"].dataType
    id_type = to_arrow_type(kind)
    buckets, sc = model.buckets, spark.sparkContext
    owners, shared = sc.broadcast(model.owners), sc.broadcast((model.worlds, model.owners))
    asked = own.mapInArrow(lambda b: _asked(b, buckets, owners), "bucket int, piece string, data binary")
    # A bucket's training tokens tell how many parts its questions are cut into.
    parts = model.packs.withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("tokens") / split)).cast("int"))
    sizes = parts.select("bucket", "parts")
    if buckets * 64 <= BROADCAST:
        sizes = F.broadcast(sizes)
    asked = asked.join(sizes, "bucket", "left") \
        .withColumn("part", F.pmod(F.xxhash64("piece"), F.coalesce("parts", F.lit(1)).cast("long")).cast("int"))
    kept = kept_sweeps(len(model.worlds), burn_in)
    side = parts.select("bucket", "parts", *FIELDS).unionByName(model.met.join(sizes, "bucket"), allowMissingColumns=True) \
        .select("bucket", *FIELDS, "sweep", "home", "data", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    answered = asked.groupBy("bucket", "part").cogroup(side.groupBy("bucket", "part")).applyInArrow(
        lambda a, b: _answer(a, b, shared, burn_in), "piece string, bucket int, data binary")
    places = own.mapInArrow(_own, f"piece string, ids array<{kind.simpleString()}>, data binary")
    start = int(class_of(np.array([START]), model.classes)[0])
    last = [{**model.worlds[i], "c": int(model.worlds[i]["c"][start]), "T": int(model.worlds[i]["T"][start])} for i in kept]
    return places.groupBy("piece").cogroup(answered.groupBy("piece")).applyInArrow(
        lambda a, b: _combine(a, b, last, id_type),
        f"id {kind.simpleString()}, n_tokens long, n_known long, base_score double, score double") \
        .select("id", "n_tokens", "n_known", F.lit(last[-1]["N"]).cast("long").alias("train_tokens"), "base_score", "score")


def perplexity(log10_score: float, tokens: int) -> float:
    return 10 ** (-log10_score / tokens)
