"""Which filters of a filtering chain remove what, in every order (filter interaction audit).

One filter is exact duplication, judged over the whole table by radix tries: the range of
texts is cut at adaptive prefixes (``bounds``: 8 characters, and eight times as many wherever
more than a range's bytes share them), each range is one task, and the task inserts the full texts
into a compressed trie whose terminals hold the smallest id of their text.  Traversing it gives
the duplicate flags.  Before the exchange each task sends a text once: rows whose text it has sent with a
smaller id are duplicates already, so a text that a third of all rows hold goes to its range about
once a task.  The other filters look at one text alone.  Each row ends with a mask, bit k for filter k;
masks are counted by part in Spark, and every order and step is a sum over those counts.

Defined results: a null text is empty (and equal to empty texts); words are maximal runs without
ASCII white space; a row with a null id, or with the same id as the smallest of its text, is no
duplicate and a null id makes none; a null part is the empty string; a document is good (toxic) if any
label row of its id says so; an empty table gives no row; extra columns are ignored.
"""

from __future__ import annotations

import bisect
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from strata.llm import words as W

RANGE_BYTES = 32 << 20     # text of one range, about
PREFIX = 8                 # characters of the first prefixes; each further level has eight times as many
CUTS = 8                   # sampled cut points a range, thinned on the driver
BROADCAST = 2 << 20        # characters of prefixes that are sent to every task
SENT_BYTES = 16 << 20      # texts that a task remembers having sent

MIN_WORDS, MIN_DISTINCT, MAX_UPPER = 200, 50, 3      # limits of the filters A, B (per cent) and C (per cent)
SIGNS = b"#$%&*|"                                    # characters of the filter D
LETTERS = "ABCDE"                                    # E: the duplicates


class Trie:
    """A compressed radix trie over bytes; a node is [label, children by first byte, terminal]."""

    def __init__(self):
        self.root = [b"", {}, None]

    def insert(self, text: bytes) -> list:
        """The terminal of ``text``: a list the caller fills; new ones are empty."""
        node, at = self.root, 0
        while at < len(text):
            child = node[1].get(text[at])
            if child is None:
                child = node[1][text[at]] = [text[at:], {}, None]
                node = child
                break
            label = child[0]
            if not text.startswith(label, at):
                same = shared(label, text, at)
                middle = [label[:same], {label[same]: child}, None]
                child[0] = label[same:]
                node[1][text[at]] = child = middle
                label = middle[0]
            node, at = child, at + len(label)
        if node[2] is None:
            node[2] = []
        return node[2]

    def terminals(self) -> Iterator[list]:
        stack = [self.root]
        while stack:
            node = stack.pop()
            if node[2] is not None:
                yield node[2]
            stack.extend(node[1].values())


def shared(label: bytes, text: bytes, at: int) -> int:
    """Length of the common prefix of ``label`` and ``text[at:]``, which differ within the label."""
    low, high = 0, min(len(label), len(text) - at)
    while low < high:                    # label[:low] is shared
        middle = (low + high + 1) // 2
        if label[low:middle] == text[at + low:at + middle]:
            low = middle
        else:
            high = middle - 1
    return low


def flags(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bits of the filters A to D for the texts of one piece."""
    words = W.Words(raw, offsets, W.NOT_SPACE, fold=False)
    n_words = np.diff(words.first)
    hashes = words.hashes()
    order = np.lexsort((hashes, words.text))
    h, of = hashes[order], words.text[order]
    new = np.ones(words.n, dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (of[1:] != of[:-1])
    distinct = np.bincount(of[new], minlength=len(n_words))

    def count(kind: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(kind)])[offsets])

    upper, chars = count((raw >= 65) & (raw <= 90)), count((raw & 0xC0) != 0x80)
    signs = count(np.isin(raw, np.frombuffer(SIGNS, np.uint8)))
    failing = (n_words < MIN_WORDS, 100 * distinct < MIN_DISTINCT * n_words, 100 * upper > MAX_UPPER * chars, signs > 0)
    return sum(f.astype(np.int32) << k for k, f in enumerate(failing))


def bounds(docs: DataFrame, range_bytes: int) -> list[bytes]:
    """Sorted prefixes that cut the texts (column ``text``) into ranges of about ``range_bytes``.  They decide
    the balance only.  Reaches the driver: prefixes of more than ``range_bytes`` and ``CUTS`` sampled ones a range."""
    spark = docs.sparkSession
    found: dict[str, float] = {}
    longer: set[str] = set()
    work, size, heavy = docs.select("text", F.octet_length("text").cast("long").alias("bytes")), PREFIX, None
    while heavy is None or heavy:
        part = work
        if heavy:
            known = spark.createDataFrame([(p,) for p in heavy], "p string")
            if sum(map(len, heavy)) <= BROADCAST:        # else the texts are shuffled by their prefixes
                known = F.broadcast(known)
            part = work.withColumn("p", F.substring("text", 1, size // 8)).join(known, "p", "left_semi")
        sums = part.groupBy(F.substring("text", 1, size).alias("p")).agg(F.sum("bytes").alias("bytes"))
        # The chance of a prefix to be a cut point goes with its bytes.
        chance = F.pmod(F.xxhash64("p"), F.lit(1 << 20)) * float(range_bytes) < F.col("bytes") * float(CUTS << 20)
        rows = sums.where(chance | (F.col("bytes") > range_bytes)).collect()
        found |= {r.p: r.bytes for r in rows}
        heavy = [r.p for r in rows if r.bytes > range_bytes and len(r.p) == size]
        longer.update(heavy)
        size *= 8
    out, room, least = [], 0.0, range_bytes / CUTS     # a sampled prefix stands for the least weight
    for p in sorted(found):
        if p in longer or room + max(found[p], least) > range_bytes:
            out.append(p.encode())
            room = 0.0
        room += 0 if p in longer else max(found[p], least)
    return out


def _send(batches: Iterator[pa.RecordBatch], cuts: list[bytes]):
    """The filters of single texts; the text itself only where its range has to judge it."""
    sent: dict[bytes, int] = {}
    held, turn = 0, 0
    for batch in batches:
        raw, offsets = W.text_bytes(batch.column("text"))
        ids = batch.column("id").to_pylist()
        for i, j in W.pieces(offsets):
            own = raw[offsets[i]:offsets[j]]
            mask = flags(own, offsets[i:j + 1] - offsets[i])
            data, texts, ranges = own.tobytes(), [], []
            for k in range(i, j):
                text, x = data[offsets[k] - offsets[i]:offsets[k + 1] - offsets[i]], ids[k]
                if x is None or sent.get(text, x) < x:
                    mask[k - i] |= (x is not None) << 4
                    turn += 1
                    texts.append(None)
                    ranges.append(turn % (len(cuts) + 1))
                    continue
                if text not in sent:
                    held += len(text)
                    while held > SENT_BYTES and sent:
                        gone = next(iter(sent))
                        held -= len(gone)
                        del sent[gone]
                else:
                    del sent[text]           # the one seen last goes last
                sent[text] = x
                texts.append(text)
                ranges.append(bisect.bisect_right(cuts, text))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ranges, pa.int32()), batch.column("row").slice(i, j - i), batch.column("id").slice(i, j - i),
                 pa.array(mask, pa.int32()), pa.array(texts, pa.binary())],
                names=["range", "row", "id", "mask", "text"])
        W.tidy()


def _judge(batches: Iterator[pa.RecordBatch]):
    """The texts of one range in a trie; every row comes back without its text."""
    trie, rest = Trie(), []
    for b, batch in enumerate(batches):
        mask = batch.column("mask").to_numpy().copy()
        rest.append((batch.column("row"), mask))
        text, ids = batch.column("text"), batch.column("id").to_pylist()
        for k in np.flatnonzero(text.is_valid().to_numpy(zero_copy_only=False)).tolist():
            terminal = trie.insert(text[k].as_py())
            if not terminal:
                terminal.append(ids[k])
            elif ids[k] < terminal[0]:
                terminal[0] = ids[k]
            terminal.append((ids[k], b, k))
    for terminal in trie.terminals():
        for x, b, k in terminal[1:]:
            rest[b][1][k] |= (x > terminal[0]) << 4
    for row, mask in rest:
        yield pa.RecordBatch.from_arrays([row, pa.array(mask, pa.int32())], names=["row", "mask"])
    W.tidy()


def masks(docs: DataFrame, id: str = "doc_id", text: str = "text", keep: list[str] | None = None,
          range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Columns ``row`` (the document's columns ``keep``, the id by default) and ``mask`` (bit k: fails filter k)."""
    spark = docs.sparkSession
    own = docs.select(F.struct(*[F.col(c).alias(c) for c in keep or [id]]).alias("row"), F.col(id).cast("long").alias("id"),
                      F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    total = own.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    spread = total // int(spark.conf.get("spark.sql.shuffle.partitions"))
    range_bytes = min(range_bytes, max(1 << 20, spread))
    cuts = bounds(own, range_bytes) if total > range_bytes else []
    row = own.schema["row"]
    kind = T.StructType([T.StructField("range", T.IntegerType()), row, T.StructField("id", T.LongType()),
                         T.StructField("mask", T.IntegerType()), T.StructField("text", T.BinaryType())])
    shared_cuts = spark.sparkContext.broadcast(cuts)
    return own.mapInArrow(lambda batches: _send(batches, shared_cuts.value), kind) \
        .repartitionById(len(cuts) + 1, F.col("range")) \
        .mapInArrow(_judge, T.StructType([row, kind["mask"]]))


def _total(counts: Column, which) -> Column:
    """The sum of ``counts`` over the masks that ``which`` accepts."""
    return F.aggregate(F.filter(F.transform(counts, lambda n, m: F.struct(n.alias("n"), which(m).alias("ok"))), lambda x: x["ok"]),
                       F.lit(0).cast("long"), lambda s, x: s + x["n"])


def interactions(cells: DataFrame, letters: str = LETTERS) -> DataFrame:
    """From counted masks (``part, mask, n, good, toxic``) one row per part, order and step."""
    size = len(letters)
    arrays = [F.array(*[F.coalesce(F.sum(F.when(F.col("mask") == m, F.col(c))), F.lit(0)).cast("long")
                        for m in range(1 << size)]).alias(c) for c in ("n", "good", "toxic")]
    steps = [(i, k + 1, sum(1 << letters.index(x) for x in order[:k]), letters.index(order[k]), "".join(order))
             for i, order in enumerate(itertools.permutations(letters)) for k in range(size)]
    listed = F.from_json(F.lit("[%s]" % ",".join('{"o":"%s","s":%d,"e":%d,"f":%d}' % (o, s, e, f) for _, s, e, f, o in steps)),
                         "array<struct<o:string,s:int,e:int,f:int>>")
    x = cells.groupBy("part").agg(*arrays).select("*", F.explode(listed).alias("x"))
    orders = len(steps) // size
    bit, earlier = F.expr("shiftleft(1, x.f)"), F.col("x.e")
    seen = lambda m: m.bitwiseAND(earlier) != 0                             # noqa: E731  removed before this step
    fails = lambda m: m.bitwiseAND(bit) != 0                                # noqa: E731
    # A document goes by this filter in as many orders as put it before the others it fails.
    turns = F.transform("n", lambda n, m: F.when(fails(m), n * (F.lit(orders) / F.greatest(F.bit_count(m), F.lit(1))).cast("long")).otherwise(0))
    return x.select(
        "part", F.col("x.o").alias("filter_order"), F.col("x.s").alias("step"),
        _total(F.col("n"), lambda m: ~seen(m) & ~fails(m)).alias("kept"),
        _total(F.col("n"), lambda m: ~seen(m) & fails(m)).alias("removed"),
        _total(F.col("n"), lambda m: seen(m) & fails(m)).alias("redundant"),
        _total(F.col("n"), lambda m: m == bit).alias("unique_fails"),
        _total(F.col("good"), lambda m: ~seen(m) & fails(m)).alias("good_lost"),
        _total(F.col("toxic"), lambda m: ~seen(m) & fails(m)).alias("toxic_lost"),
        F.aggregate(turns, F.lit(0).cast("long"), lambda s, n: s + n).alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", part: str = "lang",
          range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The whole audit: the filters A to E over ``docs``, with ``labels`` (id, ``quality``, ``toxic``)."""
    found = masks(docs, id, text, [id, part], range_bytes).select(
        F.col("row")[id].alias("id"), F.coalesce(F.col("row")[part].cast("string"), F.lit("")).alias("part"), "mask")
    # Rows of one id, part and mask count together before they meet the labels.
    found = found.groupBy("id", "part", "mask").count()
    rated = labels.where(F.col(id).isNotNull()).groupBy(F.col(id).alias("id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    cells = found.join(rated, "id", "left").groupBy("part", "mask").agg(
        F.sum("count").alias("n"), F.sum(F.when(F.col("good"), F.col("count")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("count")).otherwise(0)).alias("toxic"))
    return interactions(cells)
