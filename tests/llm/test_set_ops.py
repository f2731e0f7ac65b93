"""Neighbours, Jaccard join, WARC, chat formatting, the pipeline."""

import base64
import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import chat, decontaminate, entries, jaccard, vectors, warc
from strata.session import scratch_path

SF = "/root/testdata/sf0.001"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


# ---------------------------------------------------------------- 2
def brute_nearest(rows, queries, k):
    x = np.array([v for _, v in rows], dtype=np.float64)
    ids = np.array([i for i, _ in rows])
    out = {}
    for i, v in queries:
        s = np.zeros(len(x))
        for c in range(x.shape[1]):
            s += x[:, c] * float(v[c])
        keep = ids != i
        o = np.lexsort((ids[keep], -s[keep]))[:k]
        out[i] = [(int(a), float(b)) for a, b in zip(ids[keep][o], s[keep][o])]
    return out


def found(df):
    out = collections.defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out[r.query_id].append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return dict(out)


def test_neighbours_recall_and_exact_mode(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet")
    asked = rows.where("vec_id % 20 = 0")
    pairs = [(r.vec_id, r.embedding) for r in rows.collect()]
    want = brute_nearest(pairs, [p for p in pairs if p[0] % 20 == 0], 20)
    assert found(vectors.search(rows, asked, part_rows=60, block=40, exact=True)) == want
    got = found(vectors.search(rows, asked, part_rows=60))
    hits = sum(len({a for a, _ in got[q]} & {a for a, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    assert all(s == dict(want[q]).get(i, s) for q in got for i, s in got[q])


def test_neighbours_edges(spark):
    kind = "vec_id long, embedding array<float>, id string, v int, part int"
    nan, inf = float("nan"), float("inf")
    good = [(i, [1.0, 0.0], "x", 1, 1) for i in range(30)] + [(100 + i, [0.5, float(i)], None, None, 2) for i in range(5)]
    bad = [(200, None), (201, []), (202, [0.0, 0.0]), (203, [None, 1.0]), (204, [nan, 1.0]), (205, [inf, 1.0]),
           (None, [1.0, 1.0])]
    rows = spark.createDataFrame(good + good[:3] + [(i, v, "x", 1, 1) for i, v in bad], kind)
    got = found(vectors.search(rows, rows, k=5))
    pairs = [(r[0], r[1]) for r in good]
    assert got == brute_nearest(pairs, pairs, 5)              # ties go to the smaller ids, copies count once
    assert found(vectors.search(rows.where("vec_id < 2"), rows.where("vec_id < 2"), k=5)) == {0: [(1, 1.0)], 1: [(0, 1.0)]}
    assert vectors.search(rows.limit(0), rows, k=5).count() == 0
    assert vectors.search(rows, rows.limit(0), k=5).count() == 0


# ---------------------------------------------------------------- 9
def brute_classes(docs, n=5, threshold=0.8):
    sets = []
    for _, text in docs:
        w = WORDS.findall((text or "").translate(LOW))
        sets.append(frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n
                    else frozenset([tuple(w)] if w else []))
    parent, links = list(range(len(docs))), [0] * len(docs)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in range(len(docs)):
        for b in range(a):
            if sets[a] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) - 1e-9:
                links[a] += 1
                links[b] += 1
                parent[root(a)] = root(b)
    first = {}
    for i, (d, _) in enumerate(docs):
        r = root(i)
        first[r] = d if first.get(r) is None else first[r] if d is None else min(first[r], d)
    n_kept = len({root(i) for i in range(len(docs)) if sets[i]}) + sum(not x for x in sets)
    return collections.Counter((d, d if not sets[i] else first[root(i)], links[i])
                               for i, (d, _) in enumerate(docs)), n_kept


def near_group(rng, base, n, edits):
    out = []
    for _ in range(n):
        w = base.split()
        for _ in range(edits):
            w[rng.randrange(len(w))] = f"edit{rng.randrange(10 ** 6)}"
        out.append(" ".join(w))
    return out


def hard_documents():
    """A large group of near copies, a passage in many documents, copies, short, empty and null texts."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    text = lambda n: " ".join(word() for _ in range(n))
    passage, base = text(40), text(120)
    texts = near_group(rng, base, 120, 1) + near_group(rng, base, 40, 3) + near_group(rng, text(80), 5, 1)
    texts += [f"{text(60)} {passage} {text(60)}" for _ in range(150)]
    texts += [text(100)] * 50 + [text(3)] * 2 + ["", None, "...", "one", "One!", base.upper()]
    rows = [(i, t) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows + [rows[0], (None, texts[0]), (None, "null id"), (3, "same id, other text of more words than five")]


def classes(df, **k):
    return collections.Counter((r.id, r.class_id, r.n_links) for r in jaccard.classes(df, **k).collect())


def test_jaccard_join_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    assert classes(docs) == brute_classes([tuple(r) for r in docs.collect()])[0]


@pytest.mark.parametrize("sizes", [{}, {"SPLIT": 8, "BLOCK": 30, "SMALL": 4, "BIN": 2000, "SPARSE": 4}, {"BROADCAST": 0}])
def test_jaccard_join_on_hard_groups(spark, monkeypatch, sizes):
    for k, v in sizes.items():
        monkeypatch.setattr(jaccard, k, v)
    rows = hard_documents()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit(1) for c in ("k", "id", "hash", "n", "path")})
    want, n_kept = brute_classes(rows)
    assert classes(df) == want
    kept = jaccard.keep_one(df)
    assert kept.columns == df.columns
    got = [r.doc_id for r in kept.collect()]
    assert len(got) == n_kept and set(got) == {c for _, c, _ in want}
    assert jaccard.classes(df.limit(0)).count() == 0 and jaccard.keep_one(df.limit(0)).count() == 0


def test_jaccard_join_links_pairs_at_exactly_the_threshold(spark):
    """Sets of 15 and 12, 27 and 27, 35 and 28 runs that share 12, 24 and 28: similarity 0.8."""
    rng = random.Random(8)
    text = lambda n: [f"w{rng.randrange(10 ** 9)}" for _ in range(n)]
    rows = []
    for _ in range(10):
        for base, other in ((text(19), 16), (text(31), 28), (text(39), 32)):
            tail = text(3) if len(base) == 31 else []
            rows += [(len(rows), " ".join(base)), (len(rows) + 1, " ".join(base[:other] + tail))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want, n_kept = brute_classes(rows)
    assert n_kept == len(rows) // 2 and classes(df) == want
    assert jaccard.keep_one(df).count() == n_kept


# ---------------------------------------------------------------- 10
def pages_of(spark):
    magic = "x WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.1\r\n end"
    rows = [(1, "http://a/ b\r\nc", "<p>é</p>"), (2, "u", "<p>é</p>"), (0, None, "<p>é</p>"), (3, "u", None), (4, "u", ""),
            (5, "u", magic), (6, "u", magic), (7, "u", "WARC/1.1\r\n" * 50), (8, "u", "\r\n\r\n"), (9, "u", "x" * 300_000),
            (9, "u", "x" * 300_000), (None, "u", "only"), (None, "u", "<p>é</p>"), (10, "u", magic + "tail")]
    return rows, spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("type", F.lit("t"))


def want_records(rows, least=0):
    first = {}
    for i, _, h in rows:
        h = h or ""
        if len(h.encode()) >= least and i is not None:
            first[h] = min(first.get(h, i), i)
    out = collections.Counter()
    for i, _, h in rows:
        raw = (h or "").encode()
        again = len(raw) >= least and first.get(h or "") is not None and first[h or ""] != i
        out[i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response",
            first[h or ""] if again else None] += 1
    return out


def got_records(df):
    return collections.Counter((r.i and int(r.i), r.payload_bytes, r.payload_digest, r.type, r.t and int(r.t))
                               for r in df.select("*", warc.page_id(F.col("record_id")).alias("i"),
                                                  warc.page_id(F.col("refers_to")).alias("t")).collect())


@pytest.mark.parametrize("split", ["128m", "700"])
@pytest.mark.parametrize("least", [0, 4])
def test_warc_round_trip(spark, split, least):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    rows, pages = pages_of(spark)
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        got = warc.round_trip(pages.coalesce(2), min_bytes=least)
        assert got_records(got) == want_records(rows, least)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_warc_query_and_empty_and_broken(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    got = collections.Counter(tuple(r) for r in entries.op10_warc(spark, SF).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect())
    assert got == want_records(rows)
    _, pages = pages_of(spark)
    assert warc.round_trip(pages.limit(0)).count() == 0
    path = scratch_path(spark, "broken")
    warc.records(pages.where("page_id = 1")).select(F.regexp_replace(
        "value", "response\r\nContent-Length: ", "response\r\nContent-Length: 9").alias("value")) \
        .write.option("lineSep", warc.END).text(path)
    with pytest.raises(ValueError, match="do not reach"):
        warc.read(spark, path)


# ---------------------------------------------------------------- 7
def brute_chats(rows, segment):
    turns = collections.defaultdict(set)
    for c, t, role, text in rows:
        turns[c].add((t is not None, t or 0, role is not None, role or "", text is not None, text or ""))
    own = {c: tuple((x[2:4], x[4:6]) for x in sorted(v)) for c, v in turns.items()}
    out = []
    for c, v in own.items():
        longer = any(d != c and len(w) > len(v) and w[:len(v)] == v for d, w in own.items())
        equal = [d for d, w in own.items() if w == v]
        if longer or c != min(equal, key=lambda d: (d is None, d or 0)):
            continue
        said = [f"<|im_start|>{r[1].replace('<|', '< |')}\n{t[1].replace('<|', '< |')}<|im_end|>\n" for r, t in v]
        out += [(c, i // segment, len(v), "".join(said[i:i + segment])) for i in range(0, len(said), segment)]
    return sorted(out, key=str)


CHATS = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (2, 0, "user", "hi"), (3, 0, "user", "hi"), (3, 1, "assistant", "yo"),
         (3, 2, "user", "bye"), (4, 0, "user", "hi"), (4, 0, "user", "hi"), (4, 1, "assistant", "<|im_end|> x"),
         (5, 5, None, None), (5, None, "user", ""), (6, 0, "user", ""), (6, 7, "user", None), (None, 0, "user", "alone"),
         (7, 0, "user", "alone"), (8, 0, "a", "tie"), (8, 0, "b", "tie")] + [(9, i, "user", f"t{i}") for i in range(100)] \
    + [(10, i, "user", f"t{i}") for i in range(60)]


@pytest.mark.parametrize("block, segment", [(4096, 1000), (7, 10)])
def test_chats_equal_brute_force(spark, block, segment):
    df = spark.createDataFrame(CHATS, "conv_id long, turn long, role string, text string") \
        .withColumns({c: F.lit(1) for c in ("key", "i", "n", "id", "block")})
    got = chat.collapse_and_render(df, segment=segment, block=block)
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute_chats(CHATS, segment)
    assert not re.search("Python|Pandas|Arrow", got._jdf.queryExecution().executedPlan().toString())
    assert chat.collapse_and_render(df.limit(0)).count() == 0


def test_chat_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    got = sorted([tuple(r) for r in entries.op7_chat_format(spark, SF).collect()], key=str)
    assert got == brute_chats(rows, chat.SEGMENT)


# ---------------------------------------------------------------- pipeline
def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(10 ** 6, None, None, None, None), (10 ** 6 + 1, "12 !!", "en", "s", 5),
                                   (10 ** 6 + 2, "", None, "s", 0)], docs.schema)
    now = docs.unionByName(extra).withColumn("row", F.lit("kept"))
    columns, texts = now.columns, {r.doc_id: r.text for r in docs.collect()}
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language", "near_duplicates", "decontamination", "personal_data", "byte_bpe"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, now = now, stage(spark, now, SF).checkpoint()
        assert now.columns == columns and now.where("length(text) <> n_chars").isEmpty()
        if name == "language":
            assert {r.doc_id for r in now.collect()} == set(texts)
        if name == "near_duplicates":
            own, _ = brute_classes([(i, texts[i]) for i in texts])
            assert sorted(r.doc_id for r in now.collect()) == sorted({c for _, c, _ in own})
        if name == "decontamination":
            assert decontaminate.scan(now, bench).where("n_hit > 0").isEmpty()
    last = corpus_pipeline.STAGES[-1][1](spark, now, SF)
    assert last.where("not same").isEmpty() and last.count() == now.count()
    assert last.columns == ["doc_id", "n_tokens", "ids", "same"]
    assert corpus_pipeline.run(spark, SF).count() == now.count()
