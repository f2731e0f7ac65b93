"""Filter interaction audit: masks against plain Python, sums against a walk through every order."""

import itertools
import random
import re

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from strata.llm import audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_masks(rows):
    first = {}
    for i, t in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    out = []
    for i, t in rows:
        t = t or ""
        w = WORD.findall(t)
        fails = (len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
                 bool(re.search(r"[#$%&*|]", t)), i is not None and i > first[t])
        out.append((i, sum(f << k for k, f in enumerate(fails))))
    return sorted(out, key=str)


def texts():
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdeñ語") for _ in range(rng.randint(1, 9))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))            # noqa: E731
    licence = "LICENCE " + prose(300)
    out = [None, "", " \t\n", "A", "a#", "a" * 70000, prose(20000), "x y " * 200, "x\x0by\x1cz " * 100, "　" + prose(220)]
    out += [licence] * 150                                          # a third are one text
    out += [licence[:k] for k in range(0, 900, 30)]                 # prefixes of it
    out += [licence + prose(5) for _ in range(60)] + [prose(n) for n in range(150, 250, 3)]
    out += [prose(210).upper(), prose(210) + "A" * 30, "퟿\U0001f600" * 120, "\U0001f600" * 120]
    return out + rng.sample(out, 60)


def test_masks_equal_brute_force(spark):
    rng = random.Random(6)
    own = texts()
    ids = list(range(len(own)))
    rng.shuffle(ids)
    rows = list(zip(ids, own)) + [(None, own[20]), (None, "only here"), (3, own[ids.index(3)]), (7, "other text of the id")]
    rng.shuffle(rows)
    df = spark.createDataFrame([(i, t, 1, 2, "r") for i, t in rows], "doc_id long, text string, mask int, id int, row string")
    want = brute_masks(rows)
    for range_bytes, parts in ((audit.RANGE_BYTES, 1), (2000, 5), (50000, 40)):
        found = audit.masks(df.repartition(parts), range_bytes=range_bytes)
        assert sorted(((r.row.doc_id, r["mask"]) for r in found.collect()), key=str) == want


def test_ranges_follow_long_shared_prefixes(spark):
    rng = random.Random(7)
    rows = [("p" * 700 + "".join(rng.choice("abcd") for _ in range(300)),) for _ in range(400)] + [("q" * 900,)] * 300
    cuts = audit.bounds(spark.createDataFrame(rows, "text string"), 20000)
    assert cuts == sorted(cuts) and sum(len(c) > 700 for c in cuts) >= 10
    size = [sum(len(t) for t, in rows if (a is None or t.encode() >= a) and (b is None or t.encode() < b))
            for a, b in zip([None, *cuts], [*cuts, None])]
    assert max(s for s, b in zip(size, [*cuts, None]) if b is not None) <= 80000


def test_every_order_and_step(spark):
    rng = random.Random(8)
    rows = [(p, m, g, t) for p in ("", "de") for m in range(32) for g in (0, 1) for t in (0, 1) for _ in range(rng.randint(0, 3))]
    cells = spark.createDataFrame(rows, "part string, mask int, good long, toxic long").groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))
    found = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in audit.interactions(cells).collect()}
    assert len(found) == 2 * 120 * 5
    removed = {}
    for part in ("", "de"):
        for order in itertools.permutations("ABCDE"):
            left = [r for r in rows if r[0] == part]
            gone = []
            for step, letter in enumerate(order, 1):
                bit = 1 << "ABCDE".index(letter)
                now = [r for r in left if r[1] & bit]
                redundant = sum(bool(r[1] & bit) for r in gone)
                left = [r for r in left if not r[1] & bit]
                gone += now
                unique = sum(r[1] == bit for r in rows if r[0] == part)
                want = (len(left), len(now), redundant, unique, sum(r[2] for r in now), sum(r[3] for r in now))
                assert found[part, "".join(order), step][:6] == want
                removed[part, letter] = removed.get((part, letter), 0) + len(now)
    assert all(v[6] == removed[k[0], k[1][k[2] - 1]] for k, v in found.items())


def test_labels_parts_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "same", None, "x"), (2, "same", "", "x"), (3, "same", "de", "x"), (None, None, "de", "x")],
                                 "doc_id long, text string, lang string, quality string")
    labels = spark.createDataFrame([(1, 1, None, 5), (2, 0, 0, 5), (2, 1, 1, 5), (None, 1, 1, 5), (3, None, 1, 5)],
                                   "doc_id long, quality int, toxic int, part int")
    got = {(r.part, r.step): r for r in audit.audit(docs, labels).where("filter_order = 'EABCD'").collect()}
    assert [tuple(got["", 1])[3:] for _ in (1,)] == [(1, 1, 0, 0, 1, 1, 60)]
    assert tuple(got["de", 1])[3:] == (1, 1, 0, 0, 0, 1, 60) and got["de", 2].removed == 1
    assert audit.audit(docs.where("false"), labels).count() == 0
    assert audit.audit(docs, labels.where("false")).where("good_lost > 0 or toxic_lost > 0").count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(max_size=6).map(lambda b: bytes(x % 3 for x in b)), max_size=40))
def test_trie_holds_every_text_once(texts):
    trie = audit.Trie()
    for k, t in enumerate(texts):
        trie.insert(t).append((k, t))
    held = [x for x in trie.terminals() if x]
    assert sorted(map(sorted, held)) == sorted([(k, t) for k, t in enumerate(texts) if t == u] for u in set(texts))
