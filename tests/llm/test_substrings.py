"""Substring dedup: the index and the removed words against brute force."""

import random
import re

import numpy as np
import pytest

from strata.llm import substrings

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    """(id, words, removed, kept text) by a dictionary of windows; rows equal in id and text are one document."""
    own = sorted({(i is not None, i or 0, t or "") for i, t in rows})
    seen, out = set(), {}
    for valid, i, t in own:
        w = WORD.findall(t)
        gone = set()
        for s in range(len(w) - 19):
            key = tuple(w[s:s + 20])
            if key in seen:
                gone.update(range(s, s + 20))
            seen.add(key)
        out[i if valid else None, t] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return sorted(((i, *out[i, t or ""]) for i, t in rows), key=str)


def got(df):
    return sorted(((r.row.doc_id, r.n_words, r.n_removed, r.text) for r in df.collect()), key=str)


def corpus():
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdeñ語#") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))            # noqa: E731
    line, passage, page = prose(25), prose(60), prose(400)
    few = lambda n: " ".join(rng.choice(["a", "b"]) for _ in range(n))              # noqa: E731
    out = [None, "", "  \n", "one", prose(19), prose(20), "x " * 500, "x " * 90 + "y", "a b c " * 100, "b c a " * 40]
    out += [page] * 40 + [page.replace(" ", "\n")] + [page + " " + prose(3) for _ in range(5)]
    for _ in range(60):                      # a third holds one line, in changing company
        out.append(" ".join([prose(rng.randint(0, 40)), line, prose(rng.randint(0, 40))]))
    for _ in range(20):
        a = rng.randint(0, 40)
        out.append(" ".join([prose(15), *passage.split()[a:a + rng.randint(15, 40)], prose(15)]))
    for _ in range(10):                      # a word changed
        w = page.split()
        w[rng.randrange(400)] = "changed"
        out.append(" ".join(w))
    out += [few(200) for _ in range(8)] + [prose(3000) + " " + passage, passage + " " + passage + " " + line]
    return out


@pytest.mark.parametrize("part_words,shard_words", [(substrings.PART_WORDS, substrings.SHARD_WORDS), (6000, 2500), (1500, 10 ** 6)])
def test_removed_words_equal_brute_force(spark, part_words, shard_words):
    own = corpus()
    rng = random.Random(part_words)
    ids = list(range(len(own)))
    rng.shuffle(ids)
    rows = list(zip(ids, own))
    rows += [rows[5], rows[30], (None, own[12]), (None, own[60])]
    rng.shuffle(rows)
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, part int, row string")
    found = substrings.remove_repeats(df.repartition(6), part_words=part_words, shard_words=shard_words)
    assert got(found) == brute(rows)
    assert found.schema["row"].dataType.names == ["doc_id", "part", "row"]


def test_order_of_texts_with_one_id_and_empty_table(spark):
    same = " ".join(str(k) for k in range(30))
    df = spark.createDataFrame([(1, same), (1, same + " more"), (2, None)], "doc_id long, text string")
    found = substrings.remove_repeats(df).collect()
    assert sorted(r.n_removed for r in found) == [0, 0, 30]
    assert substrings.remove_repeats(df.where("false")).count() == 0


@pytest.mark.parametrize("size,alphabet,depth", [(1, 1, 4), (60, 2, 4), (500, 3, 7), (800, 40, 20), (300, 300, 20), (40, 1, 20)])
def test_index_finds_all_places(size, alphabet, depth):
    rng = np.random.default_rng(size)
    text = np.append(rng.integers(1, alphabet + 1, size), 0)
    index = substrings.FMIndex(text, depth)
    for _ in range(60):
        at = int(rng.integers(0, size))
        pattern = text[at:min(at + int(rng.integers(1, depth + 1)), size)]
        low, high = index.first(pattern[-1:])
        for c in pattern[-2::-1]:
            low, high = index.before(low, high, np.array([c]))
        want = [k for k in range(size) if text[k:k + len(pattern)].tolist() == pattern.tolist()]
        assert sorted(index.sa[low[0]:high[0]].tolist()) == want
        if len(pattern) == depth:
            assert index.sa[low[0]] == want[0]
            low, high = index.shorter(low)
            less = [k for k in range(size) if k + depth - 1 <= size + 1 and (text[k:k + depth - 1].tolist() == pattern[:-1].tolist())]
            assert sorted(index.sa[low[0]:high[0]].tolist()) == less


def test_hot_runs_are_counted_over_all_texts(spark):
    rng = random.Random(1)
    rows = [(" ".join([*(str(rng.random()) for _ in range(20)), "the very same six words here"]),) for _ in range(300)]
    df = spark.createDataFrame(rows, "text string").repartition(5)
    assert len(substrings.hot_grams(df, 200, 200000)) == 1 and len(substrings.hot_grams(df, 301, 200000)) == 0
