"""Cross-tokenizer alignment against whole-text encoding and plain Python."""

import collections
import hashlib

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strata.llm import alignment, bpe, entries

SF = "/root/testdata/sf0.001"


def brute(rows):
    """Whole texts at once; groups and links by walking the bytes."""
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    table = bpe.byte_table()
    own = []
    for i, t in rows:
        full = (" " + (t or "")).encode()
        x = a.encode(" " + t, add_special_tokens=False) if t else None
        ia = [(k, bytes(table[c] for c in a.id_to_token(k))) for k in x.ids] if t else []
        ib = [(k, bytes([int(b.id_to_piece(k)[3:5], 16)]) if b.is_byte(k) else b.id_to_piece(k).replace("▁", " ").encode())
              for k in b.encode(t)] if t else []
        if b"".join(y for _, y in ia) != full or b"".join(y for _, y in ib) != full:
            ia = ib = []
        at_a = [k for k, (_, y) in enumerate(ia) for _ in y]
        at_b = [k for k, (_, y) in enumerate(ib) for _ in y]
        links = sorted(set(zip(at_a, at_b)))
        groups, last = [], (0, 0)
        for p in range(len(at_a)):
            if p + 1 == len(at_a) or (at_a[p + 1] != at_a[p] and at_b[p + 1] != at_b[p]):
                groups.append((ia[last[0]:at_a[p] + 1], ib[last[1]:at_b[p] + 1]))
                last = at_a[p] + 1, at_b[p] + 1
        text = ";".join("|".join(",".join(str(k) for k, _ in side) for side in g) for g in groups)
        own.append((i, len(ia), len(ib), len(groups), [(ia[x][0], ib[y][0]) for x, y in links],
                    hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    n = collections.Counter(x for r in own for x in r[4])
    most = collections.Counter()
    for (_, y), c in n.items():
        most[y] = max(most[y], c)
    return [(i, na, nb, g, len(li), sum(n[x] == most[x[1]] for x in li), sum(n[x] for x in li), sha)
            for i, na, nb, g, li, sha in own]


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_registered_query_equals_whole_texts(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert got(entries.op13_token_alignment(spark, SF)) == sorted(brute(docs), key=str)


EDGES = [None, "", " ", "  ", "a", " a", "a ", "\n", "\t \n x", "▁", "a▁b c", "<s> </s> <unk> <|endoftext|>", "<0x41>",
         "　wide　space x", "x  y   z", "naïve façade ﬁ ½ é ́", "😀😀 👩‍👩‍👧 x", "日本語 テキスト", "\x00 \x01a \x7f",
         "a\r\nb", "é" * 5000, "ab" * 20000, "don't can't I'll", "​ ﻿ x", "123456 7 8.90", " ", "  indented\n\n    more"]


def test_edges_blocks_and_extra_columns(spark):
    rows = [(k, t) for k, t in enumerate(EDGES)] + [(None, "null id"), (4, "a"), (4, "a")]
    df = spark.createDataFrame([(i, t, 1, "x", "y") for i, t in rows], "doc_id long, text string, n_a int, links string, row string")
    want = sorted(brute(rows), key=str)
    for block_pairs in (alignment.BLOCK_PAIRS, 40):
        found = alignment.aligned_and_scored(df.repartition(3), digest=True, block_pairs=block_pairs)
        assert got(found.select("row.doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")) == want
    text = alignment.align(df.where("doc_id = 12"), keep=["doc_id"]).first()
    assert text.n_links == text.n_a + text.n_b - text.n_groups and text.groups.count(";") == text.n_groups - 1
    assert alignment.aligned_and_scored(df.where("false")).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([1, 1, 1, 2, 3]), min_size=1, max_size=60), st.lists(st.sampled_from([1, 1, 1, 2, 5]), max_size=60))
def test_diagonal_runs_leave_the_irregular_groups(x, y):
    ea = [sum(x[:k + 1]) for k in range(len(x))]
    eb = [e for e in (sum(y[:k + 1]) for k in range(len(y))) if e < ea[-1]] + [ea[-1]]
    common = sorted({*ea} & {*eb})
    want, i, j = [], 0, 0
    for e in common:
        a, b = ea.index(e), eb.index(e)
        if (a, b) != (i, j):
            want.append((i, a, j, b))
        i, j = a + 1, b + 1
    assert list(alignment.irregular(ea, eb)) == want


def test_packs(spark):
    import numpy as np
    for keys, counts in (([], []), ([5], [1]), ([0, 7, 1 << 40], [1, 2, 1 << 33])):
        a, b = alignment.unpack(alignment.pack(np.array(keys, np.int64), np.array(counts, np.int64)))
        assert a.tolist() == keys and b.tolist() == counts
