"""The language model's predictions are probabilities; seating of a tiny corpus against the model by hand."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import lm, words as W

TEXTS = ["a b a b c", "b a", "", "c c c a", "a b a b c", "d"]


def model_of(spark, **options):
    return lm.fit(spark.createDataFrame([(t,) for t in TEXTS], "text string"), **options)


def test_probabilities_after_a_context_sum_to_one(spark):
    model = model_of(spark)
    row = model.packs.collect()
    assert len(row) == 1
    own = lm.Bucket(row[0]["bucket"], row[0].asDict())
    states = list(zip(own.chain(model.worlds[:-1]), model.worlds))
    assert len(states) == lm.SWEEPS + 1
    for state, world in states:
        parent = own.parent(state, world)
        unknown = (lm.STRENGTH + world["d0"] * world["T0"]) / (world["V"] + 1) / (lm.STRENGTH + world["C0"])
        assert abs(parent.sum() + unknown - 1) < 1e-9
        for cls in [*np.unique(own.cls).tolist(), 12345]:
            p = (lm.STRENGTH + world["d"] * world["T"][cls]) * np.append(parent, unknown)
            here = np.flatnonzero(own.cls == cls)
            p[own.of[here]] += own.count[here] - world["d"] * state["t"][here]
            assert abs(p.sum() / (lm.STRENGTH + world["c"][cls]) - 1) < 1e-9


def test_scores_by_hand(spark):
    """The score of each text from a walk over its tokens and the averaged states, and the base by its formula."""
    model = model_of(spark)
    row = model.packs.first()
    own = lm.Bucket(row["bucket"], row.asDict())
    states = [x for i, x in enumerate(zip(own.chain(model.worlds[:-1]), model.worlds)) if i > lm.BURN_IN]
    place = {int(w): k for k, w in enumerate(own.words)}
    seen = np.add.reduceat(own.count, own.first)
    tokens = sum(len(t.split()) + 1 for t in TEXTS)
    ask = [*TEXTS, "a e a", "E", "A B"]
    got = {r.id: r for r in lm.score(spark.createDataFrame(list(enumerate(ask)), "doc_id int, text string"), model).collect()}
    for i, text in enumerate(ask):
        raw = np.frombuffer(text.encode(), np.uint8)
        word, cls, _ = lm.token_arrays(raw, np.array([0, len(raw)]), model.classes)
        base = score = 0.0
        for w, u in zip(word.tolist(), cls.tolist()):
            k = place.get(w)
            base += math.log10(((seen[k] if k is not None else 0) + 0.5) / (tokens + 0.5 * (len(place) + 1)))
            total = 0.0
            for state, world in states:
                p0 = own.parent(state, world)[k] if k is not None else \
                    (lm.STRENGTH + world["d0"] * world["T0"]) / (world["V"] + 1) / (lm.STRENGTH + world["C0"])
                p = (lm.STRENGTH + world["d"] * world["T"][u]) * p0
                for x in np.flatnonzero((own.of == k) & (own.cls == u)) if k is not None else []:
                    p += own.count[x] - world["d"] * state["t"][x]
                total += p / (lm.STRENGTH + world["c"][u])
            score += math.log10(total / len(states))
        r = got[i]
        assert (r.n_tokens, r.n_known) == (len(word), sum(w in place for w in word.tolist()))
        assert r.train_tokens == tokens and abs(r.base_score - base) < 1e-9 and abs(r.score - score) < 1e-5


def test_classes_grow_with_the_text(spark):
    assert [lm.classes_for(n) for n in (0, 1 << 20, 1 << 23, 1 << 26, 1 << 50)] == [1 << 16, 1 << 16, 1 << 18, 1 << 18, 1 << 18]
    x = np.array([0, 1, 65535, 65536, (1 << 24) - 1], np.uint32)
    assert lm.from_three(lm.three(x)).tolist() == x.tolist()
    texts = spark.range(60000).select(F.concat_ws(" ", F.col("id"), F.col("id") % 7, F.sha2(F.col("id").cast("string"), 256)).alias("text"))
    model = lm.fit(texts)
    assert model.classes > 1 << 16 and (model.worlds[-1]["c"] > 0).sum() > 1 << 16


def test_contexts_of_one_class_are_restaurants_of_their_own(spark, monkeypatch):
    """Every pair occurs once, so nothing is drawn between pairs: two classes for all contexts score as 65,536 do."""
    texts = spark.createDataFrame([(" ".join(f"w{(i * k) % 31}" for i in range(1, 31)),) for k in range(1, 12)], "text string")
    ask = spark.createDataFrame([(i, f"w{i} w{2 * i % 31} w{3 * i % 31} unseen w{i} w{i}") for i in range(31)], "doc_id int, text string")
    score = lambda m: {r.id: (r.n_known, round(r.base_score, 9), round(r.score, 6)) for r in lm.score(ask, m).collect()}
    wide = lm.fit(texts)
    expected = score(wide)
    assert wide.met.count() == 0 and len(set(expected.values())) > 10
    monkeypatch.setattr(lm, "CLASSES", 2)
    monkeypatch.setattr(lm, "MOST_CLASSES", 2)
    few = lm.fit(texts)
    assert few.classes == 2 and few.worlds[-1]["d"] == wide.worlds[-1]["d"]
    assert score(few) == expected


def test_tables_of_contexts_that_own_no_class(spark, monkeypatch):
    """Their sums over many buckets are those of all pairs, after each sweep; predictions after each sum to one."""
    monkeypatch.setattr(lm, "CLASSES", 4)
    monkeypatch.setattr(lm, "MOST_CLASSES", 4)
    texts = spark.createDataFrame([(" ".join(f"w{(i * i + k * i) % 23}" for i in range(60)),) for k in range(40)], "text string")
    model = lm.fit(texts, bucket_bytes=1000)
    assert model.buckets > 5 and model.classes == 4
    met = [r.asDict() for r in model.met.collect()]
    rows = [r.asDict() for r in model.packs.collect()]
    got, customers, mass = [{} for _ in model.worlds], {}, [{} for _ in model.worlds]
    seen = {}
    for row in rows:
        own = lm.Bucket(row["bucket"], row)
        seen.update(zip(own.words.tolist(), np.add.reduceat(own.count, own.first).tolist()))
        sums = lm.sums_of([r for r in met if r["bucket"] == row["bucket"]], len(model.worlds))
        for i, (state, world) in enumerate(zip(own.chain(model.worlds[:-1], sums), model.worlds)):
            parent = own.parent(state, world)
            for c, n, t in zip(own.cls.tolist(), own.count.tolist(), state["t"].tolist()):
                got[i][c] = got[i].get(c, 0) + int(t)
                mass[i][c] = mass[i].get(c, 0.0) + n - world["d"] * t
                customers[c] = customers.get(c, 0) + (n if i == 0 else 0)
            mass[i][None] = mass[i].get(None, 0.0) + parent.sum()
    far = [c for c in customers if c >= lm.SPAN]
    assert len(far) >= 15 and any(got[-1][c] != got[0][c] for c in far)
    for i, world in enumerate(model.worlds):
        total = mass[i][None] + (lm.STRENGTH + world["d0"] * world["T0"]) / (world["V"] + 1) / (lm.STRENGTH + world["C0"])
        for c in far:
            home = int(lm.bucket_of(np.array([c], np.uint64), model.buckets)[0])
            at_home = [r for r in met if r["bucket"] == home]
            tables = int(lm.far_tables(np.array([c], np.uint64), [dict(r, data=lm._dump(*only(r["data"], c))) for r in at_home if r["home"] < 0], i)[0])
            assert tables == got[i][c] and customers[c] == seen[c]
            p = mass[i][c] + (lm.STRENGTH + world["d"] * tables) * total
            assert abs(p / (lm.STRENGTH + customers[c]) - 1) < 1e-9
        for c in set(customers) - set(far):
            assert world["T"][c] == got[i][c] and world["c"][c] == customers[c]


def only(data, context):
    name, n = lm._load(data, "ii")
    return name[name == context], n[name == context]


def test_predictions_after_two_words_of_one_class(spark):
    """x0 follows a and y follows b: after b, y is likelier than x0, and after a the other way round."""
    words = np.array([f"u{i}" for i in range(3000)])
    raw = np.frombuffer(" ".join(words).encode(), np.uint8)
    hashes = lm.tokens(raw, np.array([0, len(raw)]))[0][:-1]
    cls = lm.class_of(hashes, lm.CLASSES)
    first = {}
    shared = next((first[c], i) for i, c in enumerate(cls.tolist()) if first.setdefault(c, i) != i)
    a, b = words[shared[0]], words[shared[1]]
    texts = [(f"{a} x{i}",) for i in range(30)] + [(f"{b} y",)]
    model = lm.fit(spark.createDataFrame(texts, "text string"))
    assert model.met.count() > 0
    got = {r.id: 10 ** r.score for r in lm.score(spark.createDataFrame(
        [(1, f"{b} y"), (2, f"{b} x0"), (3, f"{a} x0"), (4, f"{a} y")], "doc_id int, text string"), model).collect()}
    assert got[1] > 1.5 * got[2] and got[3] > 1.01 * got[4]
    assert model.worlds[-1]["c"][cls[shared[0]]] == 30


def test_equal_pieces_and_many_buckets(spark):
    texts = spark.createDataFrame([(1, "x y z " * 50)] * 3 + [(2, None), (None, "x")], "doc_id long, text string")
    one = lm.fit(texts.select("text"))
    many = lm.fit(texts.select("text"), bucket_bytes=100)
    a, b = (sorted((str(r.id), r.n_tokens, r.n_known, round(r.base_score, 9)) for r in lm.score(texts.repartition(4), m).collect())
            for m in (one, many))
    assert a == b and len(a) == 5 and many.buckets > 5


def test_all_operators_are_registered():
    import __spark_entry__ as E
    numbers = {int(k[2:].split("_")[0]) for k in E.queries() if k.startswith("op") and k[2].isdigit()}
    assert numbers == set(range(1, 14)) and "pipeline" in E.queries()
