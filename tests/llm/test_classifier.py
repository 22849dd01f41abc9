"""Naive-Bayes support vectors: held-out accuracy, the descent's optimum, edges."""

import os
import random
import zlib

import numpy as np
import pytest

from basketry.llm import classifier as C


def test_descent_reaches_the_optimum():
    """Duality gap of the hinge-loss problem closes."""
    rng = np.random.default_rng(0)
    ratio = rng.normal(size=30)
    rows = [np.flatnonzero(rng.random(30) < 0.3) for _ in range(80)]
    y = np.where([ratio[s].sum() + rng.normal() > 0 for s in rows], 1.0, -1.0)
    w, b = C.dual_coordinate_descent(rows, y, ratio, cost=0.5, epochs=2000)
    x = np.zeros((80, 31))
    for k, s in enumerate(rows):
        x[k, s] = ratio[s] / (np.sqrt((ratio[s] ** 2).sum()) or 1)
    x[:, 30] = 1
    full = np.append(w, b)
    primal = full @ full / 2 + 0.5 * np.maximum(0, 1 - y * (x @ full)).sum()
    for _ in range(300):
        other = full + rng.normal(size=31) * rng.choice([1e-3, 1e-2, 0.1])
        assert primal <= other @ other / 2 + 0.5 * np.maximum(0, 1 - y * (x @ other)).sum() + 1e-3


def test_features_are_sets():
    f = C.Features()
    a = f("the cat the cat")
    assert len(set(a)) == len(a) and (f("the cat the cat") == a).all() and not f.seen.any()
    assert len(f("")) == 0 and len(f("x")) >= 2
    assert set(f("a a b")) != set(f("a b a"))


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    if not os.path.exists(sf):
        pytest.skip("no test data")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = C.scores(docs, C.fit(docs, labels)).join(labels, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    good = [r.predicted for r in held if r.quality == 1]
    bad = [r.predicted for r in held if r.quality == 0]
    print(len(good), sum(good) / len(good), len(bad), 1 - sum(bad) / len(bad))
    assert sum(good) / len(good) > 0.98 and sum(bad) / len(bad) < 0.1


def test_edges(docs, spark):
    rng = random.Random(1)
    rows = [(k, ("bad ### " if k % 2 else "fine words here ") * rng.randint(1, 9)) for k in range(200)]
    rows += [(500, None), (501, ""), (None, "no id"), (502, "x" * 200000), (7, rows[7][1])]
    labels = spark.createDataFrame([(k, 1 - k % 2) for k in range(150)] + [(500, 1), (3, None), (None, 1)], "doc_id long, quality int")
    frame = docs(rows)
    model = C.fit(frame, labels)
    got = C.scores(frame, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert all(r.predicted == 1 - r.doc_id % 2 for r in got if r.doc_id is not None and r.doc_id < 200)
    kept = C.keep_good(frame, model)
    assert kept.columns == frame.columns and kept.count() == sum(r.predicted for r in got)
    assert C.scores(frame.where("false"), model).count() == 0
    none = C.fit(frame, labels.where("false"))
    assert {r.score for r in C.scores(frame, none).collect()} == {0.5}
    assert min(r.score for r in C.scores(frame, C.fit(frame, labels.where("quality = 1"))).collect()) > 0.9


def plain_model(rows):
    """Ratios by counting in Python, over (text, y)."""
    f = C.Features()
    counts, n = np.zeros((C.BUCKETS, 2)), np.zeros(2)
    for text, y in rows:
        counts[f(text), 1 - y] += 1
        n[1 - y] += 1
    smooth = counts + C.SMOOTH
    share = smooth / smooth.sum(axis=0)
    return np.log(share[:, 0] / share[:, 1])


def labelled(spark, rows):
    """Rows of (text, y) with ids outside the held-out fold, as documents and labels."""
    ids = [k for k in range(3 * len(rows) + 50) if zlib.crc32(str(k).encode()) % 5][:len(rows)]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in zip(ids, rows)], "doc_id long, text string")
    return docs, spark.createDataFrame([(i, y) for i, (_, y) in zip(ids, rows)], "doc_id long, quality int")


def test_scores_of_a_small_table_by_hand(spark):
    rng = random.Random(4)
    rows = [(" ".join(rng.choice("alpha beta gamma delta".split() if y else "beta gamma ### zzz".split()) for _ in range(rng.randint(1, 12))), y)
            for y in (0, 1) for _ in range(40)]
    rows += [rows[0]] * 5
    model = C.fit(*labelled(spark, rows))
    ratio = plain_model(rows)
    assert np.allclose(model.ratio, ratio)
    f, distinct = C.Features(), {}
    for text, y in rows:
        key = (y, f(text).tobytes())
        distinct[key] = distinct.get(key, 0) + 1
    found = [np.frombuffer(s, np.int64) for _, s in distinct]
    y, weight = np.array([1.0 if k else -1.0 for k, _ in distinct]), np.array(list(distinct.values()), float)
    w, b = C.dual_coordinate_descent(found, y, ratio, weight=weight, epochs=500)

    def loss(w, b):
        scaled = [ratio[s] / np.sqrt((ratio[s] ** 2).sum()) for s in found]
        return (w @ w + b * b) / 2 + C.COST * (weight * [max(0, 1 - k * (w[s] @ v + b)) for k, s, v in zip(y, found, scaled)]).sum()

    own = model.weights / np.where(model.ratio == 0, 1, model.ratio)
    assert loss(own, model.bias) <= 1.01 * loss(w, b) + 1e-6
    for text, _ in rows[:20]:
        s = f(text)
        z = model.slope * (model.weights[s].sum() / np.sqrt((ratio[s] ** 2).sum()) + model.bias) + model.offset
        assert abs(model.score(s) - 1 / (1 + np.exp(-z))) < 1e-12


def test_twenty_thousand_copies_of_a_row_take_no_class_away(spark):
    rng = random.Random(5)
    bad = [("### " * rng.randint(2, 30) + f"junk {k} $$$", 0) for k in range(30)]
    model = C.fit(*labelled(spark, [("fine words in a row", 1)] * 20_000 + bad))
    f = C.Features()
    assert model.score(f("fine words in a row")) > 0.9
    assert sum(model.score(f(t)) < 0.3 for t, _ in bad) >= 28


def test_a_class_of_three_rows_counts(spark, monkeypatch):
    monkeypatch.setattr(C, "FIT_ROWS", 200)
    rng = random.Random(6)
    good = [(" ".join(rng.choice("some plain words that make a text".split()) for _ in range(20)), 1) for _ in range(3000)]
    bad = [("### $$$ &&& ### $$$", 0), ("*** %%% ### ***", 0), ("&&& ### *** $$$ &&&", 0)]
    model = C.fit(*labelled(spark, good + bad))
    f = C.Features()
    assert all(model.score(f(t)) < 0.3 for t, _ in bad) and sum(model.score(f(t)) >= 0.3 for t, _ in good) > 2990


def test_the_sample_is_bounded_before_it_is_collected(spark):
    rows = [(k % 2, bytes([k % 251, 0, k // 251 % 251, 1])) for k in range(6000)] + [(1, b"\x01\x00")] * 500
    data = spark.createDataFrame([(y, bytearray(s)) for y, s in rows], "y int, slots binary")
    found, y, weight = C.fit_sample(data, 1000)
    assert len(found) <= 1000 and (y > 0).sum() <= 500 and (y < 0).sum() <= 500 and min((y > 0).sum(), (y < 0).sum()) > 350
    assert weight.min() == 1
    few, y, weight = C.fit_sample(data.where("slots = X'0100'"), 1000)
    assert len(few) == 1 and weight.tolist() == [1.0]
