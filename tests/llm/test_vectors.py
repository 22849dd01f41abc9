"""Pigeonhole join against all pairs."""

import math
from decimal import Decimal

import numpy as np
import pytest

from basketry.llm import vectors


def brute(rows):
    def usable(x, label):
        return label is not None and x is not None and any(c for c in x if c is not None) and all(c is not None and math.isfinite(c) for c in x)

    n = len(rows)
    parent, links = list(range(n)), [0] * n

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(n):
        for j in range(i):
            (_, a, la), (_, b, lb) = rows[i], rows[j]
            if la == lb and usable(a, la) and usable(b, lb) and len(a) == len(b):
                a, b = np.float32(a).astype(float), np.float32(b).astype(float)
                if (a == b).all() or a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.93:
                    links[i] += 1
                    links[j] += 1
                    parent[find(i)] = find(j)
    low = {}
    for k, (i, _, _) in enumerate(rows):
        if i is not None:
            low[find(k)] = min(low.get(find(k), 2**63), i)
    return sorted((-1 if i is None else i, links[k], low.get(find(k), -1)) for k, (i, _, _) in enumerate(rows))


def run(spark, rows):
    frame = spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], k, "x") for i, v, k in rows],
                                  "vec_id long, embedding array<float>, label int, n_links string")
    return vectors.linked_vectors(frame).collect()


def near(rng, centre, n, spread):
    x = centre + rng.normal(size=(n, len(centre))) * spread
    return x


@pytest.mark.parametrize("dim,fragment", [(64, 2000), (64, 7), (10, 2000), (3, 5), (1, 2000)])
def test_random(spark, monkeypatch, dim, fragment):
    monkeypatch.setattr(vectors, "FRAGMENT", fragment)
    rng = np.random.default_rng(dim)
    rows, vid = [], 0
    for c in range(14):
        centre = rng.normal(size=dim)
        for x in near(rng, centre, 9, rng.choice([0, 0.15, 0.25, 0.3])):
            rows.append((vid, x.tolist(), c % 2))
            vid += 1
    rows += [(vid, rows[0][1], 0), (vid + 1, rows[0][1], 1), (vid + 2, (np.array(rows[0][1]) * 3).tolist(), 0), (None, rows[3][1], 0)]
    rows += [(vid + 10, None, 0), (vid + 11, [0.0] * dim, 0), (vid + 12, [math.nan] * dim, 0), (vid + 13, [math.inf] + [0.0] * (dim - 1), 0),
             (vid + 14, [None] * dim, 0), (vid + 15, rows[0][1], None), (vid + 16, [], 0), (vid + 17, [-0.0] * dim, 0), (vid + 18, [1.0] * (dim + 1), 0)]
    got = run(spark, rows)
    assert sorted((-1 if r.vec_id is None else r.vec_id, r.n_links, -1 if r.component_id is None else r.component_id) for r in got) == brute(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got if r.vec_id is not None)


def test_empty(spark):
    assert run(spark, [(1, [1.0], 0)][:0]) == []


def test_one_common_vector(spark):
    rows = [(k, [1.0, 2.0, 3.0] if k % 3 else [float(k), 1.0, -1.0], 0) for k in range(150)]
    got = run(spark, rows)
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == brute(rows)


@pytest.mark.parametrize("kind,labels", [("double", (1.2, 1.7, 1.2)), ("string", ("a", "b", "a")), ("decimal(4,2)", (Decimal("0.25"), Decimal("0.50"), Decimal("0.25")))])
def test_labels_of_any_type(spark, kind, labels):
    vectors_ = ([1.0, 0.0, 0.0], [1.0, 0.01, 0.0], [1.0, 0.0, 0.01])
    rows = [(k, v, label) for k, (v, label) in enumerate(zip(vectors_, labels))] + [(3, vectors_[1], None)]
    got = vectors.linked_vectors(spark.createDataFrame(rows, f"vec_id long, embedding array<double>, label {kind}")).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == {0: (1, 0, True), 1: (0, 1, True), 2: (1, 0, False), 3: (0, 3, True)}
