"""Incremental distances against plain nearest-centroid rounds in whole numbers."""

import hashlib
import math

import numpy as np
import pytest

from basketry.llm import clusters

COLUMNS = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def brute(rows, centroids=16, rounds=3, dim=64):
    kept = [(i, [math.floor(64 * float(np.float32(c))) for c in v]) for i, v in rows
            if v is not None and len(v) == dim and all(c is not None and math.isfinite(c) for c in v)]
    def place(r):
        return hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]

    centres = [x for _, x in sorted(kept, key=place)[:centroids]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(x, c)), k) for k, c in enumerate(centres)) for _, x in kept]

    for _ in range(rounds):
        found = assign()
        for k in range(len(centres)):
            own = [x for (_, x), (_, c) in zip(kept, found) if c == k]
            if own:
                centres[k] = [sum(col) // len(own) for col in zip(*own)]
    found = assign()
    inertia = [sum(d for d, c in found if c == k) for k in range(len(centres))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted((-1 if i is None else i, k, d, inertia[k], sum(inertia), digest[k]) for (i, _), (d, k) in zip(kept, found))


def run(spark, rows, **options):
    frame = spark.createDataFrame([(i, v, "x", 1, 2) for i, v in rows],
                                  "vec_id long, embedding array<float>, cluster string, dots int, x int")
    out = clusters.centroid_clusters(frame.repartition(3), **options)
    assert out.columns == COLUMNS
    return sorted((-1 if r[0] is None else r[0], *r[1:]) for r in out.collect())


def vector(rng, spread=1.0):
    return [float(c) for c in rng.normal(size=64) * spread]


def test_random_rows_ties_nulls_and_repeats(spark):
    rng = np.random.default_rng(2)
    rows = [(k, vector(rng, rng.choice([0.01, 0.5, 2]))) for k in range(120)]
    rows += [(k, [1.0] * 64) for k in range(200, 230)]  # equal vectors, a hot cluster
    rows += [rows[3], rows[3], (None, vector(rng)), (None, vector(rng)), (300, None), (301, [1.0] * 63), (302, [1.0] * 65),
             (303, [1.0] * 63 + [None]), (304, [math.nan] + [0.0] * 63), (305, [math.inf] + [0.0] * 63), (306, []), (307, [-0.0] * 64)]
    assert run(spark, rows) == brute(rows)


def test_fewer_vectors_than_centroids_and_empty_clusters(spark):
    same = [(k, [0.25] * 64) for k in range(20)]  # all start alike, so all but the first stay empty
    assert run(spark, same) == brute(same)
    few = [(1, [0.5] * 64), (2, [-0.5] * 64)]
    assert run(spark, few) == brute(few)
    assert run(spark, []) == [] and run(spark, [(1, None)]) == []


def test_other_sizes(spark):
    rng = np.random.default_rng(5)
    rows = [(k, [float(c) for c in rng.integers(-3, 4, 5) / 4]) for k in range(60)]
    assert run(spark, rows, dim=5, centroids=4, rounds=2) == brute(rows, 4, 2, 5)


def test_components_that_stay_are_not_multiplied(spark):
    state = clusters.first_state(spark.createDataFrame([(1, [3, 5])], "vec_id long, x array<int>"), np.array([[1, 1], [4, 4]]))
    moved = clusters.moved_state(state, np.array([[1, 1], [4, 4]]), np.array([[1, 2], [4, 4]])).collect()[0]
    assert moved["dots"] == [13, 32] and (moved["cluster"], moved["distance"]) == (1, 2)


def test_component_beyond_64_bits_is_refused(spark):
    with pytest.raises(Exception, match="64 bits"):
        run(spark, [(1, [3e8] * 64)])
