"""Grouped prefix join against all pairs, and component search against union-find."""

import random
import re

import numpy as np
import pytest

from basketry.llm import jaccard
from basketry.llm.common import components


def brute_set(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    sets = [brute_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                parent[find(i)] = find(j)
    big = 2**63
    low = {}
    for k, (i, _) in enumerate(rows):
        low[find(k)] = min(low.get(find(k), big), big if i is None else i)
    return sorted((-1 if i is None else i, len(sets[k]), -1 if low[find(k)] == big else low[find(k)]) if sets[k]
                  else (-1 if i is None else i, 0, -1 if i is None else i) for k, (i, _) in enumerate(rows))


def check(frame, rows):
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_shingles, -1 if r.component_id is None else r.component_id)
                 for r in jaccard.similar_components(frame).collect())
    assert got == brute(rows)


def corpus(seed, n):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(60)]
    passage = [rng.choice(vocab) for _ in range(25)]
    base = [[rng.choice(vocab) for _ in range(rng.randint(20, 90))] for _ in range(n // 12)]
    rows = []
    for k in range(n):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            at = rng.randrange(len(w))
            if rng.random() < 0.5:
                w[at] = rng.choice(vocab)
            else:
                w.insert(at, rng.choice(vocab))
        if rng.random() < 0.3:
            w += passage
        rows.append((1000 + k, " ".join(w)))
    rng.shuffle(rows)
    return rows


EDGE = [(1, "A b C d e f"), (2, None), (3, ""), (4, " \t "), (5, "x " * 30000), (None, "a B c d e f"), (7, "a b c"), (7, "a  b\nc"), (8, "É b c d e"), (9, "é b c d e"),
        (10, "one"), (None, "lonely text of several words here")]


def test_edges(docs):
    check(docs(EDGE), EDGE)
    assert jaccard.similar_components(docs(EDGE).where("false")).count() == 0


@pytest.mark.parametrize("short,sample", [(32, 10_000), (2, 10_000), (2, 5)])
def test_random_corpora(docs, monkeypatch, short, sample):
    monkeypatch.setattr(jaccard, "SHORT_LIST", short)
    monkeypatch.setattr(jaccard, "ORDER_DOCS", sample)
    rows = corpus(short + sample, 260) + EDGE
    check(docs(rows), rows)


def test_one_of_each(docs):
    rows = corpus(4, 60) + EDGE
    kept = sorted({r.doc_id for r in jaccard.one_of_each(docs(rows)).collect() if r.doc_id is not None})
    assert kept == sorted({i for i, _, c in brute(rows) if i == c and i >= 0} | {7}) and len(kept) < 60
    assert jaccard.one_of_each(docs(rows)).columns == docs(rows).columns


def test_one_of_each_tells_rows_by_id_and_text(docs):
    def words(name, n=30):
        return " ".join(f"{name}{k}" for k in range(n))

    near = words("b") + " more"
    rows = [(3, words("b")), (5, words("a")), (5, near), (None, near), (None, words("c")), (None, words("c")), (None, words("c") + " x"),
            (9, words("d")), (9, words("d") + " x"), (9, words("d")), (2**63 - 1, words("e")), (None, words("e")),
            (None, None), (None, ""), (None, ""), (11, " \n"), (11, " \n"), (12, None)]
    got = [(r.doc_id, r.text) for r in jaccard.one_of_each(docs(rows)).collect()]
    full = [(i, t) for i, t in got if (t or "").strip()]
    assert sorted(((i, t[0]) for i, t in full), key=str) == sorted([(3, "b"), (5, "a"), (None, "c"), (9, "d"), (2**63 - 1, "e")], key=str)
    assert (5, words("a")) in full and (5, near) not in full and set(full) <= set(rows)
    bare = [(i, t) for i, t in got if not (t or "").strip()]
    assert sorted(bare, key=str) == sorted([(None, None), (None, ""), (None, ""), (11, " \n"), (12, None)], key=str)


def test_components(spark):
    rng = random.Random(1)
    edges = [(k, k + 1) for k in range(300)] + [(1000, 1000 + k) for k in range(1, 200)] + [(rng.randrange(2000, 2200), rng.randrange(2000, 2200)) for _ in range(150)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    got = {r.id: r.component_id for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_bitmaps_never_differ_more_than_their_sets():
    rng = np.random.default_rng(3)
    for n, extra, missing in ((1, 0, 0), (40, 3, 2), (63, 4, 0), (300, 0, 40), (1000, 100, 90), (5000, 1, 0)):
        x = np.unique(rng.integers(-2**63, 2**63 - 1, n, dtype=np.int64))
        y = np.unique(np.concatenate([x[missing:], rng.integers(-2**63, 2**63 - 1, extra, dtype=np.int64)]))
        apart = len(np.setxor1d(x, y))
        assert jaccard.differing(jaccard.parities(x), jaccard.parities(y)) <= apart
        assert jaccard.differing(jaccard.parities(y), jaccard.parities(x)) % 2 == apart % 2
    a, b = (np.unique(rng.integers(-2**63, 2**63 - 1, 500, dtype=np.int64)) for _ in range(2))
    assert jaccard.differing(jaccard.parities(a), jaccard.parities(b)) > 2 * 500 / 9
    assert jaccard.parities(np.zeros(0, np.int64)) == b"" and len(jaccard.parities(np.arange(65))) == 16


def test_only_texts_that_are_looked_for_move(spark):
    rows = spark.range(2000).selectExpr("id doc_id", "cast(id as string) text", "xxhash64(id) th")
    found = jaccard.maybe_of(rows, rows.where("doc_id % 100 = 0"))
    assert found.columns == rows.columns
    got = {r["doc_id"] for r in found.collect()}
    assert got >= set(range(0, 2000, 100)) and len(got) < 40
    assert jaccard.maybe_of(rows, rows.limit(0)).count() == 0


def test_unlike_texts_that_share_a_passage_are_not_moved(spark, monkeypatch):
    """20 texts of 190 pairs share a third of their shingles: bitmaps alone tell that no pair links."""
    words = [f"w{k}" for k in range(200)]
    rows = [(k, " ".join([*words[:195], f"x{k}"])) for k in range(5)] + [(100 + k, " ".join([*words[:60], *(f"y{k}_{j}" for j in range(140))])) for k in range(20)]
    compared = []
    one = jaccard.linked_pairs

    def counted(pairs, vertices, rows):
        compared.append(pairs.count())
        return one(pairs, vertices, rows)

    # without an order prefixes go by hash, so that texts with a common passage meet
    monkeypatch.setattr(jaccard, "frequency_order", lambda rows: (np.zeros(0, np.int64), np.zeros(0, np.int64)))
    monkeypatch.setattr(jaccard, "linked_pairs", counted)
    got = {r["doc_id"]: r["component_id"] for r in jaccard.similar_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {k: 0 if k < 5 else k for k, _ in rows}
    assert 4 <= sum(compared) <= 10
