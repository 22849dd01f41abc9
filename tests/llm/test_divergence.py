"""Divergence by the tree of term rows against dense shares of every group and term."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from basketry.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = {c: chr(c + 32) for c in range(65, 91)}


def brute(rows, least=3, top=200):
    count, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        words = TERM.findall((text or "").translate(SMALL))
        groups[lang].add(source)
        count[lang, source].update(words)
        docs[lang].update(set(words))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least]
        v = len(kept)
        total = {t: sum(count[lang, s][t] for s in sources) for t in kept}

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 1) // (n + v) for t in kept}

        p, q = {s: shares(count[lang, s]) for s in sources}, shares(total)
        def f(a, b):
            return (a - b) * (a - b) // b

        for s in sources:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, f(p[s][t], q[t])) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(found[:most])]
    return sorted(out)


def run(spark, rows, **options):
    frame = spark.createDataFrame([(k % 3, t, lang, s, 1, "x", 2) for k, (t, lang, s) in enumerate(rows)],
                                  "doc_id long, text string, lang string, source string, n int, term string, o int")
    out = divergence.source_divergence(frame.repartition(4), **options)
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(map(tuple, out.collect()))


def sample(seed, n=160, langs=3, sources=6):
    rng = random.Random(seed)
    words = [f"w{'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10]}" for k in range(60)] + ["Été", "ÜBER", "naïve", "東京", "a" * 300]
    rows = []
    for _ in range(n):
        lang, source = f"l{rng.randrange(langs)}", f"s{min(rng.randrange(sources), rng.randrange(sources))}"
        text = " ".join(rng.choice(words[:rng.randrange(1, len(words))]) for _ in range(rng.randrange(40)))
        rows.append((rng.choice([text, text.upper(), text.replace(" ", "1"), text.replace(" ", "\x00")]), lang, source))
    return rows


def test_random_rows(spark):
    rows = sample(1)
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, least_docs=1, top_terms=5) == brute(rows, 1, 5)


def test_flushes_and_long_texts_in_pieces(spark, monkeypatch):
    rows = sample(2) + [("alpha beta " * 4000, "l0", "s0"), ("x" * 20000, "l0", "s1")] * 3
    monkeypatch.setattr(divergence, "HELD_TERMS", 20)
    monkeypatch.setattr(divergence, "PIECE", 64)
    monkeypatch.setattr(divergence, "COMBINATIONS", 3)
    assert run(spark, rows) == brute(rows)


def test_nulls_empty_texts_ties_and_repeats(spark):
    rows = [(None, None, None), ("", "en", "a"), ("one two", "en", "b"), ("two one", "en", "c"), ("two ONE 1", "en", "d"), (None, "en", None),
            ("x y z", "de", "only"), ("x", "fr", "a"), ("y", "fr", "b"), ("one two", "en", "b"), ("one two", "en", "b")]
    rows += [("same words here", "es", s) for s in "abcd" for _ in range(4)]
    assert run(spark, rows) == brute(rows)


def test_empty_tables(spark):
    assert run(spark, []) == []
    assert run(spark, [(None, "en", "a")]) == []


@pytest.mark.parametrize("seed", range(4))
def test_tree_equals_all_pairs_of_entries(seed):
    rng = random.Random(seed)
    known = {(lang, o, n): 10**6 * n // (o + 2) + lang + 7 for lang in range(2) for o in range(6) for n in range(1, 4)}
    base = {(lang, o): 3 + o + lang for lang in range(2) for o in range(6)}
    rows = sorted({(rng.randrange(2), tuple((o, rng.randrange(1, 4)) for o in sorted(rng.sample(range(6), rng.randrange(1, 7))))) for _ in range(50)})
    times = [rng.randrange(1, 5) for _ in rows]

    def f(a, b):
        return (a - b) ** 2 // b

    want = Counter()
    for (lang, items), m in zip(rows, times):
        for g in items:
            for h in items:
                if g != h:
                    a, b, x, y = known[lang, *g], known[lang, *h], base[lang, g[0]], base[lang, h[0]]
                    want[lang, g[0], h[0]] += m * (f(a, b) - f(a, y) - f(x, b) + f(x, y))
    size = np.array([len(i) for _, i in rows])
    flat = [(lang, o, n) for lang, items in rows for o, n in items]
    got = Counter()
    combinations = 0
    for lang, g, h, value in divergence.tree_corrections(
            np.array([r[0] for r in rows]), np.cumsum(size) - size, size, np.array(times), np.array([x[1] for x in flat]),
            np.array([x[2] for x in flat]), np.array([known[x] for x in flat]), np.array([base[x[:2]] for x in flat])):
        combinations += len(value)
        for key, v in zip(zip(lang.tolist(), g.tolist(), h.tolist()), value.tolist()):
            got[key] += v
    assert got == want
    nodes = {(lang, items[:k + 1]) for lang, items in rows for k in range(len(items))}
    assert combinations == 2 * sum(len(path) - 1 for _, path in nodes)  # each node meets each ancestor once, both ways
