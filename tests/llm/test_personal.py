"""Base patterns against plain expressions, messages against all labelings, and what skip edges add."""

import hashlib
import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest

from basketry.llm import personal as P

EMPTY = hashlib.sha256(b"").hexdigest()
CARD = "4845168114407329"
OTHER = "4539578763621486"


def plain_luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (2 if k % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def plain(text):
    """The four patterns as they are written down."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), m.end(), 1))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append((m.start(), m.end(), 2))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        if 14 <= len(d) <= 19 and plain_luhn(d):
            out.append((m.start(), m.end(), 3))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((m.start(), m.end(), 4))
    return sorted(out, key=lambda s: (s[0], s[2]))


def pieces(rng):
    return rng.choice([CARD, CARD[:4] + " " + CARD[4:8] + "-" + CARD[8:], "97.51.17.173", "1.2.3.4.5.6.7.8.9", "256.1.1.1", "0001.2.3.4", "a@b.c", "x.y@mail.example.com",
                       "père.34@mail7.example.com", "+1 (017) 555-7713", "+49 1512 3456789", "(017) 555-7713", "@", "+", "4.0", "2024-01-15", "word", "é",
                       " ", " ", "\n", "-", ".", "(", ")", "7", "0" * 9, "a@b@c.d", "a@b.c@d.e", "%%", "(see 4.0)", "v2.", "deadbeef12"])


def learned_from(texts):
    return P.learned(P.counted(texts))


def corpus(rng, n=150):
    def phone():
        return f"+1 ({rng.randrange(100, 999)}) 555-{rng.randrange(1000, 9999)}"

    def card():
        while not plain_luhn(d := "4" + "".join(str(rng.randrange(10)) for _ in range(15))):
            pass
        return d

    out = []
    for k in range(n):
        p, c = phone(), card()
        out.append(f"call {p} or mail me.{k}@mail.example.com, card {c} from 10.{k % 200}.7.9 and again {p} then {c}. Version 4.0, item {rng.randrange(10**15, 10**16)}x, 3.")
        out.append(f"number {'9' * 15}{k % 10} of 2. and {k % 9}.0")
    return out


@pytest.mark.parametrize("seed", range(6))
def test_base_spans_are_those_of_the_patterns(seed):
    rng = random.Random(seed)
    for _ in range(400):
        text = rng.choice(["", " "]).join(pieces(rng) for _ in range(rng.randrange(12)))
        assert sorted(P.analysed(text).base, key=lambda s: (s[0], s[2])) == plain(text), text
    for _ in range(1500):
        text = "".join(rng.choice("a1290.@+-() %é") for _ in range(rng.randrange(40)))
        assert sorted(P.analysed(text).base, key=lambda s: (s[0], s[2])) == plain(text), text


@pytest.mark.parametrize("seed", range(5))
def test_tokens_hold_every_digit_and_at(seed):
    rng = random.Random(seed)
    for _ in range(500):
        text = "".join(rng.choice("a19.@+-() %é") for _ in range(rng.randrange(40)))
        spans = list(P.token_spans(text))
        assert all(b <= c for (_, b), (c, _) in zip(spans, spans[1:]))
        held = set(itertools.chain.from_iterable(range(a, b) for a, b in spans))
        assert {k for k, c in enumerate(text) if c in "0123456789@"} <= held


@pytest.mark.parametrize("seed", range(5))
def test_messages_are_exact_without_loops(seed):
    rng = np.random.default_rng(seed)
    n, labels = 6, 3
    unary = rng.normal(size=(n, labels))
    u = np.array([rng.integers(0, k) for k in range(1, n)])
    v = np.arange(1, n)
    pair = rng.normal(size=(n - 1, labels, labels))
    found = P.marginals(unary, u, v, pair, rounds=60)
    found = np.exp(found - found.max(axis=1, keepdims=True))
    found /= found.sum(axis=1, keepdims=True)
    want = np.zeros((n, labels))
    for y in itertools.product(range(labels), repeat=n):
        w = np.exp(sum(unary[k, y[k]] for k in range(n)) + sum(pair[e, y[u[e]], y[v[e]]] for e in range(n - 1)))
        want[range(n), y] += w
    want /= want.sum(axis=1, keepdims=True)
    assert np.allclose(found, want, atol=1e-6)


def spans_of(text, model):
    doc = P.analysed(text)
    found = P.token_labels([doc], model)[0]
    return [(text[a:b], P.KINDS[y - 1]) for a, b, y in P.added_spans(text, doc, found)]


def test_numbers_that_touch_others_are_found():
    model = learned_from(corpus(random.Random(1)))
    assert spans_of(f"first {CARD} then {OTHER} {CARD} end", model) == [(OTHER, "card"), (CARD, "card")]
    text = "reach +1 (826) 555-4081 190.137.223.204 now"
    assert (("+1 (826) 555-4081", "phone") in spans_of(text, model)) and P.analysed(text).base == [(24, 39, 2)]


def test_skip_edges_carry_labels_to_other_forms():
    model = learned_from(corpus(random.Random(2)))
    bare = P.Potentials(model.unary, model.unseen, model.chain, np.zeros_like(model.skip))
    text = "call +1 (826) 555-4081 today, or later 826.555.4081 again"
    assert spans_of(text, model) == [("826.555.4081", "phone")]
    assert spans_of(text, bare) == []  # alone it looks like no number that the corpus labels
    assert spans_of("only 826.555.4081 here", model) == []


def test_clean_texts_stay_clean():
    model = learned_from(corpus(random.Random(3)))
    for text in ("Licensed under CC BY-NC 4.0.", "version 3. of 2024-01-15", f"token = \"{'ab12' * 10}\"", "1234567812345678 and 1234567812345678", "user@host 12"):
        assert spans_of(text, model) == []


def run(spark, rows):
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, spans string, n_card int")
    out = P.personal_data(frame.repartition(3))
    assert out.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"]
    return out.collect()


def test_query_rows(spark):
    rng = random.Random(7)
    rows = list(enumerate(corpus(rng, 60)))
    rows += [(1000 + k, " ".join(pieces(rng) for _ in range(30))) for k in range(60)]
    rows += [(5000, None), (5001, ""), (None, rows[0][1]), (3, rows[3][1]), (5002, "x" * 4_000 + " a@b.c " + "1" * 5_000 + "@" * 1000 + "+1" * 3000)]
    model = learned_from(t or "" for _, t in rows)
    got = Counter(map(tuple, run(spark, rows)))
    want = Counter()
    for i, t in rows:
        base = plain(t or "")
        doc = P.analysed(t or "")
        more = P.added_spans(t or "", doc, P.token_labels([doc], model)[0])
        digest = P.listed(base)
        want[i, *(sum(s[2] == k for s in base) for k in (1, 2, 3, 4)), hashlib.sha256(digest.encode()).hexdigest(),
             P.listed([*base, *more]), len(more)] += 1
        assert set(base) <= {*base, *more} and not any(a < d and c < b for a, b, _ in more for c, d, _ in base)
    assert got == want


def test_empty_table_and_texts_without_numbers(spark):
    assert run(spark, []) == []
    assert [tuple(r) for r in run(spark, [(1, "no digits")])] == [(1, 0, 0, 0, 0, EMPTY, "", 0)]


def test_very_long_texts_take_linear_time():
    long = "x" * 2_000_000 + " a@b.c " + "1" * 500_000 + " " + "@" * 10_000 + "+1" * 50_000 + " 1.1.1.1" * 20_000 + " 1 2 3" * 50_000 + "+1" + ".1" * 50_000
    doc = P.analysed(long)
    assert len(doc.base) > 10_000 and len(P.token_labels([doc], learned_from(corpus(random.Random(4))))[0]) == len(doc.span)
