"""Removed bytes against a set of all windows."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from basketry.llm import suffixes as S


def brute(rows, length=50):
    docs = [(2**63 - 1 if i is None else i, (t or "").encode()) for i, t in rows]
    least = {}
    for at, raw in docs:
        for k in range(len(raw) - length + 1):
            w = raw[k:k + length]
            least[w] = min(least.get(w, at), at)
    out = []
    for (i, _), (at, raw) in zip(rows, docs):
        gone = bytearray(len(raw))
        for k in range(len(raw) - length + 1):
            if least[raw[k:k + length]] < at:
                gone[k:k + length] = b"\1" * length
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        runs = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((-1 if i is None else i, len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def check(frame, rows):
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.repeat_digest(frame).collect())
    assert got == brute(rows)


def corpus(seed, n=60):
    rng = random.Random(seed)
    letters = "abcdé " if seed % 2 else "ab"

    def text(k):
        return "".join(rng.choice(letters) for _ in range(k))

    shared = [text(rng.choice([30, 49, 50, 51, 60, 90, 200])) for _ in range(9)] + ["ab" * 60, "x" * 120]
    rows = []
    for k in range(n):
        parts = [text(rng.randrange(120)) if rng.random() < 0.5 else rng.choice(shared) for _ in range(rng.randrange(6))]
        rows.append((rng.randrange(10_000) * 100 + k, "".join(parts)))
    rows += [(k + 1, t) for k, t in rng.sample(rows, 8)]
    rng.shuffle(rows)
    return rows


EDGE = [(1, "q" * 49), (2, None), (3, ""), (4, "q" * 50), (5, "q" * 20000), (None, "q" * 70), (None, "z" * 60), (7, "same text " * 12), (7, "same text " * 12),
        (8, "same text " * 12), (9, "é" * 40), (10, "xé" + "é" * 40)]


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_random(docs, seed):
    rows = corpus(seed) + EDGE
    check(docs(rows), rows)


def test_small_buckets(docs, monkeypatch):
    monkeypatch.setattr(S, "BUCKET_ANCHORS", 50)
    monkeypatch.setattr(S, "BUCKET_CONTEXTS", 7)
    monkeypatch.setattr(S, "CHUNK_BYTES", 300)
    rows = corpus(7) + EDGE
    check(docs(rows), rows)


def test_empty(docs):
    assert S.repeat_digest(docs(EDGE).where("false")).count() == 0


def test_long_texts_are_cut_without_loss(monkeypatch):
    raw = bytes(random.Random(0).choice(b"abc") for _ in range(1000))
    parts = S._cut_long(raw, 50, 120)
    starts = [at + k for at, p in parts for k in range(len(p) - 49)]
    assert starts == list(range(951)) and all(raw[at:at + len(p)] == p for at, p in parts)


def test_equal_windows_have_equal_anchors():
    rng = random.Random(1)
    raw = bytes(rng.choice(b"ab") for _ in range(4000))
    k, _, pos, start, count, _ = S.anchors([raw])
    owner = {}
    for kk, p, s, c in zip(k.tolist(), pos.tolist(), start.tolist(), count.tolist()):
        for w in range(s, s + c):
            assert w not in owner and w <= p <= w + 34
            owner[w] = (kk, p - w)
    assert sorted(owner) == list(range(len(raw) - 49))
    seen = {}
    for w, o in owner.items():
        assert seen.setdefault(raw[w:w + 50], o) == o


def test_text_column(docs):
    frame = docs([(1, "unique start " + "é" * 60), (2, "other words " + "é" * 60 + " end"), (3, "é" * 60), (4, "")])
    got = {r.doc_id: r.text for r in S.without_repeats(frame).collect()}
    assert got == {1: "unique start " + "é" * 60, 2: "other words" + " end", 4: ""}
    assert S.without_repeats(frame).columns == frame.columns


def test_columns_are_read_without_scalars():
    texts = pa.array(["é", "", "ab"])
    assert S._bytes(texts) == ["é".encode(), b"", b"ab"] and S._bytes(texts.cast(pa.large_string())[1:]) == [b"", b"ab"]
    kind = pa.list_(pa.struct([("start", pa.int64()), ("mask", pa.int64())]))
    marks = pa.array([None, [{"start": 3, "mask": 5}], [], [{"start": 9, "mask": -1}, {"start": 1, "mask": 1}]], kind)
    want = [[], [(3, 5)], [], [(9, 2**64 - 1), (1, 1)]]
    assert [list(zip(a.tolist(), m.tolist())) for a, m in S._marks(marks)] == want
    assert [list(zip(a.tolist(), m.tolist())) for a, m in S._marks(marks[1:])] == want[1:]
    # all starts of all contexts, one after another
    assert S.first_documents([b"a" * 51, b"b" * 50], np.array([7, 8])).tolist() == [7, 7, 8]
