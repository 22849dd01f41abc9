"""Unigram segmentation against plain dynamic programming, and exact round trips."""

import math
import os
from functools import lru_cache

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from basketry.llm import unigram as U

PATH = public_tokenizers.path("piece_bpe_32k.model")
VOCAB = U.Vocabulary.load(PATH)
ENC = U.Encoder(VOCAB)
SMALL = U.Vocabulary({p: (300 + k, s) for k, (p, s) in enumerate({
    "a": -1.5, "b": -2.0, "ab": -3.5, "ba": -3.0, "aba": -4.0, "▁": -1.0, "▁a": -2.5, "▁ab": -2.75,
    "▁▁": -1.25, "é": -2.0, "éa": -3.0}.items())}, list(range(256)))


@lru_cache
def plain_pieces(vocabulary):
    skip = set(vocabulary.byte_ids)
    return {t.decode(): i for i, t in vocabulary.text.items() if i not in skip}


def brute(vocabulary, text):
    """Viterbi over the whole text, no chunks, no trie."""
    if not text:
        return []
    pieces = plain_pieces(vocabulary)
    chars = [U.MARK] + [U.MARK if c == " " else ("\0lit" if c == U.MARK else c) for c in text]
    best = [(0.0, None, None)] + [(-math.inf, None, None)] * len(chars)
    for i in range(len(chars)):
        covered = False
        for j in range(i + 1, min(len(chars), i + vocabulary.longest) + 1):
            word = "".join(chars[i:j])
            if "\0" in word and any(c == "\0lit" for c in chars[i:j]):
                break
            if word in pieces:
                covered |= j == i + 1
                score = best[i][0] + vocabulary.score[pieces[word]]
                if score > best[j][0]:
                    best[j] = (score, i, pieces[word])
        if not covered and best[i][0] + vocabulary.unknown > best[i + 1][0]:
            best[i + 1] = (best[i][0] + vocabulary.unknown, i, None)
    out, at = [], len(chars)
    while at:
        _, i, p = best[at]
        c = U.MARK if chars[i] == "\0lit" else chars[i]
        out = ([p] if p is not None else [vocabulary.byte_ids[b] for b in c.encode()]) + out
        at = i
    return out


ODD = ["", "a", " ", "  ", "   a", "a  b ", "a b", "▁", "a▁b ▁▁ c", "日本語 x", "é\néa ab aba", "a" * 300, "ab " * 50, "\x00", "😀 ok", "tab\tx"]


@pytest.mark.parametrize("vocabulary", [SMALL, VOCAB], ids=["small", "file"])
def test_against_plain_viterbi(vocabulary):
    enc = U.Encoder(vocabulary)
    for t, ids in zip(ODD, enc.encode(ODD)):
        assert ids.tolist() == brute(vocabulary, t), repr(t)
        assert vocabulary.decode(ids.tolist()) == t


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab é▁\n日x"), max_size=20), max_size=4))
def test_random(rows):
    for vocabulary in (SMALL, VOCAB):
        for t, ids in zip(rows, U.Encoder(vocabulary).encode(rows)):
            assert ids.tolist() == brute(vocabulary, t)
            assert vocabulary.decode(ids.tolist()) == t


def test_trie_holds_just_its_keys():
    keys = {b"a": 1, b"abc": 2, b"\xff": 3, b"b" * 40: 4}
    trie = U.DoubleArray(keys)

    def find(key):
        state = 0
        for c in key:
            nxt = int(trie.base[state]) + c
            if nxt >= len(trie.check) or trie.check[nxt] != state or not nxt:
                return -1
            state = nxt
        return int(trie.value[state])

    assert {k: find(k) for k in keys} == keys
    assert all(find(k) == -1 for k in (b"", b"ab", b"c", b"abcd", b"b" * 39, b"b" * 41, b"\x00"))


def test_frames(docs):
    rows = [(k, t) for k, t in enumerate(ODD)] + [(50, None), (None, "no id"), (51, "same"), (51, "same"), (52, "long text " * 8000)]
    frame = docs(rows)
    got = U.segmentation_digest(frame, PATH).collect()
    assert len(got) == len(rows) and all(r.round_trip for r in got)
    back = sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in U.decode(U.encode(frame, PATH), PATH).collect())
    assert back == sorted((i is None, i or 0, t or "") for i, t in rows)
    assert U.segmentation_digest(frame.where("false"), PATH).count() == 0


SF = "/root/testdata/sf0.001"


def library_unigram(counts):
    """The library's own unigram model over the same pieces and scores."""
    from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

    own = U.Vocabulary.load(PATH, dict(counts))
    model = sentencepiece_model_pb2.ModelProto()
    with open(PATH, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = sentencepiece_model_pb2.TrainerSpec.UNIGRAM
    byte = set(own.byte_ids)
    for i, piece in enumerate(model.pieces):
        if i in own.text and i not in byte:
            piece.score = float(own.score[i])
    return SentencePieceProcessor(model_proto=model.SerializeToString())


@pytest.mark.skipif(not os.path.exists(SF), reason="no test data")
def test_learned_scores_against_the_librarys_unigram(spark):
    from collections import Counter

    from sentencepiece import SentencePieceProcessor

    frame = spark.read.parquet(f"{SF}/documents.parquet").repartition(3)
    rows = [r.text or "" for r in frame.collect()]
    counts = U.learned(frame, PATH)
    own, want = SentencePieceProcessor(model_file=PATH), Counter()
    for t in rows:
        for w in t.split(" "):
            if w and U.MARK not in w:
                want.update(own.encode(w))
    assert dict(counts) == want
    vocabulary, library = U.Vocabulary.load(PATH, dict(counts)), library_unigram(counts)
    found = U.Encoder(vocabulary).encode(rows)
    for t, ids in zip(rows, found):
        theirs = library.encode(t)
        if ids.tolist() != theirs:  # a tie, or the library's single precision: the scores are the same
            assert sum(vocabulary.score[ids]) == pytest.approx(sum(vocabulary.score[theirs]), rel=1e-6)
    assert sum(x.tolist() == library.encode(t) for x, t in zip(found, rows)) > 0.9 * len(rows)
    # about as many pieces as the file's own encoder needs
    assert sum(map(len, found)) <= 1.01 * sum(len(own.encode(t)) for t in rows)
    words = Counter(w for t in rows for w in t.split(" ") if w)
    same = sum(n for (w, n), ids in zip(words.items(), U.Encoder(vocabulary).encode(list(words))) if ids.tolist() == own.encode(w))
    assert same > 0.75 * sum(words.values())
    assert vocabulary.decode(U.Encoder(vocabulary).encode(["Hello world"])[0].tolist()) == "Hello world"


def test_scores_without_documents(docs):
    assert U.learned(docs([]), PATH) == () and U.learned(docs([(1, None), (2, "  ")]), PATH) == ()
    assert U.segmentation_digest(docs([(1, None), (2, " x ")]), PATH).where("round_trip").count() == 2
