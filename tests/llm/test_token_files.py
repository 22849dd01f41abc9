"""Token files: exact round trips, order, starts and random access."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from basketry.llm import token_files as tf

PATH = public_tokenizers.path("word_bpe_49k.json")
WHOLE = Tokenizer.from_file(PATH)


@pytest.mark.parametrize("top", [3, 40, 49_408, 70_000])
def test_shard_round_trip(top):
    rng = np.random.default_rng(top)
    for n_docs in (1, 2, 37):
        docs = [rng.integers(0, top, rng.integers(1, 400)).astype(np.uint32) for _ in range(n_docs)]
        docs[0] = np.tile(docs[0], 30)
        names = [None if k % 9 == 4 else k for k in range(n_docs)]
        payload = tf.pack_shard(names, np.concatenate(docs), np.array([len(d) for d in docs]))
        shard = tf.Shard(payload)
        got = list(shard.documents())
        assert [d for d, _ in got] == names
        assert all((a == b).all() and len(a) == len(b) for (_, a), b in zip(got, docs))
        for _ in range(20):
            k = int(rng.integers(n_docs))
            a, n = int(rng.integers(0, len(docs[k]))), int(rng.integers(0, 50))
            assert shard.document(k, a, n).tolist() == docs[k][a:a + n].tolist()
        assert shard.document(0).tolist() == docs[0].tolist()


def test_grammar_shrinks_repeats():
    ids = np.tile(np.arange(8, dtype=np.uint32), 1000)
    ends = np.zeros(8000, bool)
    ends[-1] = True
    rules, lengths, seq, _ = tf.compress(ids, ends, 8)
    assert len(seq) <= 4000 and len(rules) == len(lengths) and max(lengths) >= 4


def test_files(docs, spark):
    rng = random.Random(5)
    rows = [(1, "a b c"), (2, None), (3, ""), (4, " \n "), (5, "word " * 9000), (None, "no id"), (7, "same text"), (7, "same text"), (7, "other")]
    rows += [(100 + k, " ".join(rng.choice(["alpha", "beta", "gamma"]) for _ in range(k))) for k in range(60)]
    rng.shuffle(rows)
    got = tf.token_file_digest(docs(rows), PATH).collect()
    assert len(got) == len(rows)
    ids = {t: np.array(WHOLE.encode(t or "", add_special_tokens=False).ids + [1], "<u4") for _, t in rows}
    want = sorted(((-1 if i is None else i), len(ids[t]), zlib.crc32(ids[t].tobytes())) for i, t in rows)
    assert sorted(((-1 if r.doc_id is None else r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == want
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in ordered] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i))
    at = 0
    for r in ordered:
        assert r.start == at
        at += r.n_tokens


def test_small_shards_decode(docs, spark, tmp_path):
    rows = [(k, f"text number {k} " * (k % 7)) for k in range(200)]
    tf.write_files(docs(rows), PATH, str(tmp_path / "f"), shard_ids=50)
    files = tf.read_files(spark, str(tmp_path / "f"))
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in tf.decode(files).collect()}
    assert got == {i: WHOLE.encode(t, add_special_tokens=False).ids + [1] for i, t in rows}


def test_empty(docs):
    assert tf.token_file_digest(docs([(1, "a")]).where("false"), PATH).count() == 0


@pytest.mark.parametrize("first_id", [0, 40_000, 70_000])
def test_rounds_go_on_until_no_pair_is_frequent(first_id):
    rng = np.random.default_rng(4)
    passage = rng.integers(0, 300, 256)
    docs = [np.concatenate((rng.integers(300, 600, 3), passage, rng.integers(300, 600, 2))) + first_id for _ in range(40)]
    docs += [np.full(5000, 7) + first_id, np.arange(400) + first_id]
    ids, counts = np.concatenate(docs).astype(np.uint32), np.array([len(x) for x in docs])
    ends = np.zeros(len(ids), bool)
    ends[np.cumsum(counts) - 1] = True
    _, lengths, seq, last = tf.compress(ids, ends, int(ids.max()) + 1)
    pairs = np.stack((seq[:-1], seq[1:]))[:, ~last[:-1]]
    assert lengths.max() >= 256 and np.unique(pairs, axis=1, return_counts=True)[1].max() < tf.LEAST_USES
    shard = tf.Shard(tf.pack_shard(list(range(len(docs))), ids, counts))
    assert all(np.array_equal(x, y) for (_, x), y in zip(shard.documents(), docs))
