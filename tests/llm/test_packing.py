"""Packing against the library's ids and the bounds of any packing."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from basketry.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
WHOLE = Tokenizer.from_file(PATH)
EDGE = [(1, "a b c"), (2, None), (3, ""), (4, " \n "), (5, "word " * 9000), (None, "a b c"), (7, "same"), (7, "same"),
        (9, "hello " * 2047), (10, "hello " * 2046), (11, "hello " * 2048)]


def ids_of(text):
    return WHOLE.encode(text or "", add_special_tokens=False).ids + [0]


def test_pieces_and_places(docs):
    rows = EDGE + [(100 + k, "some words " * (k % 90)) for k in range(80)]
    got = packing.packing_digest(docs(rows), PATH).collect()
    want = Counter()
    for i, t in rows:
        ids = ids_of(t)
        head = len(ids) % 2048 or 2048
        for p, at in enumerate([0, *range(head, len(ids), 2048)]):
            part = ids[at:at + (head if p == 0 else 2048)]
            want[i, p, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    seqs = defaultdict(list)
    for r in got:
        seqs[r.sequence_id].append((r.offset, r.length))
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(seqs) <= math.ceil(sum(r.length for r in got) / 2048) + 2


def test_sequences_hold_the_ids(docs):
    rows = EDGE + [(50 + k, "x y " * k) for k in range(40)]
    got = packing.packed_sequences(docs(rows), PATH).collect()
    assert all(len(r.ids) == 4 * r.length <= 8192 for r in got)
    have = Counter(np.concatenate([np.frombuffer(r.ids, "<u4") for r in got]).tolist())
    assert have == Counter(i for _, t in rows for i in ids_of(t))


def test_rounds_place_each_rank_once():
    rng = random.Random(2)
    for _ in range(60):
        cap = rng.choice([1, 2, 7, 50, 2048])
        counts = {rng.randint(1, cap): rng.randint(1, 500) for _ in range(rng.randint(0, 30))}
        flows, opened = packing.plan_rounds(counts, cap)
        ranks, fill = defaultdict(list), defaultdict(list)
        for size, rank, n, first, offset in flows:
            ranks[size] += range(rank, rank + n)
            for s in range(first, first + n):
                fill[s].append((offset, size))
        assert {s: sorted(v) for s, v in ranks.items()} == {s: list(range(n)) for s, n in counts.items()}
        for parts in fill.values():
            at = 0
            for offset, size in sorted(parts):
                assert offset == at
                at += size
            assert at <= cap
        assert sorted(fill) == list(range(opened))
        assert opened <= 1.7 * math.ceil(sum(s * n for s, n in counts.items()) / cap) + 1


def test_empty_table(docs):
    assert packing.packing_digest(docs([(1, "a")]).where("false"), PATH).count() == 0


def test_a_class_with_all_rows(spark):
    """One length for every row: ranks come from salted parts."""
    from pyspark.sql import functions as F
    rows = spark.range(3000).select(F.lit(5).alias("doc_id"), F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"), F.lit(600).cast("long").alias("length"), F.col("id").alias("offset"))
    got = packing.pack(rows).groupBy("sequence_id").agg(F.count("*").alias("n"), F.sum("length").alias("s"), F.countDistinct("offset").alias("d")).collect()
    assert len(got) == 1000 and all(r.n == 3 and r.d == 3 for r in got)
