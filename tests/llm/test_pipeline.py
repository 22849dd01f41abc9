"""The pipeline against a plain version, stage by stage."""

import os
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from basketry.llm import classifier
from tests.llm.test_jaccard import brute as jaccard_brute
from tests.llm.test_native import brute as rule_metrics

SF = "/root/testdata/sf0.001"


def cut_repeats(rows, length=50):
    least = {}
    for i, t in rows:
        raw = t.encode()
        for k in range(len(raw) - length + 1):
            w = raw[k:k + length]
            least[w] = min(least.get(w, i), i)
    out = []
    for i, t in rows:
        raw = t.encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - length + 1):
            if least[raw[k:k + length]] < i:
                gone[k:k + length] = b"\1" * length
        kept, at = "", 0
        for c in t:
            n = len(c.encode())
            kept += "" if all(gone[at:at + n]) else c
            at += n
        if kept or not t:
            out.append((i, kept))
    return out


@pytest.mark.skipif(not os.path.exists(SF), reason="no test data")
def test_pipeline(spark):
    import corpus_pipeline as P

    assert [n for n, _ in P.STAGES] == ["quality_classifier", "quality_rules", "ngram_jaccard", "suffix_dedup", "best_fit_packing"]
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = classifier.fit(docs, labels)
    good = {r.doc_id for r in classifier.scores(docs, model).collect() if r.predicted}
    rows = [(r.doc_id, r.text or "") for r in docs.collect() if r.doc_id in good]

    def passes(t):
        words, chars, symbols, dup, repeats = rule_metrics(t)
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        return not (words < 20 or 100 * repeats > 30 * words or 10 * symbols > 3 * words or 100 * dup > 50 * len(lines)
                    or chars < 2 * words or chars > 20 * words)

    rows = [(i, t) for i, t in rows if passes(t)]
    stay = {i for i, _, c in jaccard_brute(rows) if i == c}
    rows = cut_repeats([(i, t) for i, t in rows if i in stay])
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for i, t in rows:
        ids = whole.encode(t, add_special_tokens=False).ids + [0]
        head = len(ids) % 2048 or 2048
        for p, at in enumerate([0, *range(head, len(ids), 2048)]):
            part = ids[at:at + (head if p == 0 else 2048)]
            want.append((i, p, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    got = P.run(spark, SF).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    assert 0 < len(rows) < 200


def test_stages_keep_columns_and_take_edges(spark, docs):
    import corpus_pipeline as P

    frame = docs([(1, None), (None, "no id " * 30), (3, ""), (4, "long " * 9000), (5, "plain words of a text " * 3), (5, "plain words of a text " * 3)])
    for rows in (frame, frame.where("false")):
        for name, stage in P.STAGES[:-1]:
            out = stage(spark, rows, SF)
            assert out.columns == frame.columns
            out.count()
        P.STAGES[-1][1](spark, rows, SF).count()


def test_stages_leave_columns_of_any_name_alone(spark):
    import corpus_pipeline as P

    names = ["t1", "t2", "least", "marks", "_at", "at", "_text", "plain", "copy", "_copy", "_marks", "_id", "id", "_th", "th", "_failed_rule", "failed_rule",
             "comp", "n", "vid", "rank", "a.b", "score", "Held_Out"]
    text = "plain words of a text that a reader likes to see on many pages of a book and of another one"
    rows = [(k, f"{text} number {k} and {k * 7}, then more of it for everyone here" if k % 3 else text) for k in range(9)]
    frame = spark.createDataFrame([(i, t, *[f"{n} {i}" for n in names]) for i, t in rows], "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names))
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, frame, SF)
        assert out.columns == frame.columns
        found = out.collect()
        assert found and all(r[n] == f"{n} {r.doc_id}" for r in found for n in names)
    P.STAGES[-1][1](spark, frame, SF).count()
