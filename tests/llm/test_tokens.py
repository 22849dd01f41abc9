"""Chunked ids equal the library's ids of whole texts."""

import glob
import os

import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from basketry.llm.tokens import WordEncoder, in_batches, strings

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
ENCODERS = {f: WordEncoder(public_tokenizers.path(f)) for f in FILES}
WHOLE = {f: Tokenizer.from_file(public_tokenizers.path(f)) for f in FILES}


def same(name, texts):
    ids, counts = ENCODERS[name].encode(texts)
    at = 0
    for t, n in zip(texts, counts):
        assert ids[at:at + n].tolist() == WHOLE[name].encode(t, add_special_tokens=False).ids, repr(t[:200])
        at += n
    assert at == len(ids)


@pytest.mark.parametrize("name", FILES)
def test_odd_texts(name):
    same(name, ["", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "\n", "a\n", "a\n b", " \n\na", "x<|endoftext|>y", "a <|endoftext|> b",
                "<|startoftext|> q", "don't we'll It's", "Ünter ÉTÉ ñ, ß.\nÇa", "é äb", "日本 語  x", "\x1c a \x85 b\xa0c   d",
                "a\x1c b", "a\x1c\x1c b", "1234 5.6,7", "x" * 5000, "tab\tsep \t x", "İstanbul ΑΣ ΑΣ.", "ǅ a,b.c d.,", "​ a", "a\n\nb c", "word.\nNext, and\nmore!", "x\n", "\nx", "a.\n\n\n b", "Ça\nÉté.", "a\r\nb", "a;b c; d?", "\x1e a",
                *(f"a{c}b {c}c{c}" for c in "\t\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u180e\u2000\u200a\u200b\u2028\u2029\u202f\u205f\u3000\ufeff")])


@pytest.mark.parametrize("name", FILES)
@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.text(alphabet=st.sampled_from("ab éÉ \n\t'.,!s0́ \x1f|<日"), max_size=30), max_size=5))
def test_random_texts(name, texts):
    same(name, texts)


@pytest.mark.parametrize("name", FILES)
def test_documents(name):
    path = "/root/testdata/sf0.001/documents.parquet"
    if not os.path.exists(path):
        pytest.skip("no test data")
    same(name, [t or "" for f in glob.glob(path) for t in pq.read_table(f)["text"].to_pylist()])


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr("basketry.llm.tokens.CACHE_BYTES", 500)
    for k in range(4):
        same("byte_bpe_50k.json", [f"a{k} b{k} c{k} d{k}"])
    assert len(ENCODERS["byte_bpe_50k.json"].place) < 12


def test_batches():
    assert list(in_batches([], 5)) == []

    got = list(in_batches(["aaa", "bbb", "c" * 99, ""], 5))
    assert [k for a, b in got for k in range(a, b)] == [0, 1, 2, 3]


def test_strings_of_a_column():
    words = pa.array(["é", "", "日本", "word", "x\x00y"] * 3, pa.large_string())
    assert strings(words) == words.to_pylist()
    assert strings(words[2:9].cast(pa.string())) == words.to_pylist()[2:9]
    assert strings(words[:0]) == []
    # the words of a batch are looked up as they are: no Arrow scalar for each
    asked = []
    encoder = WordEncoder(public_tokenizers.path(FILES[1]))
    encoder.place = type("Asked", (dict,), {"get": lambda self, *a: asked.append(a) or dict.get(self, *a)})()
    encoder.encode(["some words, some more"])
    assert {type(w) for w, _ in asked} == {str} and {w for w, _ in asked} == {"some", "words", "more"}
