"""Unigram segmentation with a SentencePiece vocabulary, and its inverse.

The pieces of a model file are laid out as a double-array trie over UTF-8
bytes, with log scores. A file of merges holds ranks in the place of scores, so
``learned`` counts the pieces that the file's own encoder uses over all
documents; a piece's score is the logarithm of its share. A text's spaces become whitespace
markers, one marker leads the text, and the best-scoring sequence of pieces is
found by Viterbi; of equal scores the one whose last piece is longer wins. A
character that no piece covers costs ``UNKNOWN`` below the lowest score and is
written as byte pieces; a literal marker in the text is written as bytes too,
so decoding gives the text back exactly.

A marker run starts a piece or makes one up, so a text is cut before each run
(the cuts that no piece crosses) and each distinct chunk is segmented once;
Viterbi runs over many chunks side by side.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import texts
from .tokens import CACHE_BYTES, WORD_BYTES, _spans, in_batches

MARK = "▁"
#: How far below the lowest piece an uncovered character scores.
UNKNOWN = 10.0
#: Added to every piece's count.
SMOOTH = 0.5
#: Mark of a finished row on the way back, and cells of the tables of one Viterbi run.
DONE, TABLE_CELLS = -2, 4_000_000
_CHUNKS = re.compile(r" *[^ ]+| +$")


class DoubleArray:
    """A trie in two arrays: the child of state ``s`` by byte ``c`` is ``base[s] + c`` if ``check`` there is ``s``."""

    def __init__(self, keys: dict[bytes, int]):
        children: list[dict[int, int]] = [{}]
        value = [-1]
        for key, v in keys.items():
            node = 0
            for c in key:
                nxt = children[node].get(c)
                if nxt is None:
                    nxt = children[node][c] = len(children)
                    children.append({})
                    value.append(-1)
                node = nxt
            value[node] = v
        used = bytearray(4 * len(children) + 4096)
        used[0] = 1
        base, check = {}, {}
        queue, at, wide = [(0, 0)], 1, 1  # (node, state); first free place; where the last wide node's search ended
        states = [0] * len(children)
        for node, state in queue:
            states[node] = state
            labels = sorted(children[node])
            if not labels:
                continue
            at = used.find(0, at)
            place = max(at, wide if len(labels) > 1 else 0, labels[0] + 1)
            while True:  # the next free place for the first child with room for the others
                place = used.find(0, place)
                b = place - labels[0]
                if b + 256 >= len(used):
                    used += bytes(len(used))
                if not any(used[b + c] for c in labels):
                    break
                place += 1
            if len(labels) > 1:
                wide = place
            base[state] = b
            for c in labels:
                used[b + c] = 1
                check[b + c] = state
                queue.append((children[node][c], b + c))
        end = used.rfind(1) + 257
        self.base, self.check, self.value = np.zeros(end, np.int32), np.full(end, -1, np.int32), np.full(end, -1, np.int32)
        for array, found in ((self.base, base), (self.check, check), (self.value, dict(zip(states, value)))):
            array[list(found)] = list(found.values())

    def step(self, state: np.ndarray, byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states, and whether they exist."""
        nxt = self.base[state] + byte
        return nxt, (self.check[nxt] == state) & (nxt > 0)


class Vocabulary:
    """Pieces and log scores, ready for encoding; ``byte_ids`` and ``pieces`` are for decoding."""

    def __init__(self, pieces: dict[str, tuple[int, float]], byte_ids: list[int]):
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("a piece goes on after a whitespace marker")
        self.byte_ids = byte_ids
        self.text = {i: p.encode() for p, (i, _) in pieces.items()}
        self.text |= {i: bytes([b]) for b, i in enumerate(byte_ids)}
        self.score = np.full(max(self.text) + 1, -np.inf)
        for i, s in pieces.values():
            self.score[i] = s
        self.unknown = min(s for _, s in pieces.values()) - UNKNOWN
        self.longest = max(len(p.encode()) for p in pieces)
        self.trie = DoubleArray({p.encode(): i for p, (i, _) in pieces.items()})

    @classmethod
    def load(cls, path: str, counts: dict[int, int] | None = None) -> "Vocabulary":
        """Pieces of a model file, scored by the logarithm of their smoothed shares in ``counts``, else as the file says."""
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        ids = range(sp.get_piece_size())
        byte_ids = {sp.id_to_piece(i): i for i in ids if sp.is_byte(i)}
        usual = [i for i in ids if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        score = {i: sp.get_score(i) for i in usual}
        if counts is not None:
            total = sum(counts.get(i, 0) for i in usual) + SMOOTH * len(usual)
            score = {i: math.log((counts.get(i, 0) + SMOOTH) / total) for i in usual}
        pieces = {sp.id_to_piece(i): (i, score[i]) for i in usual}
        return cls(pieces, [byte_ids[f"<0x{b:02X}>"] for b in range(256)])

    def segment(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Best ids of each chunk (UTF-8, spaces already markers), one after another, and how many each has.

        A byte 0xFF stands for an uncoverable literal marker.
        """
        sizes = np.zeros(len(chunks), np.int64)
        by_length: dict[int, list[int]] = {}
        for k, c in enumerate(chunks):
            by_length.setdefault(len(c), []).append(k)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for n, rows in by_length.items():
            # cells of the tables are bounded, whatever the length
            step = max(1, TABLE_CELLS // (n + 1))
            for at in range(0, len(rows) if n else 0, step):
                part = rows[at:at + step]
                ids, count = self._viterbi(np.frombuffer(b"".join(chunks[r] for r in part), np.uint8).reshape(len(part), n))
                sizes[part] = count
                found.append((np.array(part), ids, count))
        ends = np.cumsum(sizes)
        out = np.zeros(int(ends[-1]) if len(ends) else 0, np.int32)
        for rows, ids, count in found:
            out[_spans(ends[rows] - count, count)] = ids
        return out, sizes

    def _viterbi(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows, n = text.shape
        best = np.full((n + 1, rows), -np.inf)
        best[0] = 0.0
        came, piece = np.zeros((n + 1, rows), np.int32), np.full((n + 1, rows), -1, np.int32)
        column = np.ascontiguousarray(text.T).astype(np.int32)
        starts = (column & 0xC0) != 0x80  # bytes that begin a character
        for i in range(n):
            row = np.flatnonzero(np.isfinite(best[i]) & starts[i])
            if not len(row):
                continue
            first, state = row, np.zeros(len(row), np.int32)
            single = np.zeros(rows, bool)  # a piece covers just this character
            for j in range(i, min(n, i + self.longest)):
                state, ok = self.trie.step(state, column[j, row])
                row, state = row[ok], state[ok]
                if not len(row):
                    break
                value = self.trie.value[state]
                done = value >= 0
                if done.any():
                    r, v = row[done], value[done]
                    whole = starts[j + 1, r] if j + 1 < n else np.ones(len(r), bool)
                    r, v = r[whole], v[whole]
                    score = best[i, r] + self.score[v]
                    better = score > best[j + 1, r]
                    r, v = r[better], v[better]
                    best[j + 1, r], came[j + 1, r], piece[j + 1, r] = score[better], i, v
                    if j - i < 4:
                        alone = ~starts[i + 1:j + 1, row[done][whole]].any(axis=0)
                        single[row[done][whole][alone]] = True
            bare = first[~single[first]]
            if len(bare):
                lead = column[i, bare]
                width = np.where(lead < 0xC0, 1, np.where(lead < 0xE0, 2, np.where(lead < 0xF0, 3, np.where(lead < 0xF8, 4, 1))))
                end = i + width
                score = best[i, bare] + self.unknown
                better = score > best[end, bare]
                r, e = bare[better], end[better]
                best[e, r], came[e, r], piece[e, r] = score[better], i, -1
        # all rows walk back side by side, a piece a step
        at, every, steps = np.full(rows, n), np.arange(rows), []
        while (open_ := at > 0).any():
            steps.append(np.where(open_, piece[at, every], DONE))
            at = np.where(open_, came[at, every], 0)
        back = np.array(steps).reshape(-1, rows)[::-1].T
        kept = back != DONE
        bare = (back == -1).any(axis=1)  # rows with byte pieces go one by one
        if not bare.any():
            return back[kept].astype(np.int32), kept.sum(axis=1)
        lists = [np.array(self._back(text[k], came[:, k], piece[:, k]), np.int32) if bare[k] else back[k][kept[k]].astype(np.int32) for k in range(rows)]
        return np.concatenate(lists), np.array([len(x) for x in lists])

    def _back(self, text: np.ndarray, came: np.ndarray, piece: np.ndarray) -> list[int]:
        out: list[int] = []
        at = len(text)
        while at:
            first, p = int(came[at]), int(piece[at])
            if p >= 0:
                out.append(p)
            elif text[first] == 0xFF:
                out += [self.byte_ids[b] for b in reversed(MARK.encode())]
            else:
                out += [self.byte_ids[b] for b in reversed(text[first:at].tolist())]
            at = first
        return out[::-1]

    def decode(self, ids: list[int]) -> str:
        """Text of ids: markers that pieces spell become spaces, byte pieces become bytes, the leading marker goes."""
        is_byte = set(self.byte_ids)
        out, mark = [], MARK.encode()
        for i in ids:
            out.append(self.text[i] if i in is_byte else self.text[i].replace(mark, b" "))
        return b"".join(out)[1:].decode("utf-8", "replace")


def _prepared(chunk: str) -> bytes:
    return chunk.encode().replace(MARK.encode(), b"\xff").replace(b" ", MARK.encode())


class Encoder:
    """Ids of texts, with a memory of words."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.flat = np.zeros(1 << 12, np.int32)
        self.start, self.size = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)
        self.used = self.held = 0

    def _cut(self, rows: list[str]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """(words, first word of each text, words of each text); a word stands for the space before it, too."""
        column = pa.array(rows, pa.large_string())
        other = pc.match_substring_regex(column, "  |^ | $|^$").to_numpy(zero_copy_only=False)
        cut = pc.split_pattern(column.filter(pa.array(~other)), " ")
        rest = [[c[1:] for c in _CHUNKS.findall(" " + rows[k])] if rows[k] else [] for k in np.flatnonzero(other)]
        size = np.zeros(len(rows), np.int64)
        size[~other] = cut.value_lengths().to_numpy()
        size[other] = [len(r) for r in rest]
        order = np.argsort(other, kind="stable")
        start = np.zeros(len(rows), np.int64)
        start[order] = np.cumsum(size[order]) - size[order]
        return pa.concat_arrays([cut.flatten(), pa.array(list(chain.from_iterable(rest)), pa.large_string())]), start, size

    def _places(self, words: list[str]) -> np.ndarray:
        """Places of words; new ones are segmented."""
        known = self.place
        found = np.fromiter((known.get(w, -1) for w in words), np.int64, len(words))
        fresh = np.flatnonzero(found < 0)
        if len(fresh):
            new = [words[k] for k in fresh.tolist()]
            ids, sizes = self.vocabulary.segment([_prepared(" " + w) for w in new])
            n, m = len(known), self.used + len(ids)
            while n + len(new) > len(self.start):
                self.start, self.size = np.resize(self.start, 2 * len(self.start)), np.resize(self.size, 2 * len(self.size))
            while m > len(self.flat):
                self.flat = np.resize(self.flat, 2 * len(self.flat))
            self.flat[self.used:m] = ids
            self.size[n:n + len(new)] = sizes
            self.start[n:n + len(new)] = self.used + np.cumsum(sizes) - sizes
            found[fresh] = np.arange(n, n + len(new))
            known.update(zip(new, range(n, n + len(new))))
            self.held += sum(map(len, new)) + 4 * len(ids) + WORD_BYTES * len(new)
            self.used = m
        return found

    def encode(self, rows: list[str]) -> list[np.ndarray]:
        """Ids of each text; an empty text has none."""
        if self.held > CACHE_BYTES:
            self.forget()
        words, first, count = self._cut(rows)
        coded = words.dictionary_encode()
        place = self._places(coded.dictionary.to_pylist())
        at = place[coded.indices.to_numpy().astype(np.int64)[_spans(first, count)]]
        size = self.size[at]
        ids = self.flat[_spans(self.start[at], size)]
        ends = np.concatenate(([0], np.cumsum(size)))[np.cumsum(count)]
        return np.split(ids, ends[:-1]) if len(rows) else []


#: Counts of pieces by id, as (id, count) pairs; None stands for the scores of the file.
Counts = tuple[tuple[int, int], ...] | None


@lru_cache(maxsize=1)
def _encoder(path: str, counts: Counts = None) -> Encoder:
    return Encoder(Vocabulary.load(path, None if counts is None else dict(counts)))


@lru_cache(maxsize=1)
def _own_encoder(path: str):
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=path)


def learned(docs: DataFrame, model_path: str) -> Counts:
    """How often the file's own encoder uses each piece, over the words of all documents.

    A word is counted with the space before it; of neighbouring spaces and
    literal markers only the words between them count. Tasks number the distinct
    words of a batch and encode each once; the driver gets a row for each piece.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _own_encoder(model_path)
        total = np.zeros(own.get_piece_size(), np.int64)
        for batch in batches:
            rows = batch.column(1).to_pylist()
            for a, b in in_batches(rows):
                words = pc.value_counts(pc.split_pattern(pa.array(rows[a:b], pa.large_string()), " ").flatten())
                text, times = words.field(0).to_pylist(), words.field(1).to_numpy()
                ids = own.encode([w if w and MARK not in w else "" for w in text], num_threads=1)
                sizes = np.fromiter(map(len, ids), np.int64, len(ids))
                np.add.at(total, np.fromiter(chain.from_iterable(ids), np.int64, int(sizes.sum())), np.repeat(times, sizes))
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], names=["piece", "n"])

    found = texts(docs).mapInArrow(run, "piece long, n long").groupBy("piece").agg(F.sum("n").alias("n")).collect()  # at most the vocabulary
    return tuple(sorted((r["piece"], r["n"]) for r in found))


def encode(docs: DataFrame, model_path: str, counts: Counts = None) -> DataFrame:
    """(doc_id, ids) of every row; null and empty texts have no ids, long texts are encoded whole."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(model_path, counts)
        for batch in batches:
            doc_ids, rows = batch.column(0), batch.column(1).to_pylist()
            for a, b in in_batches(rows):
                ids = enc.encode(rows[a:b])
                ends = np.cumsum([0, *map(len, ids)])
                yield pa.RecordBatch.from_arrays([
                    doc_ids.slice(a, b - a), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids), pa.int32()))],
                    names=["doc_id", "ids"])

    return texts(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(rows: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids decode to the empty text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _encoder(model_path).vocabulary
        spelled = {i: t.replace(MARK.encode(), b" ") for i, t in vocabulary.text.items()}
        spelled |= {i: bytes([b]) for b, i in enumerate(vocabulary.byte_ids)}
        for batch in batches:
            doc_ids, lists = batch.column(0), batch.column(1)
            out = [b"".join(map(spelled.__getitem__, x.as_py() or []))[1:].decode("utf-8", "replace") for x in lists]
            yield pa.RecordBatch.from_arrays([doc_ids, pa.array(out, pa.string())], names=["doc_id", "text"])

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def segmentation_digest(docs: DataFrame, model_path: str, counts: Counts = None) -> DataFrame:
    """Encode and decode every document, with scores learned from them unless ``counts`` are given.

    (doc_id, n_pieces, n_byte_pieces, ids_crc32 of the ids as little-endian
    unsigned 32-bit, round_trip: whether decoding gives the text back).
    """
    counts = learned(docs, model_path) if counts is None else counts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(model_path, counts)
        vocabulary = enc.vocabulary
        spelled = {i: t.replace(MARK.encode(), b" ") for i, t in vocabulary.text.items()}
        spelled |= {i: bytes([b]) for b, i in enumerate(vocabulary.byte_ids)}
        is_byte = np.zeros(len(vocabulary.score), bool)
        is_byte[vocabulary.byte_ids] = True
        for batch in batches:
            doc_ids, rows = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in in_batches(rows):
                ids = enc.encode(rows[a:b])
                same = [b"".join(map(spelled.__getitem__, x.tolist()))[1:] == t.encode() for x, t in zip(ids, rows[a:b])]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": doc_ids[a:b], "n_pieces": [len(x) for x in ids], "n_byte_pieces": [int(is_byte[x].sum()) for x in ids],
                    "ids_crc32": [zlib.crc32(x.astype("<u4").tobytes()) for x in ids], "round_trip": same},
                    schema=pa.schema([("doc_id", pa.int64()), ("n_pieces", pa.int64()), ("n_byte_pieces", pa.int64()),
                                      ("ids_crc32", pa.int64()), ("round_trip", pa.bool_())]))
        enc.forget()  # nothing of a task stays beside other operators

    return texts(docs).mapInArrow(run, "doc_id long, n_pieces long, n_byte_pieces long, ids_crc32 long, round_trip boolean")
