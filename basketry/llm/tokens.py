"""Token ids by the ``tokenizers`` library, each distinct word of a text encoded once.

Neither tokenizer joins text across the last character of a run of white space:
the byte BPE takes a space with the word that follows and the rest of the run
alone, the word BPE drops white space. So the ids of a text are those of its
words and runs in order. Arrow cuts the texts and numbers the distinct words of
a batch; a word of letters, with a mark behind it or without, goes to the
library's model, all others go through the whole library. Words repeat, so a
task keeps their ids, and texts are put together by vectorised gathers.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of words and ids that a task remembers before it starts again, and what a word takes beside its text.
CACHE_BYTES, WORD_BYTES = 128_000_000, 220
#: Characters of text that are encoded in one go.
BATCH_CHARS = 2_000_000

#: First characters of keys: a chunk as it stands, a newline and a word, a run before a word, a run at the end.
#: Any other key is a word after a space (byte BPE) or a word (word BPE).
BARE, LINE, RUN, LAST = "\x1c", "\n", "\x1d", "\x1e"
MARKS = ".,;:!?"
_PLAIN = f"^(?P<head>[{BARE}{LINE}]?)(?P<letters>[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)(?P<mark>[{MARKS}]?)$"
#: White space other than single spaces and newlines between words.
_OTHER = ("[\\t\\x0b\\x0c\\r\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
          "|[ \\n][ \\n]|^[ \\n]|[ \\n]$|^$")
#: White space to Python alone; texts that hold it are cut before single spaces only.
_ODD = re.compile("[\x1c-\x1f]")
_RUNS = re.compile(r"(\s+)")
_CHUNKS = re.compile(r"(?<=\S)(?= \S)")


def _spans(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indices of all the ranges, one after another."""
    ends = np.cumsum(size)
    return np.repeat(start - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


def strings(column: pa.Array) -> list[str]:
    """Strings of a column without nulls, made all at once: ``to_pylist`` makes an Arrow scalar for each."""
    return column.to_numpy(zero_copy_only=False).tolist()


class WordEncoder:
    """Ids of texts under one tokenizer file, with a memory of words."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the threads
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.drops_space = self.tokenizer.normalizer is not None  # the word BPE: lower case, white space only separates
        self.model = self.tokenizer.model
        self.line_ids = self._ids("\n")
        self.mark_ids = np.array([self._ids(m)[0] for m in MARKS], np.int32)
        # the library's visible character for each byte, read off texts that hold them
        show = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.visible: dict[int, str] = {}
        for code in (*range(0x800), *range(0x800, 0xD800, 64), *range(0xE000, 0x110000, 4096)):
            if not set(chr(code).encode()) <= self.visible.keys():
                self.visible |= zip(chr(code).encode(), "".join(x for x, _ in show(chr(code))))
        self.forget()

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.flat = np.zeros(1 << 12, np.int32)
        self.start, self.size = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)
        self.used = self.held = 0
        pa.default_memory_pool().release_unused()

    def _keys(self, text: str) -> list[str]:
        """Keys of a text with any white space."""
        if _ODD.search(text):
            return [BARE + c for c in _CHUNKS.split(text) if c]
        if self.drops_space:
            return text.split()
        parts = _RUNS.split(text)
        keys = [BARE + parts[0]] if parts[0] else []
        for run, word in zip(parts[1::2], parts[2::2]):
            if not word:
                keys.append(LAST + run)
            elif run == " ":
                keys.append(word)
            elif run == "\n":
                keys.append(LINE + word)
            else:
                keys += [RUN + run, word if run[-1] == " " else BARE + word]
        return keys

    def _cut(self, texts: list[str]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """(keys, first key of each text, keys of each text)."""
        column = pa.array(texts, pa.large_string())
        other = pc.match_substring_regex(column, _OTHER).to_numpy(zero_copy_only=False)
        single = column.filter(pa.array(~other))
        if self.drops_space:
            cut = pc.split_pattern(pc.replace_substring(single, "\n", " "), " ")
        else:
            marked = pc.binary_join_element_wise(pa.scalar(BARE, pa.large_string()), single, pa.scalar("", pa.large_string()))
            cut = pc.split_pattern(pc.replace_substring(marked, "\n", " \n"), " ")
        rest = [self._keys(texts[k]) for k in np.flatnonzero(other)]
        size = np.zeros(len(texts), np.int64)
        size[~other] = cut.value_lengths().to_numpy()
        size[other] = [len(r) for r in rest]
        keys = pa.concat_arrays([cut.flatten(), pa.array(list(chain.from_iterable(rest)), pa.large_string())])
        order = np.argsort(other, kind="stable")
        start = np.zeros(len(texts), np.int64)
        start[order] = np.cumsum(size[order]) - size[order]
        return keys, start, size

    def _learned(self, words: list[str], plain: np.ndarray) -> np.ndarray:
        """Places of words; new ones are encoded. ``plain``: letters only, with the space before them."""
        known = self.place
        found = np.fromiter(map(known.get, words, repeat(-1)), np.int64, len(words))
        fresh = np.flatnonzero(found < 0)
        if not len(fresh):
            return found
        ids: list = []
        slow: list[tuple[int, str]] = []
        model, visible, space = self.model.tokenize, self.visible, self.visible[32]
        after = "" if self.drops_space else " "
        for at, k in enumerate(fresh.tolist()):
            word = words[k]
            if plain[k]:
                if not word.isascii():
                    word = word.encode().decode("latin-1").translate(visible)
                elif word[0] == " ":
                    word = space + word[1:]
                ids.append([t.id for t in model(word)])
                continue
            head, rest = word[0], word[1:]
            if head == RUN:
                ids.append((self._ids(rest[:-1]) if len(rest) > 1 else []) + (self._ids(rest[-1]) if rest[-1] != " " else []))
            elif head == LAST:
                ids.append(self._ids(rest))
            else:
                ids.append(None)
                slow.append((at, rest if head in (BARE, LINE) else after + word))
        for (at, _), e in zip(slow, self.tokenizer.encode_batch([x for _, x in slow], add_special_tokens=False)):
            ids[at] = [*self.line_ids, *e.ids] if words[fresh[at]][0] == LINE else e.ids
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        n, m = len(known), self.used + int(sizes.sum())
        while n + len(ids) > len(self.start):
            self.start, self.size = np.resize(self.start, 2 * len(self.start)), np.resize(self.size, 2 * len(self.size))
        while m > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        self.flat[self.used:m] = np.fromiter(chain.from_iterable(ids), np.int32, m - self.used)
        self.size[n:n + len(ids)] = sizes
        self.start[n:n + len(ids)] = self.used + np.cumsum(sizes) - sizes
        found[fresh] = np.arange(n, n + len(ids))
        for k, place in zip(fresh.tolist(), range(n, n + len(ids))):
            known[words[k]] = place
            self.held += len(words[k])
        self.held += 4 * (m - self.used) + WORD_BYTES * len(ids)
        self.used = m
        return found

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in order, number of ids of each text)."""
        if self.held > CACHE_BYTES:
            self.forget()
        keys, first, count = self._cut(texts)
        coded = keys.dictionary_encode()
        parts = pc.extract_regex(coded.dictionary, _PLAIN)
        plain = parts.is_valid()
        head, letters, mark = (pc.fill_null(parts.field(k), "") for k in range(3))
        if self.drops_space:
            base = pc.utf8_lower(letters)
        else:
            empty = pa.scalar("", head.type)
            base = pc.binary_join_element_wise(pc.if_else(pc.equal(head, ""), pa.scalar(" ", head.type), empty), letters, empty)
        words = pc.if_else(plain, base, coded.dictionary).dictionary_encode()
        is_plain = plain.to_numpy(zero_copy_only=False)
        of_key = words.indices.to_numpy().astype(np.int64)
        plain_word = np.zeros(len(words.dictionary), bool)
        plain_word[of_key] = is_plain
        place = self._learned(strings(words.dictionary), plain_word)[of_key]

        # ids of the batch's distinct keys: a newline, the word, a mark
        line = is_plain & (not self.drops_space) & pc.equal(head, LINE).to_numpy(zero_copy_only=False)
        ending = pc.index_in(mark, pa.array(list(MARKS), mark.type)).fill_null(-1).to_numpy()
        marked = is_plain & (ending >= 0)
        before = np.where(line, len(self.line_ids), 0)
        inner = self.size[place]
        size = before + inner + marked
        start = np.cumsum(size) - size
        flat = np.zeros(int(size.sum()), np.int32)
        flat[_spans(start + before, inner)] = self.flat[_spans(self.start[place], inner)]
        for k, i in enumerate(self.line_ids):
            flat[start[line] + k] = i
        flat[start[marked] + size[marked] - 1] = self.mark_ids[ending[marked]]

        # ids of the texts
        at = coded.indices.to_numpy().astype(np.int64)[_spans(first, count)]
        ids = flat[_spans(start[at], size[at])]
        ends = np.concatenate(([0], np.cumsum(size[at])))[np.concatenate(([0], np.cumsum(count)))]
        return ids, np.diff(ends)


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """The worker's encoder for a file. A task forgets its words when it ends, so nothing of it stays beside other operators."""
    return WordEncoder(path)


def in_batches(texts: list[str], chars: int = BATCH_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` of about ``chars`` characters; a longer text stands alone."""
    first = held = 0
    for k, t in enumerate(texts):
        if held and held + len(t) > chars:
            yield first, k
            first, held = k, 0
        held += len(t)
    if texts:
        yield first, len(texts)
