"""Token-id files under a Re-Pair grammar.

Documents are put in ascending order, encoded, and cut into shards of whole
documents. In each shard the most frequent adjacent id pairs are replaced by
new symbols, again and again (no pair crosses a document's end); the shard
stores the rules, the length that each symbol expands to, the symbols of all
documents and where each document starts, so any document, or any range of its
ids, is decoded without the others.

A file row is (part, block, n_docs, n_ids, payload); the payload's layout, all
little-endian: magic ``RPG1``, then unsigned 32-bit counts of base symbols,
rules, symbols and documents and the symbols' width in bytes; rules (left and
right symbol, 32-bit), expansion lengths (32-bit), symbols, documents' ids
(64-bit, with one null byte each), first symbols (64-bit) and id counts (64-bit).
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.session import scratch_dir

from .common import texts
from .tokens import encoder, in_batches, strings

MAGIC = b"RPG1"
HEAD = struct.Struct("<4sIIQQI")
END_ID = 1
#: Ids after which a shard is closed at the next document's end.
SHARD_IDS = 2_000_000
#: Pairs replaced in a round at most, and uses that a pair needs.
ROUND_PAIRS, LEAST_USES = 4096, 8
#: Symbols of a shard: as many as two bytes hold, or four where the ids leave no room in two.
SYMBOLS, WIDE_SYMBOLS = 1 << 16, 1 << 32
FILE_SCHEMA = "part long, block int, n_docs long, n_ids long, payload binary"
ROW_SCHEMA = "part long, block int, place long, doc_id long, at long, n_tokens long, ids_crc32 long"


def _uses(code: np.ndarray, inner: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose pair is one of ``pairs``, and its index there."""
    def slot(x: np.ndarray) -> np.ndarray:
        if x.dtype == np.uint64:
            return (x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)
        return (x * np.uint32(2654435761)) >> np.uint32(16)

    own = slot(pairs)
    holder = np.full(1 << 16, -1, np.int32)
    holder[own] = np.arange(len(pairs), dtype=np.int32)
    rank = holder[slot(code)]
    at = np.flatnonzero((rank >= 0) & inner)
    rank, here = rank[at], code[at]
    hit = pairs[rank] == here
    lost = np.flatnonzero(holder[own] != np.arange(len(pairs)))  # pairs whose slot holds another one
    if len(lost):
        lost = lost[np.argsort(pairs[lost])]
        miss = np.flatnonzero(~hit)
        place = np.minimum(np.searchsorted(pairs[lost], here[miss]), len(lost) - 1)
        found = pairs[lost[place]] == here[miss]
        rank[miss[found]] = lost[place[found]]
        hit[miss[found]] = True
    return at[hit], rank[hit].astype(np.int64)


def compress(ids: np.ndarray, ends: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Re-Pair over one shard: (rules, expansion lengths of the rules, symbols, last symbol of each document marked).

    ``ends`` marks the last id of each document. Each round counts all pairs,
    takes the most frequent ones, and where two chosen pairs overlap keeps the
    more frequent one (of equals the left one). Rounds go on until no pair is
    frequent or the symbols run out.
    """
    wide = base > SYMBOLS - 256
    most = WIDE_SYMBOLS if wide else SYMBOLS
    kind, half = (np.uint64, np.uint64(32)) if wide else (np.uint32, np.uint32(16))
    low = kind((1 << int(half)) - 1)
    seq, last = ids.astype(np.uint32), ends.copy()
    rules: list[np.ndarray] = []
    lengths = np.zeros(0, np.int64)

    def expands(x: np.ndarray) -> np.ndarray:
        return np.array([1 if k < base else lengths[k - base] for k in x.tolist()], np.int64)

    while True:
        room = min(ROUND_PAIRS, most - base - len(lengths))
        if room <= 0 or len(seq) < 2:
            break
        code = (seq[:-1].astype(kind) << half) | seq[1:]
        inner = ~last[:-1]
        ordered = np.sort(code[inner])
        if not len(ordered):
            break
        first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
        uses = np.diff(np.append(first, len(ordered)))
        often = np.flatnonzero(uses >= LEAST_USES)
        if not len(often):
            break
        often = often[np.argsort(-uses[often], kind="stable")[:room]]
        pairs = ordered[first[often]]
        at, rank = _uses(code, inner, pairs)
        # a run of one id overlaps itself: every second place of it counts
        place = np.arange(len(at))
        run = np.concatenate(([True], (np.diff(at) != 1) | (rank[1:] != rank[:-1])))
        odd = (place - np.maximum.accumulate(np.where(run, place, 0))) % 2 == 1
        at, rank = at[~odd], rank[~odd]
        taken, chosen = np.zeros(0, np.int64), np.zeros(0, np.int64)
        while len(at):  # what lies between two kept pairs may still hold one
            touching = np.diff(at) == 1
            kept = np.ones(len(at), bool)
            kept[1:] &= ~touching | (rank[1:] < rank[:-1])
            kept[:-1] &= ~touching | (rank[:-1] <= rank[1:])
            taken, chosen = np.concatenate((taken, at[kept])), np.concatenate((chosen, rank[kept]))
            free = ~kept
            free[1:] &= ~(touching & kept[:-1])
            free[:-1] &= ~(touching & kept[1:])
            at, rank = at[free], rank[free]
        in_order = np.argsort(taken)
        taken, symbol = taken[in_order], chosen[in_order].astype(np.uint32) + np.uint32(base + len(lengths))
        rules.append(np.stack((pairs >> half, pairs & low), axis=1).astype(np.uint32))
        lengths = np.concatenate((lengths, expands(rules[-1][:, 0]) + expands(rules[-1][:, 1])))
        seq[taken] = symbol
        last[taken] = last[taken + 1]
        keep = np.ones(len(seq), bool)
        keep[taken + 1] = False
        seq, last = seq[keep], last[keep]
    found = np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32)
    return found, lengths, seq, last


def pack_shard(doc_ids: list[int | None], ids: np.ndarray, counts: np.ndarray) -> bytes:
    """Payload of one shard; ``ids`` holds the documents' ids in order, at least one each."""
    ends = np.zeros(len(ids), bool)
    ends[np.cumsum(counts) - 1] = True
    base = int(ids.max()) + 1 if len(ids) else 1
    rules, lengths, seq, last = compress(ids, ends, base)
    width = 2 if base + len(rules) <= SYMBOLS else 4
    firsts = np.concatenate(([0], np.flatnonzero(last)[:-1] + 1)) if len(last) else np.zeros(0, np.int64)
    known = np.array([x is not None for x in doc_ids], np.uint8)
    numbers = np.array([x or 0 for x in doc_ids], "<i8")
    return b"".join((
        HEAD.pack(MAGIC, base, len(rules), len(seq), len(doc_ids), width),
        rules.astype("<u4").tobytes(), lengths.astype("<u4").tobytes(), seq.astype(f"<u{width}").tobytes(),
        numbers.tobytes(), known.tobytes(), firsts.astype("<i8").tobytes(), np.asarray(counts, "<i8").tobytes()))


class Shard:
    """A payload opened for reading; documents are decoded one, some or all at a time."""

    def __init__(self, payload: bytes):
        magic, self.base, n_rules, n_symbols, n_docs, width = HEAD.unpack_from(payload)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        at = HEAD.size

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(payload, kind, n, at)
            at += out.nbytes
            return out

        rules = take("<u4", 2 * n_rules).reshape(-1, 2)
        lengths = take("<u4", n_rules).astype(np.int64)
        self.symbols = take(f"<u{width}", n_symbols)
        numbers, known = take("<i8", n_docs), take("u1", n_docs)
        self.doc_ids = [int(x) if k else None for x, k in zip(numbers, known)]
        self.firsts, self.counts = take("<i8", n_docs), take("<i8", n_docs)
        self.length = np.concatenate((np.ones(self.base, np.int64), lengths))
        self.start = np.cumsum(self.length) - self.length
        self.flat = np.zeros(int(self.length.sum()), np.uint32)
        self.flat[:self.base] = np.arange(self.base)
        for k, (a, b) in enumerate(rules.tolist()):  # a rule only uses symbols before it
            at_k, n = self.start[self.base + k], self.length[a]
            self.flat[at_k:at_k + n] = self.flat[self.start[a]:self.start[a] + n]
            self.flat[at_k + n:at_k + self.length[self.base + k]] = self.flat[self.start[b]:self.start[b] + self.length[b]]

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        sizes = self.length[symbols]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(self.start[symbols] - (ends - sizes), sizes) + np.arange(total)]

    def document(self, k: int, first: int = 0, n: int | None = None) -> np.ndarray:
        """Ids ``first`` to ``first + n`` of document ``k``; only the symbols that cover them are expanded."""
        stop = self.firsts[k + 1] if k + 1 < len(self.firsts) else len(self.symbols)
        symbols = self.symbols[self.firsts[k]:stop]
        ends = np.cumsum(self.length[symbols])
        last = int(self.counts[k]) if n is None else min(int(self.counts[k]), first + n)
        if first >= last:
            return np.zeros(0, np.uint32)
        a, b = np.searchsorted(ends, first, side="right"), np.searchsorted(ends, last, side="left") + 1
        skip = first - (int(ends[a - 1]) if a else 0)
        return self.expand(symbols[a:b])[skip:skip + last - first]

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        """All documents in order, some at a time in memory."""
        step = 4096
        for k in range(0, len(self.doc_ids), step):
            end = min(k + step, len(self.doc_ids))
            stop = self.firsts[end] if end < len(self.firsts) else len(self.symbols)
            ids = self.expand(self.symbols[self.firsts[k]:stop])
            cuts = np.cumsum(self.counts[k:end])
            for j, (a, b) in enumerate(zip(cuts - self.counts[k:end], cuts)):
                yield self.doc_ids[k + j], ids[a:b]


def write_files(docs: DataFrame, tokenizer_path: str, path: str, end_id: int = END_ID, shard_ids: int = SHARD_IDS) -> None:
    """Encode every row and write the shards to ``path`` in ascending doc_id order (null ids first).

    Rows are ranged by (doc_id, text hash), so a doc_id that repeats without
    bound still spreads over tasks where its texts differ. A task holds one
    open shard; a longer document makes a shard of its own.
    """
    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, block = encoder(tokenizer_path), TaskContext.get().partitionId(), 0
        names: list[int | None] = []
        held: list[np.ndarray] = []
        sizes: list[np.ndarray] = []

        def close() -> pa.RecordBatch:
            nonlocal block
            ids, counts = np.concatenate(held), np.concatenate(sizes)
            row = {"part": [part], "block": [block], "n_docs": [len(names)], "n_ids": [len(ids)], "payload": [pack_shard(names, ids, counts)]}
            block += 1
            names.clear(), held.clear(), sizes.clear()
            return pa.RecordBatch.from_pydict(row, schema=pa.schema([
                ("part", pa.int64()), ("block", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("payload", pa.binary())]))

        for batch in batches:
            doc_ids, rows = batch.column(0).to_pylist(), strings(batch.column(1))
            for a, b in in_batches(rows):
                ids, counts = enc.encode(rows[a:b])
                held.append(np.insert(ids, np.cumsum(counts), end_id).astype(np.uint32))
                sizes.append(counts + 1)
                names += doc_ids[a:b]
                if sum(map(len, held)) >= shard_ids:
                    yield close()
        if names:
            yield close()
        enc.forget()

    rows = texts(docs)
    mix = F.xxhash64("text")
    (rows.withColumn("_mix", mix).repartitionByRange("doc_id", "_mix").sortWithinPartitions("doc_id", "_mix").drop("_mix")
     .mapInArrow(shards, FILE_SCHEMA).write.option("compression", "zstd").parquet(path))


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """The shards under ``path``."""
    return spark.read.schema(FILE_SCHEMA).parquet(path)


def decode(files: DataFrame) -> DataFrame:
    """(doc_id, ids as little-endian unsigned 32-bit) of every document in the files."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload in batch.column(0):
                pairs = [(d, x.astype("<u4").tobytes()) for d, x in Shard(payload.as_py()).documents()]
                yield pa.RecordBatch.from_pydict({"doc_id": [d for d, _ in pairs], "ids": [x for _, x in pairs]},
                                                 schema=pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())]))

    return files.select("payload").mapInArrow(run, "doc_id long, ids binary")


def document_index(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone.

    ``start`` counts the ids of all documents before it: the shards' counts
    are summed within their part and over the parts (one row a task).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, blocks, payloads = (batch.column(k) for k in range(3))
            for part, block, payload in zip(parts, blocks, payloads):
                rows = [(d, len(x), zlib.crc32(x.astype("<u4").tobytes())) for d, x in Shard(payload.as_py()).documents()]
                counts = np.array([n for _, n, _ in rows], np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.array([part.as_py()] * len(rows), pa.int64()), pa.array([block.as_py()] * len(rows), pa.int32()),
                    pa.array(range(len(rows)), pa.int64()), pa.array([d for d, _, _ in rows], pa.int64()),
                    pa.array(np.cumsum(counts) - counts), pa.array(counts), pa.array([c for _, _, c in rows], pa.int64())],
                    names=["part", "block", "place", "doc_id", "at", "n_tokens", "ids_crc32"])

    rows = files.select("part", "block", "payload").mapInArrow(run, ROW_SCHEMA)
    in_part = Window.partitionBy("part").orderBy("block")
    over_parts = Window.orderBy("part")
    parts = (files.groupBy("part").agg(F.sum("n_ids").alias("n"))
             .select("part", (F.sum("n").over(over_parts) - F.col("n")).alias("part_start")))
    blocks = (files.select("part", "block", "n_ids")
              .select("part", "block", (F.sum("n_ids").over(in_part) - F.col("n_ids")).alias("block_start")))
    starts = blocks.join(parts, "part")
    return (rows.join(starts, ["part", "block"])
            .select("doc_id", (F.col("part_start") + F.col("block_start") + F.col("at")).cast("long").alias("start"),
                    "n_tokens", "ids_crc32"))


def token_file_digest(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Write all documents, read the files back, and index what they hold."""
    spark = docs.sparkSession
    path = scratch_dir(spark, "token-files")
    write_files(docs, tokenizer_path, path)
    return document_index(read_files(spark, path))
