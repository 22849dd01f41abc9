"""Best-fit packing of token pieces into sequences, in bulk-synchronous rounds.

A document's ids end with ``end_id``; only documents longer than a sequence
are cut, into full pieces after a shorter first one. Sizes are whole numbers
up to ``capacity``, so sorted documents and sorted gaps are runs of equal
values: at most ``capacity`` size classes, whatever the corpus. Spark counts
the classes and ranks each piece within its class; the rounds sweep over the
classes; Spark then gives each piece, by its rank, the place that its class
was dealt.

One round: sort the free document classes and the gap classes; sweep the
documents from the largest down, each taking its successor, the smallest gap
not yet taken that holds it; where several documents of a class want a class
of gaps, ranks decide; gaps shrink by what they took and the next round begins.
When nothing fits any more, the largest free documents open sequences.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import salted_rank, staged, texts
from .tokens import encoder, in_batches

CAPACITY = 2048
END_ID = 0
PIECES = "doc_id long, piece int, start long, length long, ids binary"


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of every row's ids: (doc_id, piece, start, length, ids as little-endian unsigned 32-bit).

    Null and empty texts give one piece, the end id. Repeated rows each give
    their pieces. Long texts are encoded whole.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        for batch in batches:
            doc_ids, rows = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in in_batches(rows):
                ids, counts = enc.encode(rows[a:b])
                ends = np.cumsum(counts)
                full = np.insert(ids, ends, end_id).astype("<u4")
                counts = counts + 1
                starts = np.cumsum(counts) - counts
                out: dict[str, list] = {"doc_id": [], "piece": [], "start": [], "length": [], "ids": []}
                for k, (first, n) in enumerate(zip(starts.tolist(), counts.tolist())):
                    head = n % capacity or capacity
                    for p, at in enumerate([0, *range(head, n, capacity)]):
                        size = head if p == 0 else capacity
                        out["doc_id"].append(doc_ids[a + k])
                        out["piece"].append(p)
                        out["start"].append(at)
                        out["length"].append(size)
                        out["ids"].append(full[first + at:first + at + size].tobytes())
                yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
                    ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())]))
        enc.forget()

    return texts(docs).mapInArrow(cut, PIECES)


def _sweep(free: dict[int, list[int]], gaps: list[list[int]]) -> tuple[list[tuple[int, int, int, int, int]], list[list[int]]]:
    """One round over the sorted classes.

    ``free``: length -> [next rank, count]; ``gaps``: [gap, first sequence,
    sequences, offset]. Gives (length, first rank, pieces, first sequence,
    offset) flows and the gaps after the round; each gap takes one piece.
    """
    gaps = sorted(gaps)
    keys = [g[0] for g in gaps]
    flows, after = [], []
    for size in sorted(free, reverse=True):
        entry = free[size]
        k = bisect.bisect_left(keys, size)
        end = k
        while entry[1] and end < len(gaps):
            gap, first, n, offset = gaps[end]
            m = min(n, entry[1])
            flows.append((size, entry[0], m, first, offset))
            if gap > size:
                after.append([gap - size, first, m, offset + size])
            entry[0] += m
            entry[1] -= m
            if m < n:
                gaps[end] = [gap, first + m, n - m, offset]
            else:
                end += 1
        del gaps[k:end], keys[k:end]
        if not entry[1]:
            del free[size]
    return flows, after + gaps


def plan_rounds(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """(flows, sequences) for class counts: length -> pieces.

    A flow (length, first rank, pieces, first sequence, offset) puts the
    pieces of a class with these ranks at ``offset`` of consecutive sequences.
    """
    free = {size: [0, n] for size, n in counts.items() if n}
    gaps: list[list[int]] = []
    flows: list[tuple[int, int, int, int, int]] = []
    opened = 0
    while free:
        if gaps and min(free) <= max(g[0] for g in gaps):
            found, gaps = _sweep(free, gaps)
            flows += found
            continue
        # nothing fits: pieces above half must stand apart; else half of the sequences that the rest fills
        total = sum(size * n for size, (_, n) in free.items())
        want = sum(n for size, (_, n) in free.items() if 2 * size > capacity) or math.ceil(total / capacity / 2)
        for size in sorted(free, reverse=True):
            if not want:
                break
            entry = free[size]
            m = min(want, entry[1])
            flows.append((size, entry[0], m, opened, 0))
            if capacity > size:
                gaps.append([capacity - size, opened, m, size])
            opened += m
            want -= m
            entry[0] += m
            entry[1] -= m
            if not entry[1]:
                del free[size]
    return flows, opened


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (columns doc_id, piece, length and others) with ``sequence_id`` and ``offset``.

    Pass narrow pieces, written ones best: they are read three times. Every
    row is placed; nulls, ties and repeated rows are told apart by their rank.
    An empty table gives an empty result. A class may hold any share of the
    rows: its ranks come from salted parts.
    """
    pieces = pieces.drop("sequence_id", "offset")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    if any(size < 1 or size > capacity for size in counts):
        raise ValueError(f"piece lengths must be 1 to {capacity}")
    flows, _ = plan_rounds(counts, capacity)
    by_size: dict[int, list[tuple[int, int, int]]] = {}
    for size, rank, _n, first, offset in flows:
        by_size.setdefault(size, []).append((rank, first, offset))
    plan = pieces.sparkSession.createDataFrame(
        [(size, [list(x) for x in sorted(runs)]) for size, runs in by_size.items()], "length long, _runs array<array<long>>")
    salt = F.xxhash64("doc_id", "piece", "start")
    ranked = salted_rank(pieces, ["length"], ["doc_id", "piece", "start"], salt, name="_rank")
    # at most ``capacity`` rows, one for each length
    placed = ranked.join(F.broadcast(plan), "length").withColumn(
        "_run", F.element_at(F.filter("_runs", lambda r: r[0] <= F.col("_rank")), -1))
    return (placed.withColumn("sequence_id", F.col("_run")[1] + F.col("_rank") - F.col("_run")[0])
            .withColumn("offset", F.col("_run")[2]).drop("_runs", "_run", "_rank"))


def packed_sequences(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The packed corpus itself: (sequence_id, length, ids binary), pieces joined in their offsets' order."""
    pieces = staged(token_pieces(docs, tokenizer_path, capacity, end_id)
                    .withColumn("_row", F.monotonically_increasing_id()), "pieces")
    placed = pack(pieces.drop("ids"), capacity)
    joined = placed.join(pieces.select("_row", "ids"), "_row")
    return joined.groupBy("sequence_id").agg(
        F.sum("length").alias("length"),
        F.expr("unhex(array_join(transform(array_sort(collect_list(struct(offset, hex(ids) AS h))), x -> x.h), ''))").alias("ids"))


def packing_digest(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Each piece with the crc32 of its ids and its place."""
    narrow = staged(token_pieces(docs, tokenizer_path).withColumn("ids_crc32", F.crc32("ids")).drop("ids"), "piece-sizes")
    return pack(narrow).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
