"""Byte passages that repeat across documents, by prefix doubling over sampled positions.

A byte goes if a ``length``-byte string that covers it also starts in a
document with a smaller id. Equal texts are told apart by hash first: all but
the smallest id go whole. Over distinct texts:

1. Sampling without loss. Of the ``GRAM``-byte strings inside a window of
   ``length`` bytes, the one with the least hash is the window's anchor; equal
   windows have equal anchors at equal places. A window whose anchor occurs in
   one text only is unique at ``GRAM`` bytes, so its rank is final and it leaves.
   Spark sorts the anchors into classes (the first rank) and drops such ones.
2. Doubling. For each anchor left, the bytes of the windows that it stands for
   are a context; equal contexts of a class are one, with the least document id.
   Spark groups the contexts by class. In each class the window starts are
   ranked by 8 bytes, then by pairs of ranks at growing offsets (8, 16, and what
   is left to ``length``); starts whose rank is unique leave after each round.
3. The least id of each full rank goes back to the contexts, and from them, by
   a join, to all their occurrences, which gives the bytes to remove.

Only classes whose contexts differ are doubled, so a passage that many
documents share costs one context for each way it is cut.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LAST_ID, map_rows, quoted, released, staged, staged_at, texts, unused

LENGTH = 50
GRAM = 16
#: Anchors of a bucket in the first round, contexts of a bucket in the second.
BUCKET_ANCHORS, BUCKET_CONTEXTS = 400_000, 20_000
#: Bytes that a task works on at once.
CHUNK_BYTES = 2_000_000

_RECORD = np.dtype([("k", "<u8"), ("t", "<i8"), ("pos", "<u4")])
_KNOWN = 0xFFFFFFFF  # in place of a position: the anchor is repeated already
_PLACE = 26  # bits of a position in a chunk


def _words(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position as one number (zeros after the end)."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    return np.ndarray(len(data), "<u8", padded.tobytes(), strides=(1,)).copy()


def _grams(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes from each position."""
    w = _words(data)
    h = w * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    h[:-8] += w[8:] * np.uint64(0xC2B2AE3D27D4EB4F) if len(h) > 8 else np.uint64(0)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def anchors(texts_: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of some texts, side by side.

    (hash, text, anchor's position in the text, first window start, number of
    window starts that it stands for, texts' first bytes in the joined array).
    """
    sizes = np.array([len(t) for t in texts_], np.int64)
    first = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(texts_), np.uint8)
    span = length - GRAM + 1  # grams in a window
    empty = np.zeros(0, np.int64)
    if len(data) < length:
        return empty.astype(np.uint64), empty, empty, empty, empty, first
    grams = _grams(data)
    place = np.uint64((1 << _PLACE) - 1)
    low = (grams & ~place) | np.arange(len(data), dtype=np.uint64)
    reach = 1
    while 2 * reach <= span:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    if reach < span:
        low = np.minimum(low[:reach - span], low[span - reach:])
    n = len(data) - length + 1
    at = (low[:n] & place).astype(np.int64)
    text = np.repeat(np.arange(len(sizes)), sizes)[:n]
    inside = np.arange(n) - first[text] <= sizes[text] - length
    starts = np.flatnonzero(inside)
    at, text = at[starts], text[starts]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)
    run = np.flatnonzero(new)
    counts = np.diff(np.append(run, len(at)))
    text, at = text[run], at[run]
    return grams[at], text, at - first[text], starts[run] - first[text], counts, first


def _bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of the texts of a column without nulls, made all at once: an Arrow scalar for each costs more than they do."""
    return column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()).to_numpy(zero_copy_only=False).tolist()


def _marks(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(starts, masks) of each row's marks; none for a null."""
    flat, cuts = column.flatten(), np.concatenate(([0], np.cumsum(pa.compute.fill_null(pa.compute.list_value_length(column), 0).to_numpy())))
    starts, masks = (flat.field(name).to_numpy() for name in ("start", "mask"))
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        yield starts[a:b], masks[a:b].view(np.uint64)


def _chunks(rows: list[bytes]) -> Iterator[tuple[int, int]]:
    a = held = 0
    for k, t in enumerate(rows):
        if held and held + len(t) > CHUNK_BYTES:
            yield a, k
            a, held = k, 0
        held += len(t)
    if rows:
        yield a, len(rows)


def _cut_long(t: bytes, length: int, most: int = 1 << 25) -> list[tuple[int, bytes]]:
    """Parts of a text that share all but one byte of a window, so that each window lies in just one."""
    return [(k, t[k:k + most]) for k in range(0, max(1, len(t) - length + 1), most - length + 1)]


def _anchor_records(batches: Iterator[pa.RecordBatch], buckets: int, length: int) -> Iterator[pa.RecordBatch]:
    """Blobs of records by bucket; buckets from ``buckets`` on hold anchors known to be repeated."""
    for batch in batches:
        ids = batch.column(0).to_numpy()
        keep = np.unique(ids, return_index=True)[1]
        parts = [(int(ids[k]), at, p) for k, t in zip(keep, _bytes(batch.column(1).take(pa.array(keep)))) for at, p in _cut_long(t, length)]
        found = []
        for a, b in _chunks([p for _, _, p in parts]):
            k, text, pos, _, _, _ = anchors([p for _, _, p in parts[a:b]], length)
            rec = np.zeros(len(k), _RECORD)
            rec["k"], rec["t"] = k, np.array([t for t, _, _ in parts[a:b]], np.int64)[text]
            rec["pos"] = pos + np.array([at for _, at, _ in parts[a:b]], np.int64)[text]
            found.append(rec)
        if not found:
            continue
        rec = np.concatenate(found)
        rec = rec[np.argsort(rec["k"], kind="stable")]
        if not len(rec):
            continue
        head = np.flatnonzero(np.concatenate(([True], rec["k"][1:] != rec["k"][:-1])))
        several = np.minimum.reduceat(rec["t"], head) != np.maximum.reduceat(rec["t"], head)
        twice = np.repeat(several, np.diff(np.append(head, len(rec))))
        told = rec[head[several]].copy()
        told["pos"] = _KNOWN
        sent = np.concatenate((rec[~twice], told))
        sure = rec[twice]
        for part, bucket in ((sent, (sent["k"] % np.uint64(buckets)).astype(np.int64)),
                             (sure, buckets + (sure["t"].view(np.uint64) % np.uint64(buckets)).astype(np.int64) if len(sure) else np.zeros(0, np.int64))):
            order = np.argsort(bucket, kind="stable")
            part, bucket = part[order], bucket[order]
            cuts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(bucket) else []
            if len(cuts):
                ends = np.append(cuts[1:], len(bucket))
                yield pa.RecordBatch.from_arrays([pa.array(bucket[cuts]), pa.array([part[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary())],
                                                 names=["bucket", "records"])


def repeated_anchors(rows: DataFrame, total_bytes: int, length: int) -> DataFrame:
    """(t1, pos) of anchors that occur in two or more texts."""
    buckets = max(1, math.ceil(total_bytes * 2 / (length - GRAM + 2) / BUCKET_ANCHORS))

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _anchor_records(batches, buckets, length)

    def classes(key: tuple, table: pa.Table) -> pa.Table:
        rec = np.concatenate([np.frombuffer(x.as_py(), _RECORD) for x in table.column("records")])
        if key[0].as_py() < buckets:
            rec = rec[np.argsort(rec["k"], kind="stable")]
            head = np.flatnonzero(np.concatenate(([True], rec["k"][1:] != rec["k"][:-1])))
            known = np.logical_or.reduceat(rec["pos"] == _KNOWN, head)
            several = known | (np.minimum.reduceat(rec["t"], head) != np.maximum.reduceat(rec["t"], head))
            rec = rec[np.repeat(several, np.diff(np.append(head, len(rec)))) & (rec["pos"] != _KNOWN)]
        return pa.table({"t1": rec["t"].astype(np.int64), "pos": rec["pos"].astype(np.int64)})

    return (rows.select("t1", "text").mapInArrow(records, "bucket long, records binary")
            .groupBy("bucket").applyInArrow(classes, "t1 long, pos long"))


def _contexts(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Occurrences: the windows' bytes of each listed anchor of each text."""
    for batch in batches:
        keys = [batch.column(k).to_numpy() for k in range(3)]
        parts = [(k, at, p) for k, t in enumerate(_bytes(batch.column(3))) for at, p in _cut_long(t, length)]
        wanted = [np.unique(x.values.to_numpy()) for x in batch.column(4)]
        for a, b in _chunks([p for _, _, p in parts]):
            mine = parts[a:b]
            k, text, pos, start, count, first = anchors([p for _, _, p in mine], length)
            row, shift = np.array([r for r, _, _ in mine]), np.array([s for _, s, _ in mine], np.int64)
            listed = np.zeros(len(k), bool)
            cuts = np.searchsorted(text, np.arange(len(mine) + 1))
            for j, (r, s, _) in enumerate(mine):
                listed[cuts[j]:cuts[j + 1]] = np.isin(pos[cuts[j]:cuts[j + 1]] + s, wanted[r], assume_unique=False)
            k, text, pos, start, count = (x[listed] for x in (k, text, pos, start, count))
            size = count + length - 1
            ends = np.cumsum(size)
            data = np.frombuffer(b"".join(p for _, _, p in mine), np.uint8)
            begin = first[text] + start
            flat = data[np.repeat(begin - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)]
            context = pa.BinaryArray.from_buffers(pa.binary(), len(size), [
                None, pa.py_buffer(np.concatenate(([0], ends)).astype(np.int32).tobytes()), pa.py_buffer(flat.tobytes())])
            yield pa.RecordBatch.from_arrays([
                *(pa.array(x[row[text]]) for x in keys), pa.array(start + shift[text]), pa.array(k.view(np.int64)),
                pa.array(pos - start), context], names=["t1", "t2", "at", "start", "k", "off", "context"])


def _pair_ranks(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of the pairs in sorted order, and whether each is unique."""
    code = a.astype(np.uint64) * np.uint64(int(b.max()) + 1 if len(b) else 1) + b.astype(np.uint64)
    _, rank, uses = np.unique(code, return_inverse=True, return_counts=True)
    return rank, uses[rank] == 1


def first_documents(contexts: list[bytes], at: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """For each context, the least ``at`` of any context that holds the window at each of its starts, one after another.

    Prefix doubling over all window starts: ranks of 8 bytes, then of pairs of
    ranks at offsets 8, 16, ... up to ``length`` bytes. Starts that are unique
    after a round keep their own ``at`` and leave.
    """
    sizes = np.array([len(c) for c in contexts], np.int64)
    begin = np.cumsum(sizes) - sizes
    counts = sizes - length + 1
    ends = np.cumsum(counts)
    owner = np.repeat(np.arange(len(sizes)), counts)
    start = np.repeat(begin - (ends - counts), counts) + np.arange(int(ends[-1]))
    least = at[owner].copy()
    data = np.frombuffer(b"".join(contexts), np.uint8)
    _, rank = np.unique(_words(data), return_inverse=True)
    alive = np.arange(len(start))
    covered = 8
    while True:
        offset = min(covered, length - covered)
        if not offset or not len(alive):
            break
        # ranks of the places that later rounds look at: all, while short; the pairs of the starts at the end
        if covered + offset < length:
            other = np.concatenate((rank[offset:], np.zeros(offset, rank.dtype)))
            rank, _ = _pair_ranks(rank, other)
            covered += offset
            uses = np.bincount(rank[start[alive]])
            alive = alive[uses[rank[start[alive]]] > 1]
        else:
            full, unique = _pair_ranks(rank[start[alive]], rank[start[alive] + offset])
            alive, full = alive[~unique], full[~unique]
            if len(alive):
                order = np.argsort(full, kind="stable")
                head = np.flatnonzero(np.concatenate(([True], np.diff(full[order]) != 0)))
                low = np.minimum.reduceat(at[owner[alive[order]]], head)
                least[alive[order]] = np.repeat(low, np.diff(np.append(head, len(order))))
            break
    return least


def _class_firsts(table: pa.Table, length: int) -> pa.Table:
    """Verdicts for one bucket of whole classes; classes with one context need no ranks."""
    table = table.sort_by([("k", "ascending"), ("off", "ascending")])
    k, at = table.column("k").to_numpy(), table.column("at").to_numpy()
    column = table.column("context")
    counts = pa.compute.binary_length(column).to_numpy().astype(np.int64) - length + 1
    ends = np.cumsum(counts)
    head = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
    size = np.diff(np.append(head, len(k)))
    firsts = np.repeat(at, counts)
    several = np.flatnonzero(np.repeat(size, size) > 1)
    # equal strings have equal anchors: contexts of other classes never match and may be ranked together
    for a in range(0, len(several), 40_000):
        b = a + 40_000
        while 0 < a < len(several) and k[several[a]] == k[several[a - 1]]:
            a += 1
        while b < len(several) and k[several[b]] == k[several[b - 1]]:
            b += 1
        rows = several[a:b]
        if len(rows):
            n = counts[rows]
            till = np.cumsum(n)
            firsts[np.repeat(ends[rows] - till, n) + np.arange(till[-1])] = first_documents(column.take(pa.array(rows)).to_numpy().tolist(), at[rows], length)
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), pa.array(firsts, pa.int64()))
    return pa.table({"k": table.column("k"), "off": table.column("off"), "context": column, "firsts": lists})


def _masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bit i of an occurrence: its i-th window also starts in a document with a smaller id."""
    for batch in batches:
        lists = batch.column(4)
        counts = pa.compute.list_value_length(lists).to_numpy().astype(np.int64)
        if not len(counts):
            continue
        flat, ends = lists.flatten().to_numpy(), np.cumsum(counts)
        begin = ends - counts
        at = batch.column(2).to_numpy()
        bit = np.where(flat < np.repeat(at, counts), np.uint64(1) << (np.arange(len(flat)) - np.repeat(begin, counts)).astype(np.uint64), np.uint64(0))
        mask = np.bitwise_or.reduceat(bit, begin).view(np.int64)
        keep = np.flatnonzero(mask)
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep)), batch.column(1).take(pa.array(keep)),
                                          batch.column(3).take(pa.array(keep)), pa.array(mask[keep])], names=["t1", "t2", "start", "mask"])


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows with their order key and two hashes of the text."""
    return texts(docs).select("doc_id", F.coalesce("doc_id", F.lit(LAST_ID)).alias("at"),
                              F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(7), F.col("text")).alias("t2"), "text")


def window_masks(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row for each distinct text: (t1, t2, least, marks of (start, mask))."""
    if not GRAM <= length - 1 or length - GRAM + 1 > 63:
        raise ValueError(f"length must be {GRAM + 1} to {GRAM + 62}")
    rows = _keyed(docs)
    sizes = rows.groupBy("t1", "t2").agg(F.min("at").alias("at"), F.first(F.octet_length("text")).cast("long").alias("n"))
    distinct, distinct_path = staged_at(sizes, "distinct-texts")
    total = distinct.agg(F.sum("n")).first()[0] or 0
    eligible = rows.where(F.octet_length("text") >= length)
    listed, listed_path = staged_at(repeated_anchors(eligible, total, length).groupBy("t1").agg(F.collect_list("pos").alias("places")), "anchors")
    held = listed.agg(F.sum(F.size("places"))).first()[0] or 0
    named = listed.join(distinct.select("t1", "t2", "at"), "t1")

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _contexts(batches, length)

    found, found_path = staged_at(eligible.select("t1", "t2", "at", "text").join(named, ["t1", "t2", "at"]).select("t1", "t2", "at", "text", "places")
                   .mapInArrow(contexts, "t1 long, t2 long, at long, start long, k long, off long, context binary")
                   .withColumn("ch", F.xxhash64("context")), "contexts")
    released(docs.sparkSession, listed_path)
    buckets = max(1, math.ceil(held / BUCKET_CONTEXTS))

    def firsts(table: pa.Table) -> pa.Table:
        return _class_firsts(table, length)

    ranked = (found.groupBy("k", "off", "context").agg(F.min("at").alias("at"))
              .groupBy(F.pmod("k", F.lit(buckets)).alias("bucket"))
              .applyInArrow(firsts, "k long, off long, context binary, firsts array<long>")
              .withColumn("ch", F.xxhash64("context")).drop("context"))
    firsts_of, firsts_path = staged_at(ranked, "firsts")
    marks = (found.select("t1", "t2", "at", "start", "k", "off", "ch").join(firsts_of, ["k", "off", "ch"])
             .select("t1", "t2", "at", "start", "firsts").mapInArrow(_masks, "t1 long, t2 long, start long, mask long"))
    by_text = marks.groupBy("t1", "t2").agg(F.collect_set(F.struct("start", "mask")).alias("marks"))
    out = staged(distinct.join(by_text, ["t1", "t2"], "left").select("t1", "t2", F.col("at").alias("least"), "marks"), "marks")
    for path in (distinct_path, found_path, firsts_path):  # nothing reads them any more
        released(docs.sparkSession, path)
    return out


def removed_spans(starts: np.ndarray, masks: np.ndarray, n: int, copy: bool, length: int) -> list[tuple[int, int]]:
    """Maximal removed runs of a text's bytes, ascending."""
    if n >= length and copy:
        return [(0, n)]
    if not len(starts):
        return []
    i, bit = np.nonzero((masks[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1))
    at = np.unique(starts[i] + bit)
    cut = np.flatnonzero(np.diff(at) > length)
    return [(int(a), int(b) + length) for a, b in zip(at[np.concatenate(([0], cut + 1))], at[np.append(cut, len(at) - 1)])]


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, spans, n_bytes, n_removed, n_spans, kept_sha256) of every row.

    ``spans`` are the removed byte ranges [start, end). A null text is empty;
    a null doc_id counts as larger than all others; rows with equal ids don't
    remove each other's bytes. Repeated rows each give a row.
    """
    rows = _keyed(docs).join(window_masks(docs, length), ["t1", "t2"]).select("doc_id", "text", (F.col("at") > F.col("least")).alias("copy"), "marks")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("spans", "n_bytes", "n_removed", "n_spans", "kept_sha256")}
            for raw, copy, marks in zip(_bytes(batch.column(1)), batch.column(2).to_pylist(), _marks(batch.column(3))):
                spans = removed_spans(*marks, len(raw), copy, length)
                sha, at = hashlib.sha256(), 0
                for a, b in spans:
                    sha.update(raw[at:a])
                    at = b
                sha.update(raw[at:])
                for k, v in zip(out, ([{"start": a, "end": b} for a, b in spans], len(raw), sum(b - a for a, b in spans), len(spans), sha.hexdigest())):
                    out[k].append(v)
            kinds = (pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(v, t) for v, t in zip(out.values(), kinds))], names=["doc_id", *out])

    return rows.mapInArrow(cut, "doc_id long, spans array<struct<start:long,end:long>>, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with the repeated bytes cut out of ``text`` and ``n_chars`` counted anew.

    A character stays whole if one of its bytes stays. Rows whose text goes
    altogether are dropped; empty texts stay.
    """
    # private columns beside those of docs, whatever their names
    t1, t2, least, marked, own_at, own_text, is_copy = unused(docs.columns, "t1", "t2", "least", "marks", "at", "plain", "copy")
    keyed = docs.withColumns({own_at: F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)), own_text: F.coalesce("text", F.lit(""))})
    keyed = keyed.withColumns({t1: F.xxhash64(own_text), t2: F.xxhash64(F.lit(7), F.col(own_text))})
    masks = window_masks(docs, length).select(F.col("t1").alias(t1), F.col("t2").alias(t2), F.col("least").alias(least), F.col("marks").alias(marked))
    rows = keyed.join(masks, [t1, t2]).select(*quoted(docs.columns), (F.col(own_at) > F.col(least)).alias(is_copy), F.col(marked))
    names = docs.columns
    at, chars = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, keep = [], []
            for text, copy, marks in zip(batch.column(at).to_pylist(), batch.column(len(names)).to_pylist(), _marks(batch.column(len(names) + 1))):
                raw = (text or "").encode()
                spans = removed_spans(*marks, len(raw), copy, length)
                if spans:
                    parts, end = [], 0
                    for a, b in spans:  # a cut inside a character moves out of the removed run
                        while a < b and a < len(raw) and raw[a] & 0xC0 == 0x80:
                            a += 1
                        while b > a and b < len(raw) and raw[b] & 0xC0 == 0x80:
                            b -= 1
                        parts.append(raw[end:a])
                        end = b
                    text = b"".join((*parts, raw[end:])).decode()
                kept.append(text)
                keep.append(bool(text) or not raw)
            columns = [batch.column(k) for k in range(len(names))]
            columns[at] = pa.array(kept, pa.string())
            if chars is not None:
                columns[chars] = pa.array([n if t is None else len(t) for t, n in zip(kept, columns[chars].to_pylist())], columns[chars].type)
            yield pa.RecordBatch.from_arrays(columns, names=[f"c{k}" for k in range(len(names))]).filter(pa.array(keep, pa.bool_()))

    return map_rows(rows, cut, docs.schema)


def repeat_digest(docs: DataFrame) -> DataFrame:
    """``repeated_spans`` without the spans; nulls, empty and repeated rows as there."""
    return repeated_spans(docs).drop("spans")
