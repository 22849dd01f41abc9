"""Text quality by naive-Bayes support vectors.

A text's features are indicators of n-grams: bytes (1 to 3), words, and runs of
1 to 4 flags "this word equals the one before". They are hashed to ``BUCKETS``
slots. Each slot is scaled by the log ratio of its smoothed counts in the two
classes, counted over all labelled training rows. A linear hinge-loss model is
fitted on the scaled, length-normalised indicators of a bounded sample by dual
coordinate descent, and a logistic curve turns margins into scores. The sample
has the distinct rows of each class up to half of the bound; a row weighs as much
as the rows that it stands for.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_rows, released, staged_at, texts

BUCKETS = 1 << 16
#: Distinct rows that the linear model is fitted on at most, half of them for each class (the log ratios use all rows).
FIT_ROWS = 8_000
#: Hinge-loss cost, passes of the descent, and smoothing of the counts.
COST, EPOCHS, SMOOTH = 1.0, 20, 1.0
FOLDS, HELD_OUT_FOLD = 5, 0
THRESHOLD = 0.3

_SPREAD = np.uint32(2654435761)


class Features:
    """Slots of the n-grams of a text, each once, ascending."""

    def __init__(self) -> None:
        self.seen = np.zeros(BUCKETS, bool)
        self.words: dict[bytes, int] = {}

    def __call__(self, text: str) -> np.ndarray:
        raw = text.encode()
        b = np.frombuffer(raw, np.uint8).astype(np.uint32)
        code = np.zeros(len(b), np.uint32)
        for n in range(1, 4):
            if len(b) < n:
                break
            code = (code[:len(b) - n + 1] << np.uint32(8)) | b[n - 1:]
            self.seen[(code * _SPREAD + np.uint32(n * 0x51ED)) >> np.uint32(16)] = True
        words = raw.lower().split()
        if len(self.words) > 500_000:
            self.words = {}
        known = self.words
        slots = []
        for w in words:
            slot = known.get(w)
            if slot is None:
                slot = known[w] = zlib.crc32(w) & (BUCKETS - 1)
            slots.append(slot)
        self.seen[slots] = True
        same = np.fromiter((x == y for x, y in zip(words, words[1:])), np.uint32, max(0, len(words) - 1))
        code = np.zeros(len(same), np.uint32)
        for n in range(1, 5):
            if len(same) < n:
                break
            code = (code[:len(same) - n + 1] << np.uint32(1)) | same[n - 1:]
            self.seen[(np.unique(code) * _SPREAD + np.uint32(n * 0x2F0B)) >> np.uint32(16)] = True
        out = np.flatnonzero(self.seen)
        self.seen[out] = False
        return out


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # of a slot's indicator, log ratio included
    ratio: np.ndarray
    bias: float
    slope: float
    offset: float

    def score(self, slots: np.ndarray) -> float:
        length = np.sqrt((self.ratio[slots] ** 2).sum()) or 1.0
        z = self.slope * (self.weights[slots].sum() / length + self.bias) + self.offset
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -40.0, 40.0))))


def log_ratio(counts: np.ndarray) -> np.ndarray:
    """Per slot, from counts in class 1 and class 0."""
    smooth = counts + SMOOTH
    share = smooth / smooth.sum(axis=0)
    return np.log(share[:, 0]) - np.log(share[:, 1])


def dual_coordinate_descent(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, cost: float = COST,
                            epochs: int = EPOCHS, seed: int = 3, weight: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Weights over scaled features and the bias of a linear hinge-loss model; a row's loss counts ``weight`` times."""
    rng = np.random.default_rng(seed)
    values = [ratio[s] / (np.sqrt((ratio[s] ** 2).sum()) or 1.0) for s in rows]
    square = np.array([v @ v + 1.0 for v in values])
    most = cost * (np.ones(len(rows)) if weight is None else weight)
    weights, bias, alpha = np.zeros(len(ratio)), 0.0, np.zeros(len(rows))
    for _ in range(epochs):
        moved = 0.0
        for k in rng.permutation(len(rows)):
            slope = y[k] * (weights[rows[k]] @ values[k] + bias) - 1.0
            new = min(max(alpha[k] - slope / square[k], 0.0), most[k])
            step = (new - alpha[k]) * y[k]
            if step:
                weights[rows[k]] += step * values[k]
                bias += step
                moved = max(moved, abs(step))
                alpha[k] = new
        if moved < 1e-3 * cost:
            break
    return weights, bias


def logistic_curve(margin: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> tuple[float, float]:
    """Slope and offset that fit P(class 1) to margins, with softened targets."""
    weight = np.ones(len(y)) if weight is None else weight
    pos, neg = weight[y > 0].sum(), weight[y < 0].sum()
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -40, 40)))
        w = weight * np.maximum(p * (1 - p), 1e-9)
        off = weight * (p - target)
        gradient = np.array([(off * margin).sum() + 1e-3 * a, off.sum()])
        hessian = np.array([[(w * margin * margin).sum() + 1e-3, (w * margin).sum()], [(w * margin).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(hessian, gradient)
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-9:
            break
    return max(float(a), 0.0), float(b)


def fit_sample(data: DataFrame, most: int = FIT_ROWS) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """(slots, class as 1 or -1, weight) of at most ``most`` distinct rows of (y, slots), half of them of each class.

    Rows are drawn by a hash of their slots, so all copies of a row are one
    drawn row. Its weight is its number of copies over the share of its class
    that was drawn, scaled so that the least is 1: no class is too rare to count.
    """
    keyed = data.withColumn("h", F.xxhash64("slots")).withColumn("g", F.xxhash64(F.lit(7), F.col("slots")))
    held = {r["y"]: r["n"] for r in keyed.groupBy("y", "h", "g").agg(F.count(F.lit(1)).alias("k")).groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    half, rows = most // 2, []
    for y in sorted(held):
        share = min(1.0, 0.9 * half / held[y]) if held[y] > half else 1.0
        place = F.pmod(F.col("h"), F.lit(1 << 32))
        picked = (keyed.where((F.col("y") == y) & (place < int(share * (1 << 32)))).groupBy("h", "g")
                  .agg(F.first("slots").alias("slots"), F.count(F.lit(1)).alias("n")).orderBy("h", "g").limit(half))
        rows += [(r["slots"], 1.0 if y else -1.0, r["n"] / share) for r in picked.collect()]
    weight = np.array([w for _, _, w in rows])
    return [np.frombuffer(s, "<u2").astype(np.int64) for s, _, _ in rows], np.array([y for _, y, _ in rows]), weight / weight.min()


def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(FOLDS))


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality") -> Model:
    """Learn from the labelled rows outside the held-out fold.

    Null labels and rows without a label don't count; repeated rows count as
    often as they stand. Without rows of both classes every score is the
    smoothed share of class 1.
    """
    # one join plan for every size: both sides are shuffled by id, and a hot id is split
    marked = labels.where(F.col(label_col).isin(0, 1)).select("doc_id", F.col(label_col).cast("int").alias("y"))
    rows = texts(docs).where(fold(F.col("doc_id")) != HELD_OUT_FOLD).join(marked.hint("merge"), "doc_id")

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            for k in range(0, batch.num_rows, 1000):
                part = batch.slice(k, 1000)
                found = [features(t).astype("<u2").tobytes() for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(found, pa.binary())], names=["doc_id", "y", "slots"])

    data, path = staged_at(rows.select("doc_id", "text", "y").mapInArrow(slots, "doc_id long, y int, slots binary"), "quality-slots")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((2, BUCKETS), np.int64), np.zeros(2, np.int64)
        for batch in batches:
            for y, x in zip(batch.column(0).to_pylist(), batch.column(1)):
                total[1 - y, np.frombuffer(x.as_py(), "<u2")] += 1
                n[1 - y] += 1
        met = np.flatnonzero(total.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(np.append(met, BUCKETS)), pa.array(np.append(total[0, met], n[0])),
                                          pa.array(np.append(total[1, met], n[1]))], names=["slot", "good", "bad"])

    counted = (data.select("y", "slots").mapInArrow(count, "slot long, good long, bad long")
               .groupBy("slot").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).toPandas())  # at most BUCKETS + 1 rows
    counts = np.zeros((BUCKETS + 1, 2))
    counts[counted["slot"].to_numpy()] = counted[["good", "bad"]].to_numpy()
    good, bad = counts[BUCKETS]
    if not good or not bad:
        released(docs.sparkSession, path)
        share = (good + SMOOTH) / (good + bad + 2 * SMOOTH)
        return Model(np.zeros(BUCKETS), np.zeros(BUCKETS), 0.0, 0.0, float(np.log(share) - np.log1p(-share)))
    ratio = log_ratio(counts[:BUCKETS])
    found, y, weight = fit_sample(data.select("y", "slots"))
    released(docs.sparkSession, path)
    weights, bias = dual_coordinate_descent(found, y, ratio, weight=weight)
    model = Model(weights * ratio, ratio, bias, 1.0, 0.0)
    length = [np.sqrt((ratio[s] ** 2).sum()) or 1.0 for s in found]
    margin = np.array([model.weights[s].sum() / n + bias for s, n in zip(found, length)])
    slope, offset = logistic_curve(margin, y, weight)
    return Model(weights * ratio, ratio, bias, slope, offset)


def scores(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; empty texts score by the bias alone."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            found = [sent.value.score(features(t)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], names=["doc_id", "score"])

    return (texts(docs).mapInArrow(run, "doc_id long, score double")
            .select("doc_id", (fold(F.col("doc_id")) == HELD_OUT_FOLD).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted")))


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs``, all columns, whose text scores ``threshold`` or more.

    A null text is scored as an empty one; repeated rows all stay or all go.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            good = [sent.value.score(features(t or "")) >= threshold for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(good, pa.bool_()))

    return map_rows(docs, run, docs.schema)
