"""Uniform sharding by a hypergeometric communication matrix.

Rows are grouped into partitions by a hash of a unique row number. The exact
number of rows that each partition sends to each shard is drawn once: row sums
are the partition sizes, column sums the shard sizes, and the matrix has the
distribution that a uniform permutation of all rows would give. Each partition
permutes its rows, cuts them by its row of the matrix, the pieces are exchanged
and each shard permutes again. Shard sizes are exact (at most one apart).

Only DataFrame functions touch the rows. The driver draws the matrix from the
partition sizes: one matrix row for ``rows_per_partition`` input rows.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

SHARDS = 24
ROWS_PER_PARTITION = 131_072


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """Good items among ``draws`` taken from ``good + bad`` without replacement.

    Inversion over the values within 12 standard deviations of the mode, whose
    weights follow from the ratio of neighbours; works for counts of any size.
    """
    low, high = max(0, draws - bad), min(good, draws)
    if low == high:
        return low
    total = good + bad
    mode = min(high, max(low, (draws + 1) * (good + 1) // (total + 2)))
    spread = math.sqrt(draws * (good / total) * (bad / total) * ((total - draws) / max(1, total - 1)))
    reach = int(12 * spread) + 12
    a, b = max(low, mode - reach), min(high, mode + reach)
    k = np.arange(a, b, dtype=np.float64)
    ratio = np.log(good - k) + np.log(draws - k) - np.log(k + 1) - np.log(bad - draws + k + 1)
    log_weight = np.concatenate(([0.0], np.cumsum(ratio)))
    weight = np.cumsum(np.exp(log_weight - log_weight.max()))
    return a + int(np.searchsorted(weight, rng.random() * weight[-1], side="right").clip(0, b - a))


def communication_matrix(sizes: list[int], shards: int, seed: int) -> list[list[int]]:
    """Rows to send from each partition to each shard; shard sizes at most one apart."""
    rng = np.random.default_rng(seed)
    total = sum(sizes)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    matrix = []
    for size in sizes:
        left, rest, row = size, sum(room), []
        for s in range(shards):
            rest -= room[s]
            n = hypergeometric(rng, room[s], rest, left)
            row.append(n)
            left -= n
        room = [r - n for r, n in zip(room, row)]
        matrix.append(row)
    return matrix


def uniform_shards(rows: DataFrame, shards: int = SHARDS, seed: int = 17,
                   rows_per_partition: int = ROWS_PER_PARTITION) -> DataFrame:
    """``rows`` with ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in its shard).

    Pass narrow rows: they are staged once and exchanged twice. Every input
    row, repeated ones too, gets one place; columns named shard or slot are
    replaced. An empty table gives no rows; fewer rows than shards leave the
    last shards empty. Row numbers come from the staged files, so a retry
    after a lost executor deals the same rows to the same places.
    """
    rows = rows.drop("shard", "slot")
    rows = staged(rows.withColumn("_row", F.monotonically_increasing_id()), "shard-rows")
    total = rows.count()
    parts = max(1, math.ceil(total / rows_per_partition))

    def draw(k: int) -> Column:
        return F.xxhash64(F.lit(seed + k), F.col("_row"))

    rows = rows.withColumn("_p", F.pmod(draw(0), F.lit(parts)))
    sizes = {r["_p"]: r["n"] for r in rows.groupBy("_p").agg(F.count(F.lit(1)).alias("n")).collect()}
    matrix = communication_matrix([sizes.get(p, 0) for p in range(parts)], shards, seed)
    ends = rows.sparkSession.createDataFrame(
        [(p, [int(x) for x in np.cumsum(row)]) for p, row in enumerate(matrix)], "_p long, _ends array<long>")

    permuted = rows.withColumn("_at", F.row_number().over(Window.partitionBy("_p").orderBy(draw(1), "_row")) - 1)
    sent = staged(permuted.join(ends, "_p")
                  .withColumn("shard", F.size(F.filter("_ends", lambda e: e <= F.col("_at"))))
                  .drop("_ends", "_at", "_p"), "shard-sent")

    cuts = max(1, math.ceil(total / shards / rows_per_partition))
    sent = sent.withColumn("_cut", F.pmod(draw(2), F.lit(cuts)))
    by_shard = Window.partitionBy("shard").orderBy("_cut")
    starts = (sent.groupBy("shard", "_cut").agg(F.count(F.lit(1)).alias("_n"))
              .select("shard", "_cut", (F.sum("_n").over(by_shard) - F.col("_n")).alias("_start")))
    again = Window.partitionBy("shard", "_cut").orderBy(draw(3), "_row")
    return (sent.withColumn("_at", F.row_number().over(again) - 1).join(starts, ["shard", "_cut"])
            .withColumn("slot", (F.col("_start") + F.col("_at")).cast("long"))
            .drop("_row", "_cut", "_at", "_start"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, seed: int = 17) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every document.

    Law ``rows``: shard counts are at most one apart. A null text has no bytes
    (size 8, crc32 0); null and repeated doc_ids get places like any other.
    """
    narrow = docs.select(
        F.col("doc_id"), (F.octet_length(F.coalesce(F.col("text"), F.lit(""))) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit(""))).cast("long").alias("text_crc32"))
    return uniform_shards(narrow, shards, seed).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
