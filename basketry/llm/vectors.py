"""Exact cosine links of vectors by a pigeonhole join over subspaces.

Unit vectors with cosine >= t are at most 2 - 2t apart in squared distance. A
fixed rotation spreads each vector's length over all coordinates; they are cut
into blocks, and in at least one block two linked vectors are within the
block's share of that budget. Each block is joined alone: its first coordinates
are put on a grid with cells as wide as the block's radius, so partners lie in
the same or a neighbouring cell. Pairs within a block's budget are candidates;
the union over blocks is verified on the vectors themselves in double precision.

Equal vectors of a label are one vertex from the start. A cell that holds many
vertices is cut into fragments and its fragment pairs are compared apart, so no
group grows beyond ``FRAGMENT`` rows a side.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, staged

THRESHOLD = 0.93
#: Coordinates of a block, and how many of them the grid uses.
BLOCK, GRID = 8, 2
#: Rows of a cell that are compared with each other at once.
FRAGMENT = 2_000
#: Added to each budget, against rounding in the filter.
SLACK = 1e-9


def rotation(dim: int, seed: int = 5) -> np.ndarray:
    """A fixed random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def unique_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row for each distinct usable vector of a label: (vid, label, vector, copies, dim).

    Usable: the label is not null, the vector is neither null nor zero nor
    holds null or non-finite components.
    """
    v = F.col(vector_col).cast("array<double>")
    usable = (F.col(label_col).isNotNull() & v.isNotNull() & F.exists(v, lambda x: x != 0)
              & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    plain = F.transform(v, lambda x: x + F.lit(0.0))  # -0.0 and 0.0 are one value
    return (vectors.where(usable).select(F.col(label_col).alias("label"), plain.alias("vector"))
            .groupBy("label", "vector").agg(F.count(F.lit(1)).alias("copies"))
            .withColumn("dim", F.size("vector")).withColumn("vid", F.monotonically_increasing_id()))


def block_entries(unique: DataFrame, threshold: float) -> DataFrame:
    """Where each vertex stands in each block: its own cell, and the cells where lower neighbours look for it.

    (dim, label, block, cell, home, vid, part): ``home`` marks the own cell,
    ``label`` is a hash of the label, whatever its type.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turned: dict[int, np.ndarray] = {}
        for batch in batches:
            vids, dims = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            flat, ends = batch.column(1).flatten().to_numpy(), np.cumsum(dims)
            for dim in np.unique(dims):
                pick = np.flatnonzero(dims == dim)
                x = np.stack([flat[ends[k] - dim:ends[k]] for k in pick])
                x = x / np.abs(x).max(axis=1, keepdims=True)
                x = x / np.linalg.norm(x, axis=1, keepdims=True)
                if dim not in turned:
                    turned[dim] = rotation(int(dim))
                x = x @ turned[dim]
                blocks = -(-int(dim) // BLOCK)
                for b in range(blocks):
                    part = x[:, b * BLOCK:(b + 1) * BLOCK]
                    radius = np.sqrt((2 - 2 * threshold) * part.shape[1] / dim + SLACK)
                    cell = np.floor(part[:, :GRID] / radius).astype(np.int64)
                    width = cell.shape[1]
                    for shift in itertools.product((0, 1), *[(-1, 0, 1)] * (width - 1)):
                        # half of the neighbours: each pair of cells meets once
                        if shift < (0,) * width:
                            continue
                        there = cell - np.array(shift)
                        key = np.concatenate([there, np.zeros((len(there), GRID - width), np.int64)], axis=1)
                        yield pa.RecordBatch.from_arrays([
                            pa.array(np.full(len(pick), dim, np.int32)), batch.column(3).take(pa.array(pick)), pa.array(np.full(len(pick), b, np.int32)),
                            *(pa.array(key[:, g]) for g in range(GRID)), pa.array(np.full(len(pick), not any(shift))), pa.array(vids[pick]),
                            pa.array(list(part.astype(np.float64)), pa.list_(pa.float64()))],
                            names=["dim", "label", "block", *(f"c{g}" for g in range(GRID)), "home", "vid", "part"])

    cells = ", ".join(f"c{g} long" for g in range(GRID))
    return unique.select("vid", "vector", "dim", F.xxhash64("label").alias("label")).mapInArrow(
        run, f"dim int, label long, block int, {cells}, home boolean, vid long, part array<double>")


def candidate_pairs(unique: DataFrame, threshold: float) -> DataFrame:
    """Distinct (u, v), u < v, within budget in some block; labels are equal by hash."""
    entries = staged(block_entries(unique, threshold), "blocks")
    cell = ["dim", "label", "block", *(f"c{g}" for g in range(GRID))]
    crowd = entries.groupBy(*cell).agg(F.count(F.lit(1)).alias("held"), F.max("home").alias("lived"))
    cuts = crowd.where("lived and held > 1").select(*cell, F.ceil(F.col("held") / FRAGMENT).cast("int").alias("cuts"))
    fragments = entries.join(cuts, cell).withColumn("frag", F.pmod(F.xxhash64("vid"), F.col("cuts")).cast("int"))
    # a fragment meets each fragment of its cell once: as (low, high)
    dealt = (fragments.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
             .withColumn("low", F.least("frag", "other")).withColumn("high", F.greatest("frag", "other")))

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        dim = key[0].as_py()
        part = np.stack(table.column("part").to_numpy(zero_copy_only=False))
        vid, home, frag = (table.column(k).to_numpy(zero_copy_only=False) for k in ("vid", "home", "frag"))
        low, high = key[-2].as_py(), key[-1].as_py()
        budget = (2 - 2 * threshold) * part.shape[1] / dim + SLACK
        us, vs = [], []
        square = np.einsum("ij,ij->i", part, part)
        lives = np.flatnonzero(home)
        for at in range(0, len(lives), 512):
            mine = lives[at:at + 512]
            near = square[mine, None] + square[None, :] - 2 * part[mine] @ part.T <= budget
            # both at home: once; one a neighbour: once; within one fragment only in its own group
            near &= ~home[None, :] | (vid[mine, None] < vid[None, :])
            if low != high:
                near &= frag[mine, None] != frag[None, :]
            i, j = np.nonzero(near)
            us.append(vid[mine[i]])
            vs.append(vid[j])
        u, v = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (us, vs))
        pairs = np.unique(np.stack((np.minimum(u, v), np.maximum(u, v)), axis=1), axis=0)
        pairs = pairs[pairs[:, 0] != pairs[:, 1]]
        return pa.table({"u": pairs[:, 0], "v": pairs[:, 1]})

    return dealt.groupBy(*cell, "low", "high").applyInArrow(compare, "u long, v long").distinct()


def vector_links(unique: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(u, v) of all vertex pairs of one label with cosine >= threshold, in double precision."""
    named = unique.select("vid", "vector", "label")
    found = (candidate_pairs(unique, threshold).join(named.toDF("u", "x", "a"), "u")
             .join(named.toDF("v", "y", "b"), "v").where("a = b"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                a, b = np.array(x.as_py()), np.array(y.as_py())
                # powers of two keep the digits and keep the squares in range
                a, b = (z * 2.0 ** -np.floor(np.log2(np.abs(z).max())) for z in (a, b))
                keep.append(bool(a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["u", "v"])

    return found.select("u", "v", "x", "y").mapInArrow(verify, "u long, v long")


def linked_vectors(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id",
                   vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Equal vectors of a label link with each other (their cosine counts as 1).
    Unusable vectors and null labels link with nothing and are kept. Rows
    without an id are linked too; a component takes the smallest id in it.
    Vectors of different lengths never link.
    """
    unique = staged(unique_vectors(vectors, id_col, vector_col, label_col), "unique-vectors")
    links = staged(vector_links(unique, threshold), "vector-links")
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    weight = unique.select(F.col("vid").alias("v"), "copies")
    outer = both.join(weight, "v").groupBy(F.col("u").alias("vid")).agg(F.sum("copies").alias("outer"))
    merged = components(links.select(F.col("u").alias("a"), F.col("v").alias("b")), "vector-cc").withColumnRenamed("id", "vid")
    known = (unique.join(outer, "vid", "left").join(merged, "vid", "left")
             .select(F.struct(F.col("label").alias("label"), F.col("vector").alias("vector")).alias("key"),
                     (F.col("copies") - 1 + F.coalesce("outer", F.lit(0))).alias("n_links"),
                     F.coalesce("component_id", "vid").alias("comp")))
    plain = F.transform(F.col(vector_col).cast("array<double>"), lambda x: x + F.lit(0.0))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.struct(F.col(label_col).alias("label"), plain.alias("vector")).alias("key"))
    placed = staged(rows.join(known, "key", "left").drop("key"), "placed-vectors")
    smallest = placed.where("comp is not null").groupBy("comp").agg(F.min("vec_id").alias("component_id"))
    out = placed.join(smallest, "comp", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("comp").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull()))
