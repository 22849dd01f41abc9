"""Centroid clustering by an incremental distance matrix, in whole numbers.

Every vector becomes whole numbers, and its row keeps the exact dot products
with all centroids. A squared distance is the vector's square plus the
centroid's minus twice the dot product, so the nearest centroid is an argmin
over the row. When centroids move, a dot product changes by the moved components
times the vector's; components that stay cost nothing. Sums of the clusters are
formed in the tasks and added by Spark: the driver holds the centroids only.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import released, staged, staged_at

DIM, CENTROIDS, ROUNDS, SCALE, SEED = 64, 16, 3, 64, 1
#: Rows whose distances are computed at once.
CHUNK = 8_192
STATE = "vec_id long, x array<int>, square long, dots array<long>, cluster int, distance long"


def whole_vectors(vectors: DataFrame, dim: int = DIM, scale: int = SCALE, id_col: str = "vec_id",
                  vector_col: str = "embedding") -> DataFrame:
    """(vec_id, x) of the vectors with ``dim`` components, none null or non-finite; x is floor(scale * component).

    A component so large that squared distances would not fit 64 bits raises an error.
    """
    v = F.col(vector_col).cast("array<double>")
    usable = v.isNotNull() & (F.size(v) == dim) & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    most = math.isqrt(2**60 // dim)
    whole = F.transform(v, lambda c: F.when(F.abs(c * scale) < most, F.floor(c * scale)).otherwise(
        F.raise_error(F.lit(f"a component is beyond {most // scale}: distances would not fit 64 bits")).cast("long")).cast("int"))
    return vectors.where(usable).select(F.col(id_col).cast("long").alias("vec_id"), whole.alias("x"))


def first_centroids(whole: DataFrame, count: int = CENTROIDS, seed: int = SEED) -> list[list[int]]:
    """The vectors with the smallest sha256 of ``seed:vec_id``; equal hashes by component. ``count`` rows at most."""
    place = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    return [list(r["x"]) for r in whole.select(place.alias("place"), "x").orderBy("place", "x").limit(count).collect()]


def _matrix(column: pa.ListArray, kind: type) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(kind, copy=False).reshape(len(column), -1)


def _row_batch(ids: pa.Array, x: pa.ListArray, square: np.ndarray, dots: np.ndarray, centroids: np.ndarray) -> pa.RecordBatch:
    apart = (centroids * centroids).sum(axis=1)[None, :] - 2 * dots
    cluster = apart.argmin(axis=1)  # the first of equal ones
    distance = square + apart[np.arange(len(cluster)), cluster]
    ends = pa.array(np.arange(len(dots) + 1, dtype=np.int32) * dots.shape[1])
    return pa.RecordBatch.from_arrays(
        [ids, x, pa.array(square), pa.ListArray.from_arrays(ends, pa.array(dots.ravel())), pa.array(cluster.astype(np.int32)), pa.array(distance)],
        names=["vec_id", "x", "square", "dots", "cluster", "distance"])


def first_state(whole: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Every vector with its square, its dot products and its nearest centroid."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = batch.slice(at, CHUNK)
                x = _matrix(part.column(1), np.int64)
                yield _row_batch(part.column(0), part.column(1), (x * x).sum(axis=1), x @ centroids.T, centroids)

    return whole.mapInArrow(run, STATE)


def moved_state(state: DataFrame, old: np.ndarray, new: np.ndarray) -> DataFrame:
    """The state under new centroids: only components that changed are multiplied."""
    step = new - old
    moved = [(k, np.flatnonzero(step[k])) for k in range(len(step)) if step[k].any()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = batch.slice(at, CHUNK)
                x, dots = _matrix(part.column(1), np.int64), _matrix(part.column(3), np.int64).copy()
                for k, places in moved:
                    dots[:, k] += x[:, places] @ step[k, places]
                yield _row_batch(part.column(0), part.column(1), part.column(2).to_numpy(), dots, new)

    return state.select("vec_id", "x", "square", "dots").mapInArrow(run, STATE)


def moved_centroids(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """floor(sum / count) of each cluster's components; an empty cluster's centroid stays."""
    count, dim = centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((count, dim), np.int64), np.zeros(count, np.int64)
        for batch in batches:
            x, cluster = _matrix(batch.column(0), np.int64), batch.column(1).to_numpy()
            for k in np.unique(cluster):
                total[k] += x[cluster == k].sum(axis=0)
            n += np.bincount(cluster, minlength=count)
        met = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(n[met]), pa.array(list(total[met]), pa.list_(pa.int64()))],
                                         names=["cluster", "n", "total"])

    parts = state.select("x", "cluster").mapInArrow(sums, "cluster long, n long, total array<long>")
    found = (parts.select("cluster", "n", F.posexplode("total").alias("at", "part")).groupBy("cluster", "at")
             .agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")).collect())  # CENTROIDS * DIM rows
    out = centroids.copy()
    for r in found:
        out[r["cluster"], r["at"]] = int(r["total"]) // r["n"]
    return out


def centroid_clusters(vectors: DataFrame, centroids: int = CENTROIDS, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE,
                      seed: int = SEED, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept vector.

    Vectors that are null, of another length, or hold null or non-finite
    components give no row. Repeated rows and rows without an id each count and
    each give a row; a null id hashes as no digits. Equal distances take the
    smaller number. Fewer vectors than centroids start with as many; an empty
    table gives no rows. Other columns are not read.
    """
    spark = vectors.sparkSession
    whole = staged(whole_vectors(vectors, dim, scale, id_col, vector_col), "whole-vectors")
    now = np.array(first_centroids(whole, centroids, seed), np.int64).reshape(-1, dim)
    if not len(now):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    state, path = staged_at(first_state(whole, now), "distances-0")
    for k in range(rounds):
        then, now = now, moved_centroids(state, now)
        used = path
        state, path = staged_at(moved_state(state, then, now), f"distances-{k + 1}")
        released(spark, used)
    inertia = {r["cluster"]: int(r["total"]) for r in state.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}  # CENTROIDS rows at most
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in now.tolist()]
    return state.select(
        "vec_id", "cluster", "distance",
        F.array(*[F.lit(inertia.get(k, 0)).cast("long") for k in range(len(now))])[F.col("cluster")].alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"),
        F.array(*map(F.lit, digests))[F.col("cluster")].alias("centroid_sha256"))


def _round_sql(k: int) -> str:
    """Assignment to the centroids c{k}, and the centroids c{k + 1}."""
    return f"""
a{k} AS MATERIALIZED (SELECT r, vec_id, x, arg_min(k, (d, k)) AS k, min(d) AS d FROM (
  SELECT r, vec_id, x, c.k, list_sum(list_transform(range(1, 65), lambda i: (x[i] - c.c[i]) * (x[i] - c.c[i])))::BIGINT AS d
  FROM kept, c{k} c) GROUP BY ALL),
s{k} AS (SELECT k, i, sum(x[i])::BIGINT AS s, count(*) AS n FROM a{k}, (SELECT unnest(range(1, 65)) AS i) GROUP BY k, i),
c{k + 1} AS MATERIALIZED (SELECT c.k, coalesce(m.c, c.c) AS c FROM c{k} c LEFT JOIN (
  SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM s{k} GROUP BY k) m ON m.k = c.k)"""


CLUSTERS_SQL = """
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda v: CAST(floor(64 * CAST(v AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda v: v IS NOT NULL AND isfinite(v))) = 64),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, x) - 1 AS k, x AS c FROM (
  SELECT sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, x FROM kept ORDER BY h, x LIMIT 16)),
""" + ",".join(map(_round_sql, range(ROUNDS))) + f""",
final AS (SELECT r, vec_id, arg_min(k, (d, k)) AS k, min(d) AS d FROM (
  SELECT r, vec_id, c.k, list_sum(list_transform(range(1, 65), lambda i: (x[i] - c.c[i]) * (x[i] - c.c[i])))::BIGINT AS d
  FROM kept, c{ROUNDS} c) GROUP BY r, vec_id)
SELECT vec_id, CAST(f.k AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY f.k) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.c, ',')) AS centroid_sha256
FROM final f JOIN c{ROUNDS} c ON c.k = f.k
"""
