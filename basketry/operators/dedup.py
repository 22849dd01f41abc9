"""Keep-last deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.operators.joins import unless_large
from basketry.session import scratch_dir

#: A row's number in its table, by file and place (``sources.records``).
SEQ = "_seq"


def keep_last(df: DataFrame, key: str | list[str], order: str = SEQ) -> DataFrame:
    """One row per key: the row that comes last in ``order``.

    ``row_number() = 1`` over (key, order desc): Spark plans a partial
    WindowGroupLimit *before* the shuffle, so every map task forwards at most
    one row per key and a key holding a third of the data never reaches a
    single reducer in full. Ties in ``order`` cannot occur for a positional
    order; an equal order value keeps an arbitrary one of the tied rows.
    """
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    return (df.withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") == 1).drop("_rn"))


#: Up to one row in so many, rows of repeated keys are ranked apart from the others.
FEW = 10


def keep_last_of_few(df: DataFrame, key: str, order: str = SEQ) -> DataFrame:
    """``keep_last`` of a table where most keys occur once; the same rows.

    One aggregate of the key alone finds the keys that occur more than once, and
    is done before the result is returned. Without any, every row stays as it
    is. A few are ranked apart: the other rows are neither sorted nor shuffled.
    Where more than one row in ``FEW`` has such a key, all rows are ranked.
    """
    counted = df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    obs = Observation()
    path = scratch_dir(df.sparkSession, "repeated")
    (counted.observe(obs, F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).alias("repeated"))
     .where(F.col("_n") > 1).select("_key").write.parquet(path))
    found = obs.get
    if not found["repeated"]:
        return df
    if found["repeated"] * FEW > found["rows"]:
        return keep_last(df, key, order)
    repeated = df.sparkSession.read.schema(T.StructType([T.StructField("_key", df.schema[key].dataType)])).parquet(path)
    repeated = unless_large(repeated)
    same = F.col(key).eqNullSafe(F.col("_key"))
    return df.join(repeated, same, "left_anti").unionByName(keep_last(df.join(repeated, same, "left_semi"), key, order))


def dedup_report(df: DataFrame, key: str | list[str]) -> DataFrame:
    """rows_before, rows_after, removed of keep-last on ``key``: one pre-aggregated group-by."""
    keys = [key] if isinstance(key, str) else list(key)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows_before"), F.count(F.lit(1)).alias("rows_after")) \
        .withColumn("removed", F.col("rows_before") - F.col("rows_after"))
