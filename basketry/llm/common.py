"""Shared pieces of the corpus operators: input columns, staging, ranks, components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.session import scratch_dir

#: A null doc_id sorts after every other one.
LAST_ID = 2**63 - 1
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) of every row; a null text is empty, other columns go."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the cluster's shared folder and read it back.

    Cuts the lineage with a columnar file: later branches read only their
    columns, and a lost executor re-reads files instead of recomputing.
    """
    return staged_at(df, name)[0]


def staged_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``staged``, with the folder, for a caller that gives it back with ``released``."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")  # the write's shuffle files go when it ends
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEAN_UP) if before is None else spark.conf.set(CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path), path


def released(spark: SparkSession, path: str) -> None:
    """Delete a staged folder that nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def unused(columns: list[str], *names: str) -> list[str]:
    """``names``, each with as many underscores before it as it takes to be none of ``columns`` (in any case)."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def quoted(columns: list[str]) -> list[Column]:
    """Columns by name, whatever characters the names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in columns]


def map_rows(df: DataFrame, run, schema: T.StructType) -> DataFrame:
    """``df.mapInArrow(run, schema)`` for columns of any name, dots included: ``run`` sees and gives them by position."""
    plain = T.StructType([T.StructField(f"c{k}", f.dataType, f.nullable) for k, f in enumerate(schema.fields)])
    return df.toDF(*[f"c{k}" for k in range(len(df.columns))]).mapInArrow(run, plain).toDF(*schema.names)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once (a one-element transform)."""
    return F.transform(F.array(value), body)[0]


def salted_rank(df: DataFrame, keys: list[str], order: list[str], salt: Column,
                rows_per_part: int = 512, name: str = "rank") -> DataFrame:
    """Add ``name``: 0.. within each key group, every value once.

    A group may hold any share of the rows: it is cut into parts by ``salt``
    (a well-mixed 64-bit hash), each part is ranked alone by ``order``, and
    the parts' counts give their starts. ``df`` is read twice.
    """
    # a struct of nulls equals another in a join, a null does not
    df = df.withColumn("_key", F.struct(*keys))
    widths = df.groupBy("_key").agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / rows_per_part)).cast("long").alias("_w"))
    cut = df.join(widths, "_key").withColumn("_part", F.pmod(salt, F.col("_w")))
    by = Window.partitionBy("_key").orderBy("_part")
    starts = (cut.groupBy("_key", "_part").agg(F.count(F.lit(1)).alias("_n"))
              .select("_key", "_part", (F.sum("_n").over(by) - F.col("_n")).alias("_start")))
    within = Window.partitionBy("_key", "_part").orderBy(*order)
    return (cut.withColumn("_at", F.row_number().over(within) - 1).join(starts, ["_key", "_part"])
            .withColumn(name, F.col("_start") + F.col("_at")).drop("_key", "_w", "_part", "_start", "_at"))


def components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """Smallest reachable id of every vertex with an edge: (id, component_id).

    ``edges`` has long columns a, b (any order, no self loops). Alternating
    large-star and small-star steps, each one shuffle and a grouped minimum;
    the edge list never grows, and the rounds grow with the logarithm of the
    longest path. Each round is staged, so a lost executor re-reads it.
    A vertex of any degree is handled by a partial ``min`` and a plain join.
    """
    cur, path = staged_at(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                 .where("u <> v").distinct(), f"{name}-0")
    step = 0
    while True:
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        down, down_path = staged_at(large, f"{name}-{step}l")
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (down.join(low, "u").select(F.explode(F.array(
            F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v").where("u <> v").distinct())
        nxt, nxt_path = staged_at(small, f"{name}-{step}s")
        for old in (path, down_path):  # nothing reads them any more
            released(edges.sparkSession, old)
        step += 1
        # stars have one parent for each child, and no parent is a child
        left = nxt.groupBy("u").agg(F.count(F.lit(1)).alias("n"))
        state = (left.join(nxt.select(F.col("v").alias("u")).distinct().withColumn("p", F.lit(1)), "u", "left")
                 .where("n > 1 or p is not null").limit(1).count())
        cur, path = nxt, nxt_path
        if not state:
            break
    return cur.select(F.col("u").alias("id"), F.col("v").alias("component_id")).unionByName(
        cur.select(F.col("v").alias("id"), F.col("v").alias("component_id")).distinct())


def rows_schema(spec: str) -> T.StructType:
    return T._parse_datatype_string(spec)
