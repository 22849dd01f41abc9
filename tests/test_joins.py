"""No side of a join is broadcast by the size of its files where its rows are many."""

from __future__ import annotations

from pyspark.sql import functions as F

from basketry.operators import dedup, joins
from basketry.plans import enrich as EN
from basketry.sources.views import DriverViews


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_measured_is_the_size_of_the_values(spark):
    df = spark.createDataFrame([(1, "abc", None), (2, None, 1.5), (None, "é", 2.5)], "a long, b string, c double")
    assert joins.measured(df) == 3 * 8 * 4 + 5
    assert joins.measured(df.limit(0)) == 0


def test_a_large_dimension_in_small_files_is_not_broadcast(spark, tmp_path):
    path = str(tmp_path / "customers")
    spark.range(300_000).select(F.col("id").alias("customer_id"), F.lit("a segment of customers").alias("segment"), F.lit("a city of theirs").alias("city"),
                                F.lit("their country").alias("country")).write.option("compression", "zstd").parquet(path)
    reviews = spark.createDataFrame([(1, 5), (2, 299_999), (3, 300_000), (4, None)], "review_id long, customer_id long")
    joined = EN.join_review_customers(reviews, spark.read.parquet(path))
    assert "SortMergeJoin" in _plan(joined) and "BroadcastHashJoin" not in _plan(joined)
    assert sorted(r["review_id"] for r in joined.where("country = 'their country'").collect()) == [1, 2] and joined.count() == 4
    few = EN.join_review_customers(reviews, spark.read.parquet(path).where("customer_id < 10"))
    assert "BroadcastHashJoin" in _plan(few) and few.where("city is not null").count() == 1


def test_the_inventory_view_measures_its_parts(spark, tmp_path):
    folder = str(tmp_path)
    spark.range(900_000).select(F.col("id").alias("p_partkey"), F.lit(7).alias("p_size")).write.parquet(f"{folder}/part.parquet")
    spark.createDataFrame([(5, 1, 2.0, "1996-01-01"), (5, 1, 3.0, "1996-02-01"), (-1, 1, 4.0, "1996-01-01")], "l_partkey long, l_suppkey long, l_quantity double, l_shipdate string") \
        .withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp_ntz")).write.parquet(f"{folder}/lineitem.parquet")
    found = DriverViews(spark, folder, staged=False).inventory()
    assert "BroadcastHashJoin" not in _plan(found)
    assert [(r["inventory_id"], r["quantity"], r["min_stock_level"]) for r in found.collect()] == [(500001, 5, 7)]


def test_many_repeated_keys_are_not_broadcast(spark, monkeypatch):
    rows = [(k, k) for k in range(40)] + [(0, 99), (None, 100), (None, 101)]
    df = spark.createDataFrame(rows, "id long, _seq long")
    whole = sorted(map(str, dedup.keep_last(df, "id").collect()))
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 10)
    found = dedup.keep_last_of_few(df, "id")
    assert "SortMergeJoin" in _plan(found) and "BroadcastHashJoin" not in _plan(found)
    assert sorted(map(str, found.collect())) == whole
