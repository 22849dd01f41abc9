"""Registered query of datetime layouts, and its DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.operators.datetimes import coerce_datetimes
from basketry.plans.oracle_ctes import with_ctes
from basketry.sources.views import DriverViews

Query = Callable[[SparkSession, str], DataFrame]

#: Column -> (Spark layout of most rows, layout of every eleventh row, which is another one).
LAYOUTS = {
    "slash": ("yyyy/MM/dd", "yyyy-MM-dd"),
    "day_first": ("dd/MM/yyyy", "yyyy/MM/dd"),
    "month_first": ("M/d/yyyy HH:mm", "dd.MM.yyyy"),
    "iso_z": ("yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd HH:mm:ss"),
    "offset": ("yyyy-MM-dd HH:mm:ss'+02:00'", "yyyy-MM-dd"),
    "minutes": ("yyyy-MM-dd HH:mm", "yyyy-MM-dd HH:mm:ss"),
    "named": ("d MMM yyyy", "MMM d, yyyy"),
    "compact": ("yyyyMMdd", "yyyy/MM/dd"),
}


def coerce_datetime_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates as text in several layouts; the first row's layout is the column's, others become NULL."""
    orders = DriverViews(spark, sf_dir).orders().select("order_id", "_seq", "order_date")
    first = F.col("order_id") == orders.agg(F.min("order_id")).scalar()
    rows = orders.select("order_id", "_seq", *[
        F.when((F.col("order_id") % 11 == 10) & ~first, F.date_format("order_date", other)).otherwise(F.date_format("order_date", usual)).alias(c)
        for c, (usual, other) in LAYOUTS.items()])
    # the first row of the day-first column must show that it is one
    marked = rows.withColumn("day_first", F.when(first, F.lit("31/12/1999")).otherwise(F.col("day_first")))
    return coerce_datetimes(marked, list(LAYOUTS)).drop("_seq")


def queries() -> dict[str, Query]:
    return {"coerce_datetime_layouts": coerce_datetime_layouts}


def _sql() -> str:
    day, minute = "date_trunc('day', order_date)", "date_trunc('minute', order_date)"
    value = {"slash": day, "day_first": f"CASE WHEN order_id = (SELECT MIN(order_id) FROM r_orders) THEN TIMESTAMP '1999-12-31' ELSE {day} END", "month_first": minute, "iso_z": "date_trunc('second', order_date)",
             "offset": "date_trunc('second', order_date) - INTERVAL 2 HOUR", "minutes": minute, "named": day, "compact": day}
    return "SELECT order_id, " + ", ".join(
        f"CASE WHEN order_id % 11 <> 10 OR order_id = (SELECT MIN(order_id) FROM r_orders) THEN CAST({v} AS TIMESTAMP) END AS {c}" for c, v in value.items()) + " FROM r_orders"


def oracle_sql() -> dict[str, str]:
    return {"coerce_datetime_layouts": with_ctes(_sql())}
