"""Registered queries of sums, means and missing numbers, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions import derived as D
from basketry.operators import metrics as M
from basketry.operators.exact_sum import exact_mean, exact_sums
from basketry.plans.oracle_ctes import msum, with_ctes
from basketry.sources.views import DriverViews

Query = Callable[[SparkSession, str], DataFrame]
NAN = float("nan")


def sum_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums by status of amounts of every size: huge ones, tiny ones, both, infinity."""
    key = F.col("order_id")
    kinds = {"amounts": F.col("total_amount"),
             "huge": F.when(key % 2 == 0, F.lit(9e31)).otherwise(F.col("total_amount")),
             "tiny": F.when(key % 3 > 0, F.lit(1e-7)),
             "far apart": F.when(key % 4 == 0, F.lit(9e31)).when(key % 4 == 1, F.lit(-9e31)).when(key % 4 == 2, F.lit(1e-7)).otherwise(F.lit(-3e15)),
             "infinite": F.when(key % 100 == 0, F.lit(float("inf"))).otherwise(F.col("total_amount"))}
    rows = DriverViews(spark, sf_dir).orders().select("status", F.explode(F.array(*[
        F.struct(F.lit(k).alias("kind"), v.cast("double").alias("amount")) for k, v in kinds.items()])).alias("r")).select("status", "r.*")
    return exact_sums(rows, ["kind", "status"], {"total": "amount"}).select("kind", "status", "total", exact_mean("total").alias("mean"))


def _nan_where(df: DataFrame, key: str, column: str, every: int) -> DataFrame:
    return df.withColumn(column, F.when(F.col(key) % every == 0, F.lit(NAN)).otherwise(F.col(column).cast("double")))


def nan_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flags, sums and means over columns with NaN: it is missing, as in pandas."""
    v = DriverViews(spark, sf_dir)
    inventory = _nan_where(v.inventory(), "inventory_id", "quantity", 5)
    stock = inventory.agg(F.count_if(D.is_low_stock()).alias("low_stock"), F.count_if(D.is_overstock()).alias("overstock"))
    reviews = _nan_where(v.reviews(), "review_id", "rating", 3).withColumns({"is_positive": D.is_positive(), "is_negative": D.is_negative()})
    rated = M.rating_overview(reviews)
    orders = _nan_where(v.orders(), "order_id", "total_amount", 7).withColumn("order_month", F.trunc("order_date", "month"))
    ticket = M.average_ticket(orders)
    sales = M.monthly_sales(orders).agg(F.max("total_revenue").alias("best_month"), F.min("total_revenue").alias("worst_month"))
    backlog = M.in_progress_backlog(orders).agg(F.max("backlog_value").alias("most_backlog"))

    def long(df: DataFrame) -> DataFrame:
        return df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in df.columns])).alias("r")).select("r.*")

    return reduce(DataFrame.unionByName, map(long, (stock, rated, ticket, sales, backlog)))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (sum_exact, nan_metrics)}


def _parsed(digits: str) -> str:
    """The double nearest to a decimal number given as text."""
    return f"CAST({digits} AS DOUBLE)"


_REVENUE = msum("total_amount")
NUMBER_SQL: dict[str, str] = {
    # whole numbers as text are parsed to the nearest double
    "sum_exact": f"""
SELECT kind, status, total, total / NULLIF(CAST(n AS DOUBLE), 0) AS mean FROM (
SELECT 'amounts' AS kind, status, CAST(SUM(CAST(total_amount AS DECIMAL(38,6))) AS DOUBLE) AS total, COUNT(total_amount) AS n
FROM r_orders GROUP BY status
UNION ALL SELECT 'huge', status, CASE WHEN COUNT(*) FILTER (WHERE order_id % 2 = 0) = 0
       THEN CAST(SUM(CAST(total_amount AS DECIMAL(38,6))) AS DOUBLE)
       ELSE {_parsed("CAST(CAST(COUNT(*) FILTER (WHERE order_id % 2 = 0) AS DECIMAL(38,0)) * 9 * CAST('10000000000000000000000000000000' AS DECIMAL(38,0)) + CAST(TRUNC(COALESCE(SUM(CAST(total_amount AS DECIMAL(38,6))) FILTER (WHERE order_id % 2 <> 0), 0)) AS DECIMAL(38,0)) AS VARCHAR)")} END,
       COUNT(*) FILTER (WHERE order_id % 2 = 0 OR total_amount IS NOT NULL)
FROM r_orders GROUP BY status
UNION ALL SELECT 'tiny', status, CASE WHEN COUNT(*) FILTER (WHERE order_id % 3 > 0) > 0
       THEN {_parsed("concat(CAST(COUNT(*) FILTER (WHERE order_id % 3 > 0) AS VARCHAR), 'E-7')")} END, COUNT(*) FILTER (WHERE order_id % 3 > 0)
FROM r_orders GROUP BY status
UNION ALL SELECT 'far apart', status,
       CASE WHEN a <> b THEN {_parsed("CAST(CAST(a - b AS DECIMAL(38,0)) * 9 * CAST('10000000000000000000000000000000' AS DECIMAL(38,0)) - CAST(d AS DECIMAL(38,0)) * 3000000000000000 AS VARCHAR)")}
            ELSE {_parsed("CAST(CAST(c AS DECIMAL(38,7)) / 10000000 - CAST(d AS DECIMAL(38,7)) * 3000000000000000 AS VARCHAR)")} END, n
FROM (SELECT status, COUNT(*) FILTER (WHERE order_id % 4 = 0) AS a, COUNT(*) FILTER (WHERE order_id % 4 = 1) AS b,
             COUNT(*) FILTER (WHERE order_id % 4 = 2) AS c, COUNT(*) FILTER (WHERE order_id % 4 = 3) AS d, COUNT(*) AS n
      FROM r_orders GROUP BY status)
UNION ALL SELECT 'infinite', status, CASE WHEN COUNT(*) FILTER (WHERE order_id % 100 = 0) > 0 THEN CAST('Infinity' AS DOUBLE)
       ELSE CAST(SUM(CAST(total_amount AS DECIMAL(38,6))) AS DOUBLE) END, COUNT(*) FILTER (WHERE order_id % 100 = 0 OR total_amount IS NOT NULL)
FROM r_orders GROUP BY status)""",
    "nan_metrics": f"""
SELECT m.metric, m.value FROM
 (SELECT COUNT(*) FILTER (WHERE inventory_id % 5 <> 0 AND quantity <= min_stock_level) AS low,
         COUNT(*) FILTER (WHERE inventory_id % 5 <> 0 AND quantity >= max_stock_level) AS high FROM r_inventory) i,
 (SELECT AVG(rating) FILTER (WHERE review_id % 3 <> 0) AS a, COUNT(*) AS n,
         AVG(CAST(COALESCE(review_id % 3 <> 0 AND rating >= 4, FALSE) AS INTEGER)) AS p,
         AVG(CAST(COALESCE(review_id % 3 <> 0 AND rating <= 2, FALSE) AS INTEGER)) AS q FROM r_reviews) r,
 (SELECT COALESCE({_REVENUE} / NULLIF(COUNT(total_amount), 0), 0.0) AS t FROM r_orders WHERE order_id % 7 <> 0) o,
 (SELECT MAX(s) AS best, MIN(s) AS worst FROM (SELECT COALESCE({_REVENUE}, 0.0) AS s FROM
   (SELECT date_trunc('month', order_date) AS month, CASE WHEN order_id % 7 <> 0 THEN total_amount END AS total_amount FROM r_orders) GROUP BY month)) s,
 (SELECT MAX(s) AS most FROM (SELECT COALESCE({_REVENUE}, 0.0) AS s FROM
   (SELECT date_trunc('month', order_date) AS month, CASE WHEN order_id % 7 <> 0 THEN total_amount END AS total_amount FROM r_orders
    WHERE lower(status) IN ('pending', 'processing', 'shipped')) GROUP BY month)) b,
LATERAL (VALUES ('low_stock', CAST(i.low AS DOUBLE)), ('overstock', CAST(i.high AS DOUBLE)), ('average_rating', r.a), ('positive_rate', r.p),
                ('negative_rate', r.q), ('review_count', CAST(r.n AS DOUBLE)), ('average_ticket', o.t), ('best_month', s.best),
                ('worst_month', s.worst), ('most_backlog', b.most)) AS m(metric, value)""",
}


def oracle_sql() -> dict[str, str]:
    return {k: with_ctes(v) for k, v in NUMBER_SQL.items()}
