"""Business metrics over enriched tables (A1-A18).

All are group-bys with partial aggregation (a hot key is combined map-side
before the shuffle) or global folds. Conventions shared by every metric:

* NULL group keys are dropped before grouping (pandas ``groupby``);
* money sums are exact (``exact_sum``) and returned as DOUBLE, 0 for an empty group; NaN is missing;
* "first" of a column that is functionally dependent on the group key (a
  joined dimension attribute) is ``min`` — deterministic and partial-aggregable;
* top-N is ``orderBy(...).limit(n)`` (TakeOrderedAndProject: each task keeps
  n rows) with the group key as tie-breaker;
* a scalar metric is a one-row DataFrame, never a collected value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions import derived as D
from basketry.functions.semantics import false_if_null, nan_to_null, rate, safe_div
from basketry.operators.exact_sum import Partial, exact_mean, exact_sums, is_decimal
from basketry.operators.quantile import exact_quantile
from basketry.operators.scalars import join_row
from basketry.session import materialize

# ----------------------------------------------------------- fixed values --
TOP_SPENDERS_N = 5
TOP_SPENDERS_PERCENTILE = 0.8
RECURRING_MIN_ORDERS = 2
TOP_PRODUCTS_N = 10
LOW_STOCK_ITEMS_N = 20
MIN_REVIEWS_FOR_PRODUCT = 3        # value the batch run passes
RATING_BY_PRODUCT_MIN_DEFAULT = 5  # operator default
TOP_REVIEWED_PRODUCTS_N = 20


def _summed(df: DataFrame, keys: list[str], name: str, amount: str, others: dict[str, Partial]) -> DataFrame:
    """Groups with the exact sum of an amount, 0 for nothing, and other aggregates."""
    if is_decimal(df, amount):
        return df.groupBy(*keys).agg(F.coalesce(F.sum(amount).cast("double"), F.lit(0.0)).alias(name), *[one.alias(k) for k, (one, _) in others.items()])
    return exact_sums(df, keys, {name: amount}, others).select(*keys, F.coalesce(name, F.lit(0.0)).alias(name), *others)


def _keyed(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(key).isNotNull())


def _grouped(df: DataFrame, key: str):
    return _keyed(df, key).groupBy(key)


# ------------------------------------------------------------- customers --
def top_spenders(eo: DataFrame, top_n: int = TOP_SPENDERS_N,
                 percentile: float | None = TOP_SPENDERS_PERCENTILE) -> DataFrame:
    """Customers above the spend ``percentile`` (exact, interpolated), top N by spend."""
    g = (_summed(_keyed(eo, "customer_id"), ["customer_id"], "total_spent", "total_amount", {
        "total_orders": (F.count("order_id"), F.sum), "last_order_date": (F.max("order_date"), F.max)})
        .select("customer_id", "total_orders", "total_spent", "last_order_date", safe_div("total_spent", "total_orders").alias("avg_ticket")))
    if percentile is not None:
        # the per-customer table feeds the ranking and four quantile passes:
        # compute it once (one row per customer, a fraction of the orders)
        g = materialize(g)
        threshold = exact_quantile(g, "total_spent", percentile, alias="_threshold")
        g = g.where(F.col("total_spent") >= threshold.scalar())
    return _top_with_text(g, [F.col("total_spent").desc_nulls_last(), F.col("customer_id").asc()], top_n, eo, "customer_id", "email").select(
        "customer_id", "total_orders", "total_spent", "last_order_date", "email", "avg_ticket")


def _top_with_text(groups: DataFrame, order: list[Column], top_n: int, rows: DataFrame, key: str, text: str) -> DataFrame:
    """The first ``top_n`` groups with the least ``text`` of their rows.

    A text in the groups' own aggregate would have all rows sorted for it; here
    those of at most ``top_n`` keys are (the ranked groups are checkpointed).
    """
    top = materialize(groups.orderBy(*order).limit(top_n))
    texts = rows.select(key, text).join(F.broadcast(top.select(key)), key, "left_semi").groupBy(key).agg(F.min(text).alias(text))
    return top.join(texts, key, "left").orderBy(*order).limit(top_n)


def recurring_customers(eo: DataFrame, min_orders: int = RECURRING_MIN_ORDERS) -> DataFrame:
    # by email too at first: a text is a key of a hash table, but its least value takes a sort of the rows
    g = (_keyed(eo, "customer_id").groupBy("customer_id", "email").agg(F.count("order_id").alias("total_orders"))
         .groupBy("customer_id").agg(F.sum("total_orders").alias("total_orders"), F.min("email").alias("email")))
    return (g.where(F.col("total_orders") >= min_orders)
            .orderBy(F.col("total_orders").desc(), F.col("customer_id").asc()))


def average_ticket(eo: DataFrame) -> DataFrame:
    return exact_sums(eo, [], {"total": "total_amount"}).select(F.coalesce(exact_mean("total"), F.lit(0.0)).alias("average_ticket"))


# -------------------------------------------------------------- products --
def _top_products(items: DataFrame, products: DataFrame, top_n: int, by: str,
                  order_cols: list[str]) -> DataFrame:
    """Aggregate per product, take the top N, then attach names.

    Joining names after the top-N is exact even if a product id repeats in
    ``products``: fan-out only duplicates rows, so the first N rows of the
    joined ranking come from the first N products. Only those N ids
    (a broadcast of at most ``top_n`` rows) filter the product table, which
    is therefore never shuffled; the fact table is aggregated once (the N
    rows are checkpointed).
    """
    g = _summed(_keyed(items, "product_id"), ["product_id"], "revenue", "subtotal", {"total_units": (F.sum("quantity"), F.sum)})
    order = [F.col(by).desc_nulls_last(), F.col("product_id").asc()]
    # the N ranked rows feed both the result and the name filter: computed once
    top = materialize(g.orderBy(*order).limit(top_n))
    names = (products.select("product_id", "product_name")
             .join(F.broadcast(top.select("product_id")), "product_id", "left_semi"))
    joined = top.join(names, "product_id", "left")
    return (joined.orderBy(*order, F.col("product_name").asc_nulls_last())
            .limit(top_n).select(*order_cols))


def top_products_by_quantity(items: DataFrame, products: DataFrame,
                             top_n: int = TOP_PRODUCTS_N) -> DataFrame:
    return _top_products(items, products, top_n, "total_units",
                         ["product_id", "total_units", "revenue", "product_name"])


def top_products_by_revenue(items: DataFrame, products: DataFrame,
                            top_n: int = TOP_PRODUCTS_N) -> DataFrame:
    return _top_products(items, products, top_n, "revenue",
                         ["product_id", "revenue", "total_units", "product_name"])


def items_per_order(order_items: DataFrame) -> DataFrame:
    return _grouped(order_items, "order_id").agg(F.sum("quantity").alias("items_count"))


# ----------------------------------------------------------------- sales --
def monthly_sales(eo: DataFrame) -> DataFrame:
    return _summed(_keyed(eo, "order_month"), ["order_month"], "total_revenue", "total_amount",
                   {"orders": (F.count("order_id"), F.sum)}).orderBy("order_month")


def promotion_usage_rate(eo: DataFrame) -> DataFrame:
    """Share of orders with a promotion; NULL (NaN) when there are no orders."""
    return eo.agg(F.avg(F.col("used_promotion").cast("int")).alias("promotion_usage_rate"))


# ------------------------------------------------------- order lifecycle --
def status_funnel(eo: DataFrame) -> DataFrame:
    """Orders per status (case-sensitive) and share; NULL status excluded from both.

    The total is a one-row aggregate of the per-status counts, joined to them:
    however many status values there are, they never meet in one task.
    """
    counts = _grouped(eo, "status").agg(F.count(F.lit(1)).alias("orders"))
    total = counts.agg(F.sum("orders").alias("_total"))
    return (join_row(counts, total).withColumn("share", F.coalesce(safe_div("orders", "_total"), F.lit(0.0))).drop("_total")
            .orderBy(F.col("orders").desc(), F.col("status").asc()))


def cancellation_rate(eo: DataFrame) -> DataFrame:
    """Share of orders cancelled (any case); NULL status stays in the denominator."""
    return eo.agg(rate(F.lower("status") == D.CANCELLED_STATUS).alias("cancellation_rate"))


def delivery_rate(eo: DataFrame) -> DataFrame:
    return eo.agg(rate(F.lower("status") == D.DELIVERED_STATUS).alias("delivery_rate"))


def in_progress_backlog(eo: DataFrame) -> DataFrame:
    live = eo.where(D.status_in("status", D.IN_PROGRESS_STATUSES))
    return (_summed(_keyed(live, "order_month"), ["order_month"], "backlog_value", "total_amount", {"backlog_orders": (F.count("order_id"), F.sum)})
            .select("order_month", "backlog_orders", "backlog_value").orderBy("order_month"))


def order_rates(eo: DataFrame) -> DataFrame:
    """The four global order ratios in one pass (A3, A7, A9, A10 together)."""
    def yes(pred: Column) -> Partial:
        return F.sum(pred.cast("int")), F.sum

    used = F.col("used_promotion")
    found = exact_sums(eo, [], {"total": "total_amount"}, {
        "used": yes(used), "used_n": (F.count(used), F.sum), "rows": (F.count(F.lit(1)), F.sum),
        "cancelled": yes(false_if_null(F.lower("status") == D.CANCELLED_STATUS)),
        "delivered": yes(false_if_null(F.lower("status") == D.DELIVERED_STATUS))})
    return found.select(
        F.coalesce(exact_mean("total"), F.lit(0.0)).alias("average_ticket"), safe_div("used", "used_n").alias("promotion_usage_rate"),
        safe_div("cancelled", "rows").alias("cancellation_rate"), safe_div("delivered", "rows").alias("delivery_rate"))


# ------------------------------------------------------------- inventory --
def stock_health_summary(ei: DataFrame) -> DataFrame:
    """Three rows metric/value/pct from one aggregate, unpivoted with stack."""
    agg = ei.agg(
        F.count(F.lit(1)).alias("t"),
        F.count_if(F.col("is_low_stock")).alias("l"),
        F.count_if(F.col("is_overstock")).alias("o"),
    )
    pct = lambda c: F.when(F.col("t") > 0, F.col(c) / F.col("t")).otherwise(F.lit(0.0))
    return agg.select(F.explode(F.array(
        F.struct(F.lit("total_items").alias("metric"), F.col("t").alias("value"), F.lit(1.0).alias("pct")),
        F.struct(F.lit("low_stock").alias("metric"), F.col("l").alias("value"), pct("l").alias("pct")),
        F.struct(F.lit("overstock").alias("metric"), F.col("o").alias("value"), pct("o").alias("pct")),
    )).alias("r")).select("r.*")


def low_stock_items(ei: DataFrame, top_n: int = LOW_STOCK_ITEMS_N) -> DataFrame:
    low = ei.where(F.col("is_low_stock")).withColumn("stock_gap", D.stock_gap())
    return (low.orderBy(F.col("stock_gap").desc_nulls_last(), F.col("product_id").asc(),
                        F.col("warehouse_id").asc(), F.col("product_name").asc_nulls_last())
            .limit(top_n)
            .select("product_id", "product_name", "warehouse_id", "quantity",
                    "min_stock_level", "stock_gap"))


def warehouse_utilization(ei: DataFrame) -> DataFrame:
    """Units per warehouse over declared capacity; zero capacity -> NULL.

    One row per distinct (warehouse, capacity) pair, so a warehouse listed
    with two capacities yields two rows (as a join with the distinct pairs
    would). One scan: units are pre-aggregated per pair and location (a text
    is a key of a hash table, but its least value takes a sort of the rows),
    then a window per warehouse over that small table adds the warehouse-wide
    totals.
    """
    pairs = (ei.where(F.col("warehouse_id").isNotNull())
             .groupBy("warehouse_id", "capacity_units", "location").agg(F.sum("quantity").alias("_units"))
             .groupBy("warehouse_id", "capacity_units")
             .agg(F.min("location").alias("_loc"), F.sum("_units").alias("_units")))
    w = Window.partitionBy("warehouse_id")
    return (pairs.select(
        "warehouse_id",
        F.min("_loc").over(w).alias("location"),
        F.coalesce(F.sum("_units").over(w), F.lit(0)).alias("total_units"),
        "capacity_units",
    ).withColumn("utilization", safe_div("total_units", "capacity_units"))
        .orderBy(F.col("utilization").asc_nulls_last(), F.col("warehouse_id").asc()))


# --------------------------------------------------------------- reviews --
def rating_overview(er: DataFrame) -> DataFrame:
    return er.agg(
        F.avg(nan_to_null("rating")).alias("average_rating"),
        F.avg(F.col("is_positive").cast("int")).alias("positive_rate"),
        F.avg(F.col("is_negative").cast("int")).alias("negative_rate"),
        F.count(F.lit(1)).alias("review_count"),
    )


def rating_by_product(er: DataFrame, min_reviews: int = RATING_BY_PRODUCT_MIN_DEFAULT,
                      top_n: int = TOP_REVIEWED_PRODUCTS_N) -> DataFrame:
    g = _grouped(er, "product_id").agg(
        F.avg(nan_to_null("rating")).alias("average_rating"),
        F.count("review_id").alias("review_count"),
        F.avg(F.col("is_positive").cast("int")).alias("positive_rate"),
    )
    order = [F.col("average_rating").desc_nulls_last(), F.col("review_count").desc(), F.col("product_id").asc()]
    return _top_with_text(g.where(F.col("review_count") >= min_reviews), order, top_n, er, "product_id", "product_name").select(
        "product_id", "product_name", "average_rating", "review_count", "positive_rate")


def monthly_review_volume(er: DataFrame) -> DataFrame:
    return (_grouped(er, "review_month").agg(
        F.count("review_id").alias("volume"),
        F.avg(nan_to_null("rating")).alias("average_rating"),
    ).orderBy("review_month"))
