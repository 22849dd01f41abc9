"""Enrichers: left joins with dimension tables plus derived columns.

Join order is chosen for the shuffle plan, output column order follows the
source system. For orders, the items join (J3) goes first: where keep-last dedup
ranks all rows it already hash-partitions cleaned orders by ``order_id``, the key
that the per-order item totals are aggregated on, so J3 adds no exchange on the
orders side; else J3's is the only one by that key. Customers (J1) then shuffle on ``customer_id``; promotions (J2) are a
small dimension that Spark broadcasts under its size threshold. The hot
"no promotion" key 0 never matches a promotion and, on a shuffle join, is
split by AQE's skew handling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions import derived as D
from basketry.functions.coerce import datetime_expr
from basketry.operators import quality as Q
from basketry.operators.joins import left_join
from basketry.operators.metrics import items_per_order

# ----------------------------------------------------------- fixed values --
CUSTOMER_COLS = ["customer_id", "segment", "registration_date", "city", "country", "email"]
PROMOTION_COLS = ["promotion_id", "promotion_type", "discount_value", "start_date", "end_date", "is_active"]
PRODUCT_COLS = ["product_id", "product_name", "category_id", "brand_id"]
WAREHOUSE_COLS = ["warehouse_id", "location", "capacity_units", "current_occupancy"]
REVIEW_CUSTOMER_COLS = ["customer_id", "segment", "city", "country"]

CUSTOMER_RULES = [Q.required_columns(CUSTOMER_COLS), Q.no_nulls(["customer_id"]), Q.unique(["customer_id"])]
PROMOTION_RULES = [Q.required_columns(PROMOTION_COLS),
                   Q.no_nulls(["promotion_id", "promotion_type", "is_active"]),
                   Q.unique(["promotion_id"]),
                   Q.numeric_range("discount_value", min_value=0)]
INVENTORY_PRODUCT_RULES = [Q.required_columns(PRODUCT_COLS), Q.no_nulls(["product_id", "product_name"])]
WAREHOUSE_RULES = [Q.required_columns(WAREHOUSE_COLS), Q.no_nulls(["warehouse_id", "location"])]
REVIEW_PRODUCT_RULES = [Q.required_columns(PRODUCT_COLS), Q.no_nulls(None)]
REVIEW_CUSTOMER_RULES = [Q.required_columns(["customer_id"])]


def _with_ts(df: DataFrame, cols) -> DataFrame:
    return df.select(*[
        datetime_expr(F.col(f.name), f.dataType).alias(f.name) if f.name in cols else F.col(f.name)
        for f in df.schema.fields])


# ---------------------------------------------------------------- joins --
def join_customers(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """J1: orders ⟕ customers (+segment, registration_date, city, country, email)."""
    cust = _with_ts(customers.select(*CUSTOMER_COLS), {"registration_date"})
    return left_join(orders, cust, "customer_id")


def join_promotions(orders: DataFrame, promotions: DataFrame) -> DataFrame:
    """J2: orders ⟕ promotions (+type, discount_value, start/end dates, is_active)."""
    promo = _with_ts(promotions.select(*PROMOTION_COLS), {"start_date", "end_date"})
    return left_join(orders, promo, "promotion_id")


def join_items_count(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """J3: orders ⟕ per-order item totals (aggregate first, then join)."""
    return left_join(orders, items_per_order(order_items), "order_id", measure=False)


def join_products(facts: DataFrame, products: DataFrame) -> DataFrame:
    """J4 / J6: facts ⟕ products (+name, category, brand); duplicate ids fan out."""
    return left_join(facts, products, "product_id", PRODUCT_COLS)


def join_warehouses(inventory: DataFrame, warehouses: DataFrame) -> DataFrame:
    """J5: inventory ⟕ warehouses (+location, capacity, occupancy)."""
    return left_join(inventory, warehouses, "warehouse_id", WAREHOUSE_COLS)


def join_review_customers(reviews: DataFrame, customers: DataFrame) -> DataFrame:
    """J7: reviews ⟕ customers (+segment, city, country)."""
    missing = [c for c in REVIEW_CUSTOMER_COLS if c not in customers.columns]
    if missing:
        from basketry.errors import RuleViolation
        raise RuleViolation("required", dict.fromkeys(sorted(missing)), sorted(customers.columns))
    return left_join(reviews, customers, "customer_id", REVIEW_CUSTOMER_COLS)


# ------------------------------------------------------------- enrichers --
def enrich_orders(orders: DataFrame, customers: DataFrame, promotions: DataFrame,
                  order_items: DataFrame, check: bool = True) -> DataFrame:
    if check:
        Q.enforce(customers, CUSTOMER_RULES)
        Q.enforce(promotions, PROMOTION_RULES)
    else:
        Q.enforce(customers, CUSTOMER_RULES[:1])
        Q.enforce(promotions, PROMOTION_RULES[:1])
    base_cols = list(orders.columns)
    out = join_items_count(orders, order_items)
    out = join_customers(out, customers)
    out = join_promotions(out, promotions)
    return out.select(
        *base_cols,
        *CUSTOMER_COLS[1:],
        *PROMOTION_COLS[1:],
        "items_count",
        D.avg_item_price().alias("avg_item_price"),
        D.month_start("order_date").alias("order_month"),
        D.week_start("order_date").alias("order_week"),
        D.used_promotion().alias("used_promotion"),
        D.is_free_shipping().alias("is_free_shipping"),
        D.is_high_discount().alias("is_high_discount"),
    )


def enrich_inventory(inventory: DataFrame, products: DataFrame, warehouses: DataFrame,
                     check: bool = True) -> DataFrame:
    """Inventory ⟕ products ⟕ warehouses + low/over-stock flags.

    Product and warehouse ids are not required unique (as in the source):
    duplicate dimension keys fan the inventory row out.
    """
    Q.enforce(products, INVENTORY_PRODUCT_RULES if check else INVENTORY_PRODUCT_RULES[:1])
    Q.enforce(warehouses, WAREHOUSE_RULES if check else WAREHOUSE_RULES[:1])
    out = join_products(inventory, products)
    out = join_warehouses(out, warehouses)
    return out.select(
        "*",
        D.is_low_stock().alias("is_low_stock"),
        D.is_overstock().alias("is_overstock"),
    )


def enrich_reviews(reviews: DataFrame, products: DataFrame, customers: DataFrame,
                   check: bool = True) -> DataFrame:
    Q.enforce(products, REVIEW_PRODUCT_RULES if check else REVIEW_PRODUCT_RULES[:1])
    Q.enforce(customers, REVIEW_CUSTOMER_RULES)
    out = join_products(reviews, products)
    out = join_review_customers(out, customers)
    return out.select(
        "*",
        D.month_start("created_at").alias("review_month"),
        D.comment_length().alias("comment_length"),
        D.is_positive().alias("is_positive"),
        D.is_negative().alias("is_negative"),
    )
