"""Source-table contracts: logical name -> (file stem, schema).

Types say what a column *should* hold. The CSV source reads every field as
text and converts with explicit, non-raising expressions. The ``COERCED``
columns (a cleaner's ids, amounts, stock levels and ratings) stay text where a
file holds anything else, so fills come before coercion. Date columns stay text
until a cleaner/enricher parses them.
"""

from __future__ import annotations

from pyspark.sql import types as T

L, D, S, B = T.LongType(), T.DoubleType(), T.StringType(), T.BooleanType()


def _schema(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


# Logical table -> CSV file stem, and each table's columns.
SOURCE_TABLES = {
    "orders": "ecommerce_orders",
    "order_items": "ecommerce_order_items",
    "customers": "ecommerce_customers",
    "promotions": "ecommerce_promotions",
    "products": "ecommerce_products",
    "reviews": "ecommerce_reviews",
    "inventory": "ecommerce_inventory",
    "warehouses": "ecommerce_warehouses",
}

SCHEMAS: dict[str, T.StructType] = {
    "orders": _schema(("order_id", L), ("customer_id", L), ("order_date", S), ("promotion_id", L),
                      ("subtotal", D), ("discount_percent", D), ("shipping_cost", D),
                      ("tax_amount", D), ("total_amount", D), ("status", S), ("notes", S)),
    "order_items": _schema(("order_id", L), ("product_id", L), ("quantity", L),
                           ("unit_price", D), ("subtotal", D)),
    "customers": _schema(("customer_id", L), ("segment", S), ("registration_date", S),
                         ("email", S), ("city", S), ("country", S)),
    "promotions": _schema(("promotion_id", L), ("promotion_type", S), ("discount_value", D),
                          ("is_active", B), ("start_date", S), ("end_date", S)),
    "products": _schema(("product_id", L), ("product_name", S), ("category_id", L),
                        ("brand_id", L), ("cost", D), ("price", D)),
    "warehouses": _schema(("warehouse_id", L), ("location", S), ("capacity_units", L),
                          ("current_occupancy", L)),
    "inventory": _schema(("inventory_id", L), ("product_id", L), ("warehouse_id", L),
                         ("quantity", L), ("min_stock_level", L), ("max_stock_level", L),
                         ("last_restock_date", S)),
    "reviews": _schema(("review_id", L), ("product_id", L), ("customer_id", L), ("rating", L),
                       ("comment", S), ("helpful_votes", L), ("created_at", S)),
}

#: Columns that a cleaner coerces: their values decide how they are read.
COERCED: dict[str, tuple[str, ...]] = {
    "orders": ("order_id", "customer_id", "promotion_id", "subtotal", "discount_percent", "shipping_cost",
               "tax_amount", "total_amount"),
    "inventory": ("quantity", "min_stock_level", "max_stock_level"),
    "reviews": ("rating", "helpful_votes"),
}
