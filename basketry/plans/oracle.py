"""DuckDB oracle SQL for every registered query that SQL can express."""

from __future__ import annotations

from basketry.operators import quality as Q
from basketry.plans import clean as CL
from basketry.plans import enrich as EN
from basketry.plans import date_queries, number_queries, source_queries
from basketry.plans.oracle_ctes import AMOUNT_COLUMNS, msum, to_number, to_timestamp, with_ctes

_SPEND = f"COALESCE({msum('total_amount')}, 0.0)"

METRIC_SQL: dict[str, str] = {
    "monthly_sales": f"""
SELECT order_month, {_SPEND} AS total_revenue, COUNT(order_id) AS orders
FROM e_orders WHERE order_month IS NOT NULL GROUP BY order_month""",

    "top_spenders": f"""
SELECT * FROM (
  SELECT customer_id, COUNT(order_id) AS total_orders, {_SPEND} AS total_spent,
         MAX(order_date) AS last_order_date, MIN(email) AS email
  FROM e_orders WHERE customer_id IS NOT NULL GROUP BY customer_id) g,
  LATERAL (SELECT g.total_spent / NULLIF(CAST(g.total_orders AS DOUBLE), 0) AS avg_ticket) a
WHERE total_spent >= (
  SELECT quantile_cont(total_spent, 0.8) FROM (
    SELECT {_SPEND} AS total_spent FROM e_orders
    WHERE customer_id IS NOT NULL GROUP BY customer_id))
ORDER BY total_spent DESC, customer_id ASC LIMIT 5""",

    "recurring_customers": """
SELECT customer_id, COUNT(order_id) AS total_orders, MIN(email) AS email
FROM e_orders WHERE customer_id IS NOT NULL GROUP BY customer_id
HAVING COUNT(order_id) >= 2""",

    "average_ticket": f"""
SELECT COALESCE({msum('total_amount')} / NULLIF(COUNT(total_amount), 0), 0.0) AS average_ticket
FROM e_orders""",

    "promotion_usage_rate": """
SELECT AVG(CAST(used_promotion AS INTEGER)) AS promotion_usage_rate FROM e_orders""",

    "status_funnel": """
SELECT status, COUNT(*) AS orders,
       COALESCE(COUNT(*) / NULLIF(CAST(SUM(COUNT(*)) OVER () AS DOUBLE), 0), 0.0) AS share
FROM e_orders WHERE status IS NOT NULL GROUP BY status""",

    "cancellation_rate": """
SELECT AVG(CAST(COALESCE(lower(status) = 'cancelled', FALSE) AS INTEGER)) AS cancellation_rate
FROM e_orders""",

    "delivery_rate": """
SELECT AVG(CAST(COALESCE(lower(status) = 'delivered', FALSE) AS INTEGER)) AS delivery_rate
FROM e_orders""",

    "backlog_in_progress": f"""
SELECT order_month, COUNT(order_id) AS backlog_orders, {_SPEND} AS backlog_value
FROM e_orders
WHERE COALESCE(lower(status) IN ('pending', 'processing', 'shipped'), FALSE)
  AND order_month IS NOT NULL
GROUP BY order_month""",

    "order_rates": f"""
SELECT COALESCE({msum('total_amount')} / NULLIF(COUNT(total_amount), 0), 0.0) AS average_ticket,
       AVG(CAST(used_promotion AS INTEGER)) AS promotion_usage_rate,
       AVG(CAST(COALESCE(lower(status) = 'cancelled', FALSE) AS INTEGER)) AS cancellation_rate,
       AVG(CAST(COALESCE(lower(status) = 'delivered', FALSE) AS INTEGER)) AS delivery_rate
FROM e_orders""",

    "top_products_by_quantity": """
SELECT g.product_id, g.total_units, g.revenue, p.product_name
FROM (SELECT product_id, CAST(SUM(quantity) AS BIGINT) AS total_units,
             COALESCE(CAST(SUM(subtotal) AS DOUBLE), 0.0) AS revenue
      FROM r_order_items WHERE product_id IS NOT NULL GROUP BY product_id) g
LEFT JOIN r_products p ON p.product_id = g.product_id
ORDER BY g.total_units DESC NULLS LAST, g.product_id ASC, p.product_name ASC NULLS LAST
LIMIT 10""",

    "top_products_by_revenue": """
SELECT g.product_id, g.revenue, g.total_units, p.product_name
FROM (SELECT product_id, CAST(SUM(quantity) AS BIGINT) AS total_units,
             COALESCE(CAST(SUM(subtotal) AS DOUBLE), 0.0) AS revenue
      FROM r_order_items WHERE product_id IS NOT NULL GROUP BY product_id) g
LEFT JOIN r_products p ON p.product_id = g.product_id
ORDER BY g.revenue DESC NULLS LAST, g.product_id ASC, p.product_name ASC NULLS LAST
LIMIT 10""",

    "items_per_order": """
SELECT order_id, CAST(SUM(quantity) AS BIGINT) AS items_count
FROM r_order_items WHERE order_id IS NOT NULL GROUP BY order_id""",

    "inventory_health": """
SELECT m.metric, m.value, m.pct FROM (
  SELECT COUNT(*) AS t, COUNT(*) FILTER (WHERE is_low_stock) AS l,
         COUNT(*) FILTER (WHERE is_overstock) AS o FROM e_inventory) a,
LATERAL (VALUES ('total_items', a.t, 1.0E0),
                ('low_stock', a.l, CASE WHEN a.t > 0 THEN a.l / CAST(a.t AS DOUBLE) ELSE 0.0E0 END),
                ('overstock', a.o, CASE WHEN a.t > 0 THEN a.o / CAST(a.t AS DOUBLE) ELSE 0.0E0 END))
        AS m(metric, value, pct)""",

    "low_stock_items": """
SELECT product_id, product_name, warehouse_id, quantity, min_stock_level,
       CASE WHEN min_stock_level - quantity < 0 THEN 0 ELSE min_stock_level - quantity END AS stock_gap
FROM e_inventory WHERE is_low_stock
ORDER BY stock_gap DESC NULLS LAST, product_id, warehouse_id, product_name NULLS LAST
LIMIT 20""",

    "warehouse_utilization": """
SELECT g.warehouse_id, g.location, g.total_units, c.capacity_units,
       g.total_units / NULLIF(CAST(c.capacity_units AS DOUBLE), 0) AS utilization
FROM (SELECT warehouse_id, MIN(location) AS location,
             COALESCE(CAST(SUM(quantity) AS BIGINT), 0) AS total_units
      FROM e_inventory WHERE warehouse_id IS NOT NULL GROUP BY warehouse_id) g
LEFT JOIN (SELECT DISTINCT warehouse_id, capacity_units FROM e_inventory) c
  ON c.warehouse_id = g.warehouse_id""",

    "reviews_overview": """
SELECT AVG(rating) AS average_rating,
       AVG(CAST(is_positive AS INTEGER)) AS positive_rate,
       AVG(CAST(is_negative AS INTEGER)) AS negative_rate,
       COUNT(*) AS review_count
FROM e_reviews""",

    "reviews_by_product": """
SELECT product_id, MIN(product_name) AS product_name, AVG(rating) AS average_rating,
       COUNT(review_id) AS review_count, AVG(CAST(is_positive AS INTEGER)) AS positive_rate
FROM e_reviews WHERE product_id IS NOT NULL GROUP BY product_id
HAVING COUNT(review_id) >= 3
ORDER BY average_rating DESC NULLS LAST, review_count DESC, product_id ASC
LIMIT 20""",

    "reviews_monthly": """
SELECT review_month, COUNT(review_id) AS volume, AVG(rating) AS average_rating
FROM e_reviews WHERE review_month IS NOT NULL GROUP BY review_month""",
}

TABLE_SQL: dict[str, str] = {
    "clean_orders": "SELECT * FROM c_orders",
    "clean_inventory": "SELECT * FROM c_inventory",
    "clean_reviews": "SELECT * FROM c_reviews",
    "enrich_orders": "SELECT * FROM e_orders",
    "enrich_inventory": "SELECT * FROM e_inventory",
    "enrich_reviews": "SELECT * FROM e_reviews",
}


ORDER_COLUMNS = ["order_id", "customer_id", "order_date", "promotion_id", "subtotal",
                 "discount_percent", "shipping_cost", "tax_amount", "total_amount", "status", "notes"]
DOUBLE_ORDER_COLUMNS = set(AMOUNT_COLUMNS)


def rule_metrics_sql(table: str, rules, all_columns=None, prefix: str = "") -> str:
    """The select-list of ``quality.rule_metrics`` over ``table`` as SQL.

    Uniqueness columns come from a scalar sub-query per column.
    """
    items: dict[str, str] = {"rows": "COUNT(*)"}
    for r in rules:
        if r.kind == "no_nulls":
            for c in (r.columns or all_columns):
                items.setdefault(f"{c}__nulls", f"COUNT(*) FILTER (WHERE {c} IS NULL)")
        elif r.kind == "range":
            c = r.columns[0]
            x = f"(CASE WHEN isnan({c}) THEN NULL ELSE {c} END)" if c in DOUBLE_ORDER_COLUMNS else c
            items.setdefault(f"{c}__nulls", f"COUNT(*) FILTER (WHERE {x} IS NULL)")
            items.setdefault(f"{c}__n", f"COUNT({x})")
            for side, sign, bound in (("below", "<", r.min_value), ("above", ">", r.max_value)):
                if bound is not None:
                    name = str(bound).translate({ord("."): "p", ord("-"): "m"})
                    items[f"{c}__{side}_{name}"] = f"COUNT(*) FILTER (WHERE {x} {sign} {bound})"
            items.setdefault(f"{c}__min", f"CAST(MIN({x}) AS DOUBLE)")
            items.setdefault(f"{c}__max", f"CAST(MAX({x}) AS DOUBLE)")
        elif r.kind == "unique":
            for c in r.columns:
                items.setdefault(
                    f"{c}__dups",
                    f"(SELECT CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) FROM "
                    f"(SELECT COUNT(*) AS n FROM {table} GROUP BY {c}))")
    cols = ", ".join(f"{expr} AS {prefix}{name}" for name, expr in items.items())
    return f"SELECT {cols} FROM {table}"


def _fill_sql(replacements: dict[str, str], where: str = "") -> str:
    rep = ", ".join(f"{v} AS {k}" for k, v in replacements.items())
    body = f"SELECT * EXCLUDE (_seq) REPLACE ({rep}) FROM r_orders" if rep else \
        "SELECT * EXCLUDE (_seq) FROM r_orders"
    return body + (f" WHERE {where}" if where else "")


def _mode(c: str) -> str:
    return f"(SELECT {c} FROM r_orders WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY COUNT(*) DESC, {c} LIMIT 1)"


_MEAN = "(SELECT {m} / COUNT({c}) FROM r_orders)"
_MEDIAN = "(SELECT quantile_cont({c}, 0.5) FROM r_orders)"


def _fill_report_sql() -> str:
    parts = []
    for c, strat in CL.ORDERS_FILL.items():
        before = f"COUNT(*) FILTER (WHERE {c} IS NULL)"
        if strat.value == "fill_mean":
            stat = f"{msum(c)} / COUNT({c})"
            after = f"CASE WHEN {stat} IS NULL THEN COUNT(*) FILTER (WHERE {c} IS NULL OR isnan({c})) ELSE 0 END"
        else:
            after = "0"
        parts.append(f"SELECT '{c}' AS \"column\", '{strat.value}' AS strategy, "
                     f"CAST({before} AS BIGINT) AS nulls_before, CAST({after} AS BIGINT) AS nulls_after, "
                     f"CAST({before} - ({after}) AS BIGINT) AS filled FROM r_orders")
    return "\nUNION ALL\n".join(parts)


def _profile_sql() -> str:
    miss = " + ".join(
        (f"CAST(({c} IS NULL OR isnan({c})) AS BIGINT)" if c in DOUBLE_ORDER_COLUMNS
         else f"CAST({c} IS NULL AS BIGINT)") for c in ORDER_COLUMNS)
    n = len(ORDER_COLUMNS)
    return f"""
SELECT rows, CAST({n} AS BIGINT) AS columns, missing_values,
       ROUND(missing_values / GREATEST(rows * {n}, 1) * 100, 2) AS missing_percentage
FROM (SELECT COUNT(*) AS rows, CAST(COALESCE(SUM({miss}), 0) AS BIGINT) AS missing_values FROM r_orders)"""


def _dimension_checks_sql() -> str:
    parts = [
        ("customers", "r_customers", EN.CUSTOMER_RULES, None),
        ("promotions", "r_promotions", EN.PROMOTION_RULES, None),
        ("products", "r_products", EN.REVIEW_PRODUCT_RULES, EN.PRODUCT_COLS),
        ("warehouses", "r_warehouses", EN.WAREHOUSE_RULES, None),
    ]
    subs = [f"({rule_metrics_sql(t, rules, cols, prefix=p + '__')}) {p}" for p, t, rules, cols in parts]
    return "SELECT * FROM " + ", ".join(subs)


_ORDERS_RANGE = [r for r in CL.ORDERS_RULES if r.kind == "range"]
_UNIQUE_COLUMNS = ["order_id", "customer_id", "status", "notes"]
_QUANT = (("total_amount_p10", 0.1), ("total_amount_p50", 0.5), ("total_amount_p80", 0.8),
          ("total_amount_p99", 0.99))

OPERATOR_SQL: dict[str, str] = {
    "fill_drop": _fill_sql({}, "total_amount IS NOT NULL"),
    "fill_zero": _fill_sql({c: f"COALESCE({c}, 0)" for c in
                            ("discount_percent", "shipping_cost", "tax_amount", "promotion_id")}),
    "fill_string": _fill_sql({"notes": "COALESCE(notes, 'Sin Especificar')"}),
    "fill_mean": _fill_sql({c: f"COALESCE({c}, {_MEAN.format(m=msum(c), c=c)})"
                            for c in ("subtotal", "total_amount")}),
    "fill_median": _fill_sql({c: f"COALESCE({c}, {_MEDIAN.format(c=c)})"
                              for c in ("subtotal", "total_amount")}),
    "fill_mode": _fill_sql({c: f"COALESCE({c}, {_mode(c)})" for c in ("notes", "shipping_cost")}),
    "fill_report": _fill_report_sql(),
    "dedup_keep_last": """
SELECT * EXCLUDE (_seq) FROM r_orders_dup
QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY _seq DESC) = 1""",
    "dedup_report": """
SELECT b.rows_before, a.rows_after, b.rows_before - a.rows_after AS removed
FROM (SELECT COUNT(*) AS rows_before FROM r_orders_dup) b,
     (SELECT COUNT(*) AS rows_after FROM (SELECT DISTINCT order_id FROM r_orders_dup)) a""",
    "coerce_numeric": "SELECT * EXCLUDE (_seq) REPLACE (" + ", ".join(
        f"{to_number(c)} AS {c}" for c in AMOUNT_COLUMNS) + ") FROM r_orders_txt",
    "coerce_datetime": f"SELECT * EXCLUDE (_seq) REPLACE ({to_timestamp('order_date')} AS order_date) "
                       f"FROM r_orders_dt",
    "coercion_report": "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", CAST(COUNT(*) FILTER (WHERE {c} IS NOT NULL AND "
        f"({to_number(c)}) IS NULL) AS BIGINT) AS coerced_to_null FROM r_orders_txt"
        for c in AMOUNT_COLUMNS),
    "recalc_total": "SELECT * FROM c_orders_nt",
    "clean_orders_duplicates": "SELECT * FROM c_orders_dup",
    "status_funnel_null_status": """
SELECT status, COUNT(*) AS orders,
       COALESCE(COUNT(*) / NULLIF(CAST(SUM(COUNT(*)) OVER () AS DOUBLE), 0), 0.0) AS share
FROM r_orders_ns WHERE status IS NOT NULL GROUP BY status""",
    "cancellation_rate_null_status": """
SELECT AVG(CAST(COALESCE(lower(status) = 'cancelled', FALSE) AS INTEGER)) AS cancellation_rate
FROM r_orders_ns""",
    "check_keys": rule_metrics_sql("r_orders", [Q.no_nulls(CL.ORDERS_KEYS)]),
    "check_keys_inventory": rule_metrics_sql("r_inventory", [Q.no_nulls(CL.INVENTORY_KEYS)]),
    "check_keys_reviews": rule_metrics_sql("r_reviews", [Q.no_nulls(CL.REVIEWS_KEYS)]),
    "fill_absent": _fill_sql({"notes": "COALESCE(notes, 'Sin Especificar')"}),
    "check_nulls": rule_metrics_sql("r_orders", [Q.no_nulls(None)], ORDER_COLUMNS),
    "check_range": rule_metrics_sql("r_orders", _ORDERS_RANGE),
    "check_unique": rule_metrics_sql("r_orders_dup", [Q.unique(_UNIQUE_COLUMNS)]),
    "check_orders_rules": rule_metrics_sql("c_orders", CL.ORDERS_RULES),
    "check_inventory_rules": rule_metrics_sql("c_inventory", CL.INVENTORY_RULES),
    "check_reviews_rules": rule_metrics_sql("c_reviews", CL.REVIEWS_RULES),
    "check_dimensions": _dimension_checks_sql(),
    "profile_table": _profile_sql(),
    "csv_roundtrip": "SELECT * EXCLUDE (_seq) FROM r_orders",
    "parquet_roundtrip": "SELECT * FROM e_orders",
    "exact_quantiles": "SELECT " + ", ".join(
        f"quantile_cont(total_amount, {p}) AS {n}" for n, p in _QUANT) +
        ", (SELECT quantile_cont(CAST(quantity AS DOUBLE), 0.5) FROM r_order_items) AS quantity_p50 "
        "FROM r_orders",
    "join_orders_customers": """
SELECT o.*, c.segment, CAST(c.registration_date AS TIMESTAMP) AS registration_date,
       c.city, c.country, c.email
FROM c_orders o LEFT JOIN r_customers c ON c.customer_id = o.customer_id""",
    "join_orders_promotions": """
SELECT o.*, p.promotion_type, p.discount_value, CAST(p.start_date AS TIMESTAMP) AS start_date,
       CAST(p.end_date AS TIMESTAMP) AS end_date, p.is_active
FROM c_orders o LEFT JOIN r_promotions p ON p.promotion_id = o.promotion_id""",
    "join_orders_items": """
SELECT o.*, i.items_count FROM c_orders o LEFT JOIN items_count i ON i.order_id = o.order_id""",
    "join_inventory_products": """
SELECT i.*, p.product_name, p.category_id, p.brand_id
FROM c_inventory i LEFT JOIN r_products p ON p.product_id = i.product_id""",
    "join_inventory_warehouses": """
SELECT i.*, w.location, w.capacity_units, w.current_occupancy
FROM c_inventory i LEFT JOIN r_warehouses w ON w.warehouse_id = i.warehouse_id""",
    "join_reviews_products": """
SELECT r.*, p.product_name, p.category_id, p.brand_id
FROM c_reviews r LEFT JOIN r_products p ON p.product_id = r.product_id""",
    "join_reviews_customers": """
SELECT r.*, c.segment, c.city, c.country
FROM c_reviews r LEFT JOIN r_customers c ON c.customer_id = r.customer_id""",
}


# the batch writes the same tables the metric queries compute
BATCH_SQL: dict[str, str] = {
    "batch_monthly_sales": METRIC_SQL["monthly_sales"],
    "batch_top_spenders": METRIC_SQL["top_spenders"],
    "batch_top_products": METRIC_SQL["top_products_by_quantity"],
    "batch_inventory_health": METRIC_SQL["inventory_health"],
    "batch_warehouse_utilization": METRIC_SQL["warehouse_utilization"],
    "batch_reviews_by_product": METRIC_SQL["reviews_by_product"],
    "batch_enriched_orders": TABLE_SQL["enrich_orders"],
    "batch_cancellation_rate": METRIC_SQL["cancellation_rate"],
    "batch_status_funnel": METRIC_SQL["status_funnel"],
    "batch_recurring_customers": METRIC_SQL["recurring_customers"],
    "batch_backlog_in_progress": METRIC_SQL["backlog_in_progress"],
    "batch_low_stock_items": METRIC_SQL["low_stock_items"],
    "batch_reviews_monthly": METRIC_SQL["reviews_monthly"],
    "batch_scalars": "SELECT * FROM (" + METRIC_SQL["average_ticket"] + ") a, (" + METRIC_SQL["promotion_usage_rate"] + ") b, ("
                     + METRIC_SQL["delivery_rate"] + ") c, (" + METRIC_SQL["reviews_overview"] + ") d",
    "batch_enriched_reviews": TABLE_SQL["enrich_reviews"],
    "batch_enriched_inventory": TABLE_SQL["enrich_inventory"],
    # text that isn't a number survives the fill and is missing after it
    "batch_dirty_orders": """
SELECT * REPLACE (CASE WHEN order_id % 29 = 0 THEN NULL ELSE discount_percent END AS discount_percent,
                  CASE WHEN order_id % 31 = 0 THEN NULL ELSE shipping_cost END AS shipping_cost) FROM c_orders""",
    "batch_dirty_inventory": """
SELECT c.* REPLACE (CASE WHEN c.inventory_id % 11 = 0 THEN NULL
                         WHEN c.inventory_id % 13 = 0 AND r.quantity IS NOT NULL THEN CAST(c.quantity AS DOUBLE) + 0.5
                         ELSE CAST(c.quantity AS DOUBLE) END AS quantity,
                    CASE WHEN c.inventory_id % 17 = 0 THEN CAST(c.min_stock_level AS DOUBLE) + 0.5
                         ELSE CAST(c.min_stock_level AS DOUBLE) END AS min_stock_level)
FROM c_inventory c JOIN r_inventory r ON r.inventory_id = c.inventory_id""",
    "batch_dirty_reviews": """
SELECT * REPLACE (CASE WHEN review_id % 17 = 0 THEN NULL WHEN review_id % 19 = 0 THEN 4.5E0
                       ELSE CAST(rating AS DOUBLE) END AS rating,
                  CASE WHEN review_id % 23 = 0 THEN NULL ELSE CAST(helpful_votes AS DOUBLE) END AS helpful_votes)
FROM c_reviews""",
    "csv_long_rows": """
SELECT order_id, customer_id, status, order_id % 10 IN (0, 1) AS is_long FROM r_orders""",
    "check_nulls_nan": """
SELECT COUNT(*) AS rows, COUNT(*) FILTER (WHERE order_id % 5 = 0 OR subtotal IS NULL) AS subtotal__nulls,
       COUNT(*) FILTER (WHERE total_amount IS NULL) AS total_amount__nulls FROM r_orders""",
    "check_range_split": """
SELECT COUNT(*) AS rows, COUNT(*) FILTER (WHERE subtotal IS NULL) AS subtotal__nulls, COUNT(subtotal) AS subtotal__n,
       COUNT(*) FILTER (WHERE subtotal < 1000) AS subtotal__below_1000, COUNT(*) FILTER (WHERE subtotal > 100000) AS subtotal__above_100000,
       MIN(subtotal) AS subtotal__min, MAX(subtotal) AS subtotal__max FROM r_orders""",
}


def oracle_sql() -> dict[str, str]:
    out = {}
    for k, v in {**METRIC_SQL, **TABLE_SQL, **OPERATOR_SQL, **BATCH_SQL}.items():
        out[k] = with_ctes(v)
    return out | source_queries.oracle_sql() | number_queries.oracle_sql() | date_queries.oracle_sql()
