"""SQL building blocks for the DuckDB oracle.

Independent SQL statements of the same semantics as the Spark operators,
written against the driver's pre-registered tables. Each block is a CTE
with its dependencies; ``with_ctes`` emits the blocks a final SELECT needs in
dependency order. Money sums are sums of the amounts' shortest decimal texts
(of up to 15 decimals), rounded once by parsing the sum's text.
"""

from __future__ import annotations

import re

MSUM = "CAST(CAST(SUM(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,15))) AS VARCHAR) AS DOUBLE)"


def msum(x: str) -> str:
    return MSUM.format(x=x)


CTES: dict[str, str] = {}

# ----------------------------------------------------- driver -> domain --
CTES["r_order_items"] = """
SELECT l_orderkey AS order_id, l_partkey AS product_id,
       CAST(l_quantity AS BIGINT) AS quantity,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS subtotal
FROM lineitem"""

CTES["r_orders"] = """
SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id, o.o_orderdate AS order_date,
  CASE WHEN o.o_orderkey % 4 = 1 THEN CAST(NULL AS BIGINT)
       ELSE o.o_orderkey % 25 + 1 END AS promotion_id,
  i.subtotal AS subtotal, i.discount_percent AS discount_percent,
  CASE o.o_orderpriority WHEN '1-URGENT' THEN 15.0E0 WHEN '2-HIGH' THEN 10.0E0
       WHEN '3-MEDIUM' THEN 5.0E0 WHEN '5-LOW' THEN 0.0E0 END AS shipping_cost,
  i.tax_amount AS tax_amount,
  CASE WHEN o.o_orderkey % 50 = 7 THEN NULL ELSE o.o_totalprice END AS total_amount,
  CASE WHEN o.o_orderstatus = 'F' THEN 'delivered'
       WHEN o.o_orderstatus = 'P' AND o.o_orderpriority = '5-LOW' THEN 'Cancelled'
       WHEN o.o_orderstatus = 'P' THEN 'pending'
       WHEN o.o_orderpriority = '1-URGENT' THEN 'shipped'
       ELSE 'processing' END AS status,
  CASE WHEN o.o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE o.o_orderpriority END AS notes,
  o.o_orderkey AS _seq
FROM orders o LEFT JOIN (
  SELECT l_orderkey,
         CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS subtotal,
         CAST(MAX(CAST(ROUND(l_discount*100) AS INT))*3 AS DOUBLE) AS discount_percent,
         CAST(MAX(CAST(ROUND(l_tax*100) AS INT)) AS DOUBLE) AS tax_amount
  FROM lineitem GROUP BY l_orderkey) i ON i.l_orderkey = o.o_orderkey"""

CTES["r_customers"] = """
SELECT c.c_custkey AS customer_id, c.c_mktsegment AS segment,
       CAST('1995-01-01' AS DATE) AS registration_date, n.n_name AS city, r.r_name AS country,
       concat('user', CAST(c.c_custkey AS VARCHAR), '@example.com') AS email
FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey
                JOIN region r ON r.r_regionkey = n.n_regionkey"""

CTES["r_promotions"] = """
SELECT CAST(n_nationkey AS BIGINT)+1 AS promotion_id,
       CASE WHEN n_regionkey % 2 = 0 THEN 'coupon' ELSE 'campaign' END AS promotion_type,
       CAST(n_nationkey AS DOUBLE) AS discount_value,
       CAST('1995-01-01' AS DATE) AS start_date, CAST('2001-12-31' AS DATE) AS end_date,
       n_nationkey % 2 = 0 AS is_active
FROM nation"""

CTES["r_products"] = """
SELECT p_partkey AS product_id, p_name AS product_name, CAST(p_size AS BIGINT) AS category_id,
       CAST(replace(p_brand,'Brand#','') AS BIGINT) AS brand_id
FROM part"""

CTES["r_warehouses"] = """
SELECT s_suppkey AS warehouse_id, n_name AS location,
       10000 + CAST(s_suppkey AS BIGINT)*50 AS capacity_units,
       CAST(s_nationkey AS BIGINT)*100 AS current_occupancy
FROM supplier JOIN nation ON n_nationkey = s_nationkey"""

CTES["r_inventory"] = """
SELECT l_partkey*100000+l_suppkey AS inventory_id, l_partkey AS product_id,
       l_suppkey AS warehouse_id,
       CASE WHEN l_partkey % 40 = 3 THEN CAST(NULL AS BIGINT)
            ELSE CAST(SUM(l_quantity) AS BIGINT) END AS quantity,
       CAST(MAX(p_size) AS BIGINT) AS min_stock_level,
       CAST(MAX(p_size) AS BIGINT)+20 AS max_stock_level,
       MAX(l_shipdate) AS last_restock_date,
       l_partkey*100000+l_suppkey AS _seq
FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY l_partkey, l_suppkey"""

CTES["r_reviews"] = """
SELECT event_id AS review_id, event_id % (SELECT COUNT(*) FROM part) AS product_id, user_id AS customer_id,
       CAST(regexp_extract(props,'([0-9]+)',1) AS BIGINT) % 5 + 1 AS rating,
       CASE WHEN event_type='error' THEN NULL ELSE event_type END AS comment,
       CASE WHEN event_id % 6 = 0 THEN CAST(NULL AS BIGINT) ELSE event_id % 6 END AS helpful_votes,
       ts + INTERVAL '30' DAY * CAST(event_id % 12 AS INT) AS created_at,
       event_id AS _seq
FROM events"""

# ------------------------------------------------------------- cleaning --
def orders_clean_ctes(src: str, suffix: str = "") -> dict[str, str]:
    """Fill (means over all rows, duplicates included) -> keep-last -> recalc."""
    return {
        f"o_filled{suffix}": f"""
SELECT order_id, customer_id, order_date,
       COALESCE(promotion_id, 0) AS promotion_id,
       COALESCE(subtotal, s.m_sub) AS subtotal,
       COALESCE(discount_percent, 0) AS discount_percent,
       COALESCE(shipping_cost, 0) AS shipping_cost,
       COALESCE(tax_amount, 0) AS tax_amount,
       COALESCE(total_amount, s.m_tot) AS total_amount,
       status,
       COALESCE(notes, 'Sin Especificar') AS notes,
       _seq
FROM {src}, (SELECT {msum('subtotal')} / COUNT(subtotal) AS m_sub,
                    {msum('total_amount')} / COUNT(total_amount) AS m_tot
             FROM {src}) s""",
        f"c_orders{suffix}": f"""
SELECT order_id, customer_id, order_date, promotion_id, subtotal, discount_percent,
       shipping_cost, tax_amount,
       CASE WHEN total_amount IS NULL AND subtotal IS NOT NULL
            THEN subtotal + COALESCE(shipping_cost, 0) + COALESCE(tax_amount, 0)
                 - subtotal * COALESCE(discount_percent, 0) / 100
            ELSE total_amount END AS total_amount,
       status, notes
FROM o_filled{suffix}
QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY _seq DESC) = 1""",
    }


CTES.update(orders_clean_ctes("r_orders"))

# dirty variants of the orders view
CTES["r_orders_dup"] = """
SELECT * FROM r_orders
UNION ALL
SELECT * REPLACE ('returned' AS status, _seq + 1000000000000 AS _seq)
FROM r_orders WHERE order_id % 100 = 0"""
CTES.update(orders_clean_ctes("r_orders_dup", "_dup"))

CTES["r_orders_nt"] = "SELECT * REPLACE (CAST(NULL AS DOUBLE) AS total_amount) FROM r_orders"
CTES.update(orders_clean_ctes("r_orders_nt", "_nt"))

CTES["r_orders_ns"] = """
SELECT * REPLACE (CASE WHEN order_id % 53 = 0 THEN NULL ELSE status END AS status) FROM r_orders"""

_JUNK = "CASE WHEN order_id % 2 = 0 THEN 'n/a' ELSE 'abc' END"
AMOUNT_COLUMNS = ("subtotal", "discount_percent", "shipping_cost", "tax_amount", "total_amount")
CTES["r_orders_txt"] = "SELECT * REPLACE (" + ", ".join(
    f"CASE WHEN order_id % 97 = 0 THEN {_JUNK} ELSE CAST({c} AS VARCHAR) END AS {c}"
    for c in AMOUNT_COLUMNS) + ") FROM r_orders"

CTES["r_orders_dt"] = """
SELECT * REPLACE (CASE WHEN order_id % 89 = 0 THEN 'not a date'
                       ELSE strftime(order_date, '%Y-%m-%d %H:%M:%S') END AS order_date)
FROM r_orders"""

NUMBER_RE = r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?"


def to_number(x: str) -> str:
    t = f"trim({x})"
    return (f"CASE WHEN regexp_full_match({t}, '{NUMBER_RE}') THEN TRY_CAST({t} AS DOUBLE) "
            f"WHEN lower({t}) IN ('inf', '+inf', 'infinity', '+infinity') THEN CAST('inf' AS DOUBLE) "
            f"WHEN lower({t}) IN ('-inf', '-infinity') THEN CAST('-inf' AS DOUBLE) "
            f"ELSE NULL END")


def to_timestamp(x: str) -> str:
    t = f"trim({x})"
    fmts = ("%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d %H:%M:%S.%f", "%Y-%m-%d")
    return "COALESCE(" + ", ".join(f"try_strptime({t}, '{f}')" for f in fmts) + ")"


CTES["c_inventory"] = """
SELECT inventory_id, product_id, warehouse_id,
       COALESCE(quantity, 0) AS quantity,
       COALESCE(min_stock_level, 0) AS min_stock_level,
       COALESCE(max_stock_level, 0) AS max_stock_level,
       last_restock_date
FROM r_inventory
QUALIFY row_number() OVER (PARTITION BY inventory_id ORDER BY _seq DESC) = 1"""

CTES["c_reviews"] = """
SELECT review_id, product_id, customer_id, rating, comment,
       COALESCE(helpful_votes, 0) AS helpful_votes, created_at
FROM r_reviews
QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY _seq DESC) = 1"""

# ------------------------------------------------------------ enriching --
CTES["items_count"] = """
SELECT order_id, CAST(SUM(quantity) AS BIGINT) AS items_count
FROM r_order_items WHERE order_id IS NOT NULL GROUP BY order_id"""

CTES["e_orders"] = """
SELECT o.order_id, o.customer_id, o.order_date, o.promotion_id, o.subtotal, o.discount_percent,
       o.shipping_cost, o.tax_amount, o.total_amount, o.status, o.notes,
       c.segment, CAST(c.registration_date AS TIMESTAMP) AS registration_date,
       c.city, c.country, c.email,
       p.promotion_type, p.discount_value,
       CAST(p.start_date AS TIMESTAMP) AS start_date, CAST(p.end_date AS TIMESTAMP) AS end_date,
       p.is_active,
       i.items_count,
       COALESCE(o.total_amount / NULLIF(CAST(i.items_count AS DOUBLE), 0), 0.0) AS avg_item_price,
       CAST(date_trunc('month', o.order_date) AS DATE) AS order_month,
       CAST(date_trunc('week', o.order_date) AS DATE) AS order_week,
       COALESCE(o.promotion_id <> 0, TRUE) AS used_promotion,
       COALESCE(o.shipping_cost, 0) = 0 AS is_free_shipping,
       COALESCE(o.discount_percent, 0) >= 20 AS is_high_discount
FROM c_orders o
LEFT JOIN items_count i ON i.order_id = o.order_id
LEFT JOIN r_customers c ON c.customer_id = o.customer_id
LEFT JOIN r_promotions p ON p.promotion_id = o.promotion_id"""

CTES["e_inventory"] = """
SELECT i.*, p.product_name, p.category_id, p.brand_id,
       w.location, w.capacity_units, w.current_occupancy,
       COALESCE(i.quantity <= i.min_stock_level, FALSE) AS is_low_stock,
       COALESCE(i.quantity >= i.max_stock_level, FALSE) AS is_overstock
FROM c_inventory i
LEFT JOIN r_products p ON p.product_id = i.product_id
LEFT JOIN r_warehouses w ON w.warehouse_id = i.warehouse_id"""

CTES["e_reviews"] = """
SELECT r.*, p.product_name, p.category_id, p.brand_id,
       c.segment, c.city, c.country,
       CAST(date_trunc('month', r.created_at) AS DATE) AS review_month,
       CAST(length(COALESCE(r.comment, '')) AS BIGINT) AS comment_length,
       COALESCE(r.rating >= 4, FALSE) AS is_positive,
       COALESCE(r.rating <= 2, FALSE) AS is_negative
FROM c_reviews r
LEFT JOIN r_products p ON p.product_id = r.product_id
LEFT JOIN r_customers c ON c.customer_id = r.customer_id"""


def _refs(sql: str, names) -> list[str]:
    return [n for n in names if re.search(rf"\b{re.escape(n)}\b", sql)]


def with_ctes(final_sql: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``final_sql`` with every CTE it (transitively) references."""
    pool = dict(CTES)
    if extra:
        pool.update(extra)
    order: list[str] = []

    def visit(name: str, stack: tuple = ()):
        if name in order:
            return
        for dep in _refs(pool[name], [n for n in pool if n != name]):
            if dep not in stack:
                visit(dep, stack + (name,))
        order.append(name)

    for n in _refs(final_sql, pool):
        visit(n)
    if not order:
        return final_sql.strip()
    body = ",\n".join(f"{n} AS ({pool[n].strip()})" for n in order)
    return f"WITH {body}\n{final_sql.strip()}"
