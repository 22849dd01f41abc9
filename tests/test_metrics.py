"""Business metrics on literal fixtures."""

from __future__ import annotations

import math

import pytest

from basketry.operators import metrics as M


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_average_ticket(paid_orders):
    # 199.5 over the six known amounts
    assert rows(M.average_ticket(paid_orders)) == [{"average_ticket": 33.25}]


def test_average_ticket_empty_is_zero(paid_orders):
    assert rows(M.average_ticket(paid_orders.limit(0)))[0]["average_ticket"] == 0.0


def test_promotion_usage_rate(paid_orders):
    assert rows(M.promotion_usage_rate(paid_orders))[0]["promotion_usage_rate"] == pytest.approx(3 / 7)


def test_top_spenders_at_the_threshold(paid_orders):
    out = rows(M.top_spenders(paid_orders, top_n=5, percentile=0.5))
    # spends 5, 60, 60, 64.5: the median is 60, both sixties stay, ids break the tie
    assert [(r["customer_id"], r["total_spent"]) for r in out] == [(41, 64.5), (40, 60.0), (42, 60.0)]
    mo = out[1]
    assert (mo["total_orders"], mo["avg_ticket"], mo["email"]) == (3, 20.0, "mo@mail.test")


def test_top_spenders_without_percentile(paid_orders):
    assert [r["customer_id"] for r in rows(M.top_spenders(paid_orders, top_n=2, percentile=None))] == [41, 40]


def test_recurring_customers(paid_orders):
    out = rows(M.recurring_customers(paid_orders, min_orders=2))
    assert [(r["customer_id"], r["total_orders"]) for r in out] == [(40, 3)]


def test_monthly_sales(paid_orders):
    out = rows(M.monthly_sales(paid_orders))
    assert [(str(r["order_month"]), r["total_revenue"], r["orders"]) for r in out] == [
        ("2023-11-01", 15.5, 1), ("2023-12-01", 169.0, 3), ("2024-02-01", 15.0, 3)]


def test_top_products(basket_lines, catalogue):
    q = rows(M.top_products_by_quantity(basket_lines, catalogue, top_n=10))
    assert [(r["product_id"], r["total_units"], r["product_name"]) for r in q] == [
        (501, 13, "roll"), (502, 5, "pie"), (504, 2, "bun"), (503, 1, "cake"), (505, None, None)]
    r = rows(M.top_products_by_revenue(basket_lines, catalogue, top_n=3))
    assert [(x["product_id"], x["revenue"]) for x in r] == [(503, 64.5), (501, 39.0), (505, 34.0)]
    assert list(r[0].keys()) == ["product_id", "revenue", "total_units", "product_name"]


def test_top_products_name_fanout_is_exact(spark, basket_lines):
    # a product id listed twice in the catalogue: both rows appear, as a join-then-rank would give
    cat = spark.createDataFrame([(501, "roll"), (501, "old roll"), (502, "pie")], "product_id long, product_name string")
    q = rows(M.top_products_by_quantity(basket_lines, cat, top_n=2))
    assert [(r["product_id"], r["product_name"]) for r in q] == [(501, "old roll"), (501, "roll")]


def test_lifecycle_rates(order_states):
    assert rows(M.cancellation_rate(order_states))[0]["cancellation_rate"] == pytest.approx(1 / 8)
    assert rows(M.delivery_rate(order_states))[0]["delivery_rate"] == pytest.approx(2 / 8)


def test_backlog(order_states):
    out = rows(M.in_progress_backlog(order_states))
    assert [(str(r["order_month"]), r["backlog_orders"], r["backlog_value"]) for r in out] == [
        ("2023-12-01", 1, 7.0), ("2024-01-01", 2, 3.5)]


def test_status_funnel_null_status_excluded(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, "b")], "order_id long, status string")
    out = rows(M.status_funnel(df))
    assert out == [{"status": "a", "orders": 2, "share": 2 / 3}, {"status": "b", "orders": 1, "share": 1 / 3}]
    # the null stays in the cancellation denominator
    assert rows(M.cancellation_rate(df))[0]["cancellation_rate"] == 0.0


def test_stock_health(stock):
    out = {r["metric"]: (r["value"], r["pct"]) for r in rows(M.stock_health_summary(stock))}
    assert out == {"total_items": (6, 1.0), "low_stock": (2, 2 / 6), "overstock": (1, 1 / 6)}


def test_low_stock_items(stock):
    out = rows(M.low_stock_items(stock, top_n=20))
    assert [(r["product_id"], r["warehouse_id"], r["stock_gap"]) for r in out] == [(501, 8, 6), (501, 6, 2)]


def test_warehouse_utilization(stock):
    out = rows(M.warehouse_utilization(stock))
    assert [(r["warehouse_id"], r["utilization"]) for r in out] == [(6, 0.16), (8, 0.25), (9, None)]


def test_warehouse_zero_capacity_is_null(spark):
    df = spark.createDataFrame([(1, "A", 5, 0)], "warehouse_id long, location string, quantity long, capacity_units long")
    assert rows(M.warehouse_utilization(df))[0]["utilization"] is None


def test_rating_overview(ratings):
    r = rows(M.rating_overview(ratings))[0]
    assert r["average_rating"] == pytest.approx(23 / 7)
    assert r["positive_rate"] == pytest.approx(4 / 7) and r["negative_rate"] == pytest.approx(2 / 7)
    assert r["review_count"] == 7


def test_rating_by_product(ratings):
    out = rows(M.rating_by_product(ratings, min_reviews=2, top_n=20))
    assert [(r["product_id"], r["average_rating"], r["review_count"]) for r in out] == [
        (502, 4.0, 2), (501, pytest.approx(11 / 3), 3)]


def test_monthly_review_volume(ratings):
    assert [(str(r["review_month"]), r["volume"]) for r in rows(M.monthly_review_volume(ratings))] == [
        ("2023-12-01", 2), ("2024-01-01", 2), ("2024-02-01", 3)]


def test_empty_rates_are_null(order_states):
    r = rows(M.cancellation_rate(order_states.limit(0)))[0]["cancellation_rate"]
    assert r is None or math.isnan(r)


def test_text_attributes_take_no_sort_of_the_rows(spark):
    """The least email, location and name of a group are found without sorting all rows for a text in the aggregate."""
    orders = spark.createDataFrame([(1, 1, "b@x", 10.0), (2, 1, "a@x", 5.0), (3, 2, None, 1.0), (4, 1, None, 1.0), (5, None, "c@x", 2.0)],
                                   "order_id long, customer_id long, email string, total_amount double").selectExpr("*", "timestamp_ntz'2024-01-01' as order_date")
    stock = spark.createDataFrame([(1, 10, "S", 3), (1, 10, "N", 4), (1, 20, None, 5), (2, 10, None, 6), (2, 10, None, None)],
                                  "warehouse_id long, capacity_units long, location string, quantity long")
    rated = spark.createDataFrame([(1, 1, "p", 5), (2, 1, "o", 3), (3, 2, None, 1)], "review_id long, product_id long, product_name string, rating long") \
        .selectExpr("*", "rating >= 4 as is_positive")

    assert [(r.customer_id, r.total_orders, r.email) for r in M.recurring_customers(orders, 1).collect()] == [(1, 3, "a@x"), (2, 1, None)]
    assert [(r.customer_id, r.total_orders, r.email) for r in M.top_spenders(orders, 5, None).collect()] == [(1, 3, "a@x"), (2, 1, None)]
    assert [(r.warehouse_id, r.location, r.total_units, r.capacity_units) for r in M.warehouse_utilization(stock).collect()] == [
        (1, "N", 12, 20), (2, None, 6, 10), (1, "N", 12, 10)]
    assert [(r.product_id, r.product_name, r.review_count) for r in M.rating_by_product(rated, 1).collect()] == [(1, "o", 2), (2, None, 1)]
    for df, whole in ((M.recurring_customers(orders, 1), "partial_count(order_id"), (M.warehouse_utilization(stock), "partial_sum(quantity")):
        plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
        assert any("HashAggregate" in line and whole in line for line in plan) and not any("SortAggregate" in line and whole in line for line in plan)
