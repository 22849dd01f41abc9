"""Enrichers: joins and derived columns."""

from __future__ import annotations

import datetime as dt

import pytest

from basketry.errors import RuleViolation
from basketry.plans.enrich import enrich_inventory, enrich_orders, enrich_reviews
from basketry.sources.sinks import csv_text_columns


def rows(df):
    return [r.asDict() for r in df.collect()]


@pytest.fixture
def orders_inputs(spark):
    orders = spark.createDataFrame(
        [(1, 10, dt.datetime(2024, 1, 14), 100, 100.0, 10.0, 0.0, 19.0, 109.0, "delivered")],
        "order_id long, customer_id long, order_date timestamp_ntz, promotion_id long, subtotal double, "
        "discount_percent double, shipping_cost double, tax_amount double, total_amount double, status string")
    customers = spark.createDataFrame(
        [(10, "vip", "2023-12-01", "vip@example.com", "CityA", "CountryA")],
        "customer_id long, segment string, registration_date string, email string, city string, country string")
    promotions = spark.createDataFrame(
        [(100, "coupon", 10.0, True, "2024-01-01", "2024-02-01")],
        "promotion_id long, promotion_type string, discount_value double, is_active boolean, "
        "start_date string, end_date string")
    items = spark.createDataFrame([(1, 10, 1, 40.0, 40.0), (1, 11, 2, 30.0, 60.0)],
                                  "order_id long, product_id long, quantity long, unit_price double, subtotal double")
    return orders, customers, promotions, items


def test_enrich_orders(orders_inputs):
    out = rows(enrich_orders(*orders_inputs))[0]
    assert out["segment"] == "vip" and out["promotion_type"] == "coupon"
    assert out["items_count"] == 3
    assert out["avg_item_price"] == pytest.approx(109.0 / 3)
    assert str(out["order_month"]) == "2024-01-01"
    assert str(out["order_week"]) == "2024-01-08"          # Sunday 14th -> week of Monday 8th
    assert out["used_promotion"] is True and out["is_free_shipping"] is True
    assert out["is_high_discount"] is False
    assert out["registration_date"] == dt.datetime(2023, 12, 1)


def test_enrich_orders_period_text(orders_inputs):
    out = rows(csv_text_columns(enrich_orders(*orders_inputs)))[0]
    assert out["order_month"] == "2024-01"
    assert out["order_week"] == "2024-01-08/2024-01-14"
    assert out["used_promotion"] == "True"


def test_enrich_orders_missing_items_price_zero(orders_inputs):
    orders, customers, promotions, items = orders_inputs
    out = rows(enrich_orders(orders, customers, promotions, items.limit(0)))[0]
    assert out["items_count"] is None and out["avg_item_price"] == 0.0


def test_enrich_orders_duplicate_customer_rejected(spark, orders_inputs):
    orders, customers, promotions, items = orders_inputs
    with pytest.raises(Exception) as e:
        enrich_orders(orders, customers.unionByName(customers), promotions, items)
    assert e.value.rule == "unique"


def test_enrich_inventory(spark):
    inv = spark.createDataFrame([(1, 10, 1, 50, 10, 100, dt.datetime(2024, 1, 1))],
                                "inventory_id long, product_id long, warehouse_id long, quantity long, "
                                "min_stock_level long, max_stock_level long, last_restock_date timestamp_ntz")
    products = spark.createDataFrame([(10, "Gadget", 1000, 2000)],
                                     "product_id long, product_name string, category_id long, brand_id long")
    wh = spark.createDataFrame([(1, "LocationA", 500, 250)],
                               "warehouse_id long, location string, capacity_units long, current_occupancy long")
    out = rows(enrich_inventory(inv, products, wh))[0]
    assert out["product_name"] == "Gadget" and out["location"] == "LocationA"
    assert out["is_low_stock"] is False and out["is_overstock"] is False
    # null quantity compares False; a row may be both when min >= max
    inv2 = spark.createDataFrame([(2, 10, 1, None, 5, 3), (3, 10, 1, 4, 5, 3)],
                                 "inventory_id long, product_id long, warehouse_id long, quantity long, "
                                 "min_stock_level long, max_stock_level long")
    flags = [(r["is_low_stock"], r["is_overstock"]) for r in rows(enrich_inventory(inv2, products, wh))]
    assert flags == [(False, False), (True, True)]


def test_enrich_inventory_requires_location(spark):
    inv = spark.createDataFrame([(1, 10, 1, 50, 10, 100)], "inventory_id long, product_id long, "
                                "warehouse_id long, quantity long, min_stock_level long, max_stock_level long")
    products = spark.createDataFrame([(10, "Gadget", 1, 2)],
                                     "product_id long, product_name string, category_id long, brand_id long")
    wh = spark.createDataFrame([(1, None, 500, 250)],
                               "warehouse_id long, location string, capacity_units long, current_occupancy long")
    with pytest.raises(RuleViolation, match="no_nulls"):
        enrich_inventory(inv, products, wh)


def test_enrich_reviews(spark):
    rev = spark.createDataFrame(
        [(1, 10, 101, 5, dt.datetime(2024, 1, 10), "great", 3), (2, 11, 102, 2, dt.datetime(2024, 1, 12), "bad", 1)],
        "review_id long, product_id long, customer_id long, rating long, created_at timestamp_ntz, "
        "comment string, helpful_votes long")
    products = spark.createDataFrame([(10, "Gadget", 1000, 2000), (11, "Widget", 1001, 2001)],
                                     "product_id long, product_name string, category_id long, brand_id long")
    customers = spark.createDataFrame([(101, "vip", "X", "AR"), (102, "standard", "Y", "BR")],
                                      "customer_id long, segment string, city string, country string")
    out = rows(enrich_reviews(rev, products, customers))
    assert [r["comment_length"] for r in out] == [5, 3]
    assert [(r["is_positive"], r["is_negative"]) for r in out] == [(True, False), (False, True)]
    assert out[0]["segment"] == "vip" and str(out[0]["review_month"]) == "2024-01-01"
    with pytest.raises(RuleViolation, match="required"):
        enrich_reviews(rev, products, customers.drop("city"))
