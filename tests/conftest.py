from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

SF_SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="basketry-test-ckpt-")
    s = (SparkSession.builder.master("local[4]").appName("basketry-tests")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.checkpoint.dir", ckpt)
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir(ckpt)
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="basketry-test-")


def d(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def with_month(df, source, name):
    from pyspark.sql import functions as F
    return df.withColumn(name, F.trunc(source, "MM"))


# A small bakery: every table has a missing key, a missing amount or a tie.
@pytest.fixture
def paid_orders(spark):
    rows = [
        (7001, 40, d("2023-11-30"), 15.5, False, "mo@mail.test"),
        (7002, 41, d("2023-12-01"), 64.5, True, "ann@mail.test"),
        (7003, 40, d("2023-12-24"), 44.5, True, "mo@mail.test"),
        (7004, 42, d("2023-12-31"), 60.0, False, "li@mail.test"),
        (7005, 43, d("2024-02-29"), 5.0, True, "bo@mail.test"),
        (7006, 40, d("2024-02-29"), None, False, "mo@mail.test"),
        (7007, None, d("2024-02-01"), 10.0, False, None),
    ]
    return with_month(spark.createDataFrame(
        rows, "order_id long, customer_id long, order_date timestamp_ntz, total_amount double, "
              "used_promotion boolean, email string"), "order_date", "order_month")


@pytest.fixture
def basket_lines(spark):
    rows = [(7001, 501, 3, 9.0), (7001, 502, 1, 6.5), (7002, 503, 1, 64.5), (7003, 501, 10, 30.0),
            (7003, 504, 2, 14.5), (7004, 502, 4, 26.0), (7004, 505, None, 34.0), (7005, None, 9, 5.0)]
    return spark.createDataFrame(rows, "order_id long, product_id long, quantity long, subtotal double")


@pytest.fixture
def catalogue(spark):
    return spark.createDataFrame([(501, "roll"), (502, "pie"), (503, "cake"), (504, "bun")],
                                 "product_id long, product_name string")


@pytest.fixture
def stock(spark):
    rows = [
        (501, "roll", 8, "north", 3, 9, 40, True, False, 60),
        (502, "pie", 8, "north", 12, 4, 30, False, False, 60),
        (503, "cake", 9, "south", None, 1, 5, False, False, 0),
        (504, "bun", 9, "south", 90, 10, 50, False, True, 0),
        (501, "roll", 6, "east", 0, 2, 10, True, False, 25),
        (502, "pie", 6, "east", 4, 4, 10, False, False, 25),
    ]
    return spark.createDataFrame(rows, "product_id long, product_name string, warehouse_id long, location string, "
                                       "quantity long, min_stock_level long, max_stock_level long, "
                                       "is_low_stock boolean, is_overstock boolean, capacity_units long")


@pytest.fixture
def ratings(spark):
    rows = [
        (1, 501, "roll", 5, True, False, d("2023-12-30")), (2, 501, "roll", 2, False, True, d("2023-12-31")),
        (3, 501, "roll", 4, True, False, d("2024-01-01")), (4, 502, "pie", 4, True, False, d("2024-01-31")),
        (5, 502, "pie", 4, True, False, d("2024-02-01")), (6, 503, "cake", 1, False, True, d("2024-02-02")),
        (7, None, None, 3, False, False, d("2024-02-03")),
    ]
    return with_month(spark.createDataFrame(
        rows, "review_id long, product_id long, product_name string, rating long, is_positive boolean, "
              "is_negative boolean, created_at timestamp_ntz"), "created_at", "review_month")


@pytest.fixture
def order_states(spark):
    rows = [
        (1, "Shipped", d("2023-12-31"), 7.0), (2, "PENDING", d("2024-01-01"), 3.5),
        (3, "cancelled", d("2024-01-02"), 9.0), (4, None, d("2024-01-03"), 1.0),
        (5, "delivered", d("2024-01-04"), 2.0), (6, "Delivered", d("2024-01-05"), 2.0),
        (7, "processing", d("2024-01-06"), None), (8, "returned", d("2024-01-07"), 4.0),
    ]
    return with_month(spark.createDataFrame(
        rows, "order_id long, status string, order_date timestamp_ntz, total_amount double"), "order_date", "order_month")


@pytest.fixture
def raw_orders(spark):
    rows = [
        (11, 5, "2023-12-31", 40.0, None, None, 2.0, None, "gift", None, 1),
        (11, 5, "2023-12-31", 60.0, 5.0, 1.0, None, 61.0, None, 7, 2),
        (12, 6, "2024-02-29", None, None, 4.0, None, 29.0, None, None, 3),
    ]
    return spark.createDataFrame(rows, "order_id long, customer_id long, order_date string, subtotal double, "
                                       "discount_percent double, shipping_cost double, tax_amount double, "
                                       "total_amount double, notes string, promotion_id long, _seq long")


@pytest.fixture
def raw_orders_without_totals(spark):
    rows = [
        (21, 5, "2024-01-01", 80.0, 25.0, 3.0, 1.0, None, 1),
        (22, 5, "2024-01-02", 10.0, 0.0, 0.0, 0.5, 99.0, 2),
        (23, 6, "2024-01-03", None, 50.0, 2.0, 0.0, None, 3),
    ]
    return spark.createDataFrame(rows, "order_id long, customer_id long, order_date string, subtotal double, "
                                       "discount_percent double, shipping_cost double, tax_amount double, "
                                       "total_amount double, _seq long")


@pytest.fixture
def batch_tables(spark):
    def frame(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    return {
        "orders": frame("order_id long, customer_id long, order_date string, promotion_id long, subtotal double, "
                        "discount_percent double, shipping_cost double, tax_amount double, total_amount double, "
                        "status string, notes string, _seq long",
                        (31, 5, "2023-12-31", 7, 20.0, 10.0, 0.0, 1.0, 19.0, "Delivered", None, 1),
                        (32, 6, "2024-01-01", None, 8.0, None, 2.5, 0.5, None, "pending", "x", 2),
                        (33, 5, "2024-01-02", None, 5.0, 0.0, 0.0, 0.0, 5.0, "cancelled", None, 3)),
        "customers": frame("customer_id long, segment string, registration_date string, email string, city string, country string",
                           (5, "cafe", "2022-05-01", "five@mail.test", "Ulm", "DE"), (6, "home", "2023-01-31", None, "Lund", "SE")),
        "promotions": frame("promotion_id long, promotion_type string, discount_value double, is_active boolean, "
                            "start_date string, end_date string", (7, "early", 10.0, True, "2023-12-01", "2023-12-31")),
        "order_items": frame("order_id long, product_id long, quantity long, subtotal double",
                             (31, 501, 4, 12.0), (31, 502, 1, 8.0), (32, 502, 1, 8.0), (33, 501, 1, 5.0)),
        "products": frame("product_id long, product_name string, category_id long, brand_id long",
                          (501, "roll", 1, 1), (502, "pie", 2, 1)),
        "warehouses": frame("warehouse_id long, location string, capacity_units long, current_occupancy long", (8, "north", 60, 15)),
        "inventory": frame("inventory_id long, product_id long, warehouse_id long, quantity long, min_stock_level long, "
                           "max_stock_level long, last_restock_date timestamp_ntz, _seq long",
                           (1, 501, 8, 3, 9, 40, d("2024-01-01"), 1), (2, 502, 8, None, 4, 30, None, 2)),
        "reviews": frame("review_id long, product_id long, customer_id long, rating long, comment string, "
                         "helpful_votes long, created_at string, _seq long",
                         (1, 501, 5, 4, "crisp", None, "2024-01-10", 1), (2, 502, 6, 1, None, 3, "2024-02-12", 2)),
    }
