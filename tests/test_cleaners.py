"""Null strategies, keep-last dedup, coercion, recalculation and the cleaners."""

from __future__ import annotations

import pytest

from basketry.errors import RuleViolation
from basketry.functions.derived import FILL_STRING_VALUE
from basketry.functions.coerce import coerce_columns, coercion_report
from basketry.operators.dedup import keep_last
from basketry.operators.nulls import NullStrategy, assert_fill_invariant, fill_nulls, fill_report
from basketry.plans.clean import clean_inventory, clean_orders, clean_reviews, recalc_total


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_fill_zero_and_mean(spark):
    df = spark.createDataFrame([(1.0, None), (None, 2.0), (3.0, 4.0)], "a double, b double")
    out = rows(fill_nulls(df, {"a": NullStrategy.FILL_ZERO, "b": NullStrategy.FILL_MEAN}))
    assert [r["a"] for r in out] == [1.0, 0.0, 3.0]
    assert [r["b"] for r in out] == [3.0, 2.0, 4.0]


def test_fill_median_mode_string_drop(spark):
    df = spark.createDataFrame([(1.0, "x", None, 1), (None, "y", "n", 2), (3.0, "y", None, None),
                                (10.0, None, None, 4)], "a double, b string, c string, d long")
    out = rows(fill_nulls(df, {"a": NullStrategy.FILL_MEDIAN, "b": NullStrategy.FILL_MODE,
                               "c": NullStrategy.FILL_STRING, "d": NullStrategy.DROP}))
    assert len(out) == 3                               # row with null d dropped
    assert out[1]["a"] == 3.0                          # median of 1, 3, 10
    assert [r["b"] for r in out] == ["x", "y", "y"]    # mode y fills the null
    assert {r["c"] for r in out} == {"Sin Especificar", "n"}


def test_mode_tie_takes_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "s string")
    assert [r["s"] for r in rows(fill_nulls(df, {"s": NullStrategy.FILL_MODE}))] == ["b", "a", "a"]


def test_fill_absent_column_is_noop(spark):
    df = spark.createDataFrame([(1,)], "a long")
    assert fill_nulls(df, {"zzz": NullStrategy.FILL_ZERO}) is df


def test_fill_mean_on_text_increases_nulls(spark):
    df = spark.createDataFrame([("abc",), (None,)], "a string")
    report = fill_report(df, {"a": NullStrategy.FILL_MEAN}).collect()
    with pytest.raises(RuleViolation, match="fill"):
        assert_fill_invariant(report)


def test_fill_mean_includes_duplicates(raw_orders):
    out = sorted(rows(clean_orders(raw_orders)), key=lambda r: r["order_id"])
    # means over all three rows: 50.0 (subtotal) and 45.0 (total); the later row of order 11 wins
    assert [(r["order_id"], r["subtotal"], r["total_amount"]) for r in out] == [(11, 60.0, 61.0), (12, 50.0, 29.0)]
    assert [(r["shipping_cost"], r["tax_amount"], r["discount_percent"]) for r in out] == [(1.0, 0.0, 5.0), (4.0, 0.0, 0.0)]
    assert [r["notes"] for r in out] == [FILL_STRING_VALUE] * 2
    assert [r["promotion_id"] for r in out] == [7, 0]
    assert out[1]["order_date"].day == 29


def test_key_nulls_raise(spark):
    df = spark.createDataFrame([(1, 10, "2024-01-01", 1), (None, 11, None, 2)],
                               "order_id long, customer_id long, order_date string, _seq long")
    with pytest.raises(RuleViolation, match="no_nulls"):
        clean_orders(df)


def test_recalc_total(raw_orders_without_totals):
    out = rows(recalc_total(raw_orders_without_totals))
    assert [r["total_amount"] for r in out] == [64.0, 99.0, None]


def test_recalc_inside_clean_when_all_totals_missing(raw_orders_without_totals):
    from pyspark.sql import functions as F
    df = raw_orders_without_totals.withColumn("total_amount", F.lit(None).cast("double"))
    out = sorted(rows(clean_orders(df)), key=lambda r: r["order_id"])
    # the missing subtotal is the mean of 80 and 10 first
    assert [r["total_amount"] for r in out] == [64.0, 10.5, 24.5]


def test_keep_last(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 3), (1, "d", 0)],
                               "k long, v string, _seq long")
    out = sorted((r["k"], r["v"]) for r in rows(keep_last(df, "k")))
    assert out == [(1, "b"), (2, "c")]


def test_keep_last_plan_limits_before_shuffle(spark):
    df = spark.createDataFrame([(1, "a", 1)], "k long, v string, _seq long")
    plan = keep_last(df, "k")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_coerce_numeric_and_dates(spark):
    df = spark.createDataFrame([("1.5", "2024-01-02 03:04:05"), ("n/a", "not a date"), (" 2e3 ", "2024-02-03"),
                                ("1d", None), ("-inf", "2024-13-01")], "x string, t string")
    out = rows(coerce_columns(df, numeric=["x"], dates=["t"]))
    assert [r["x"] for r in out] == [1.5, None, 2000.0, None, float("-inf")]
    assert [None if r["t"] is None else r["t"].isoformat() for r in out] == [
        "2024-01-02T03:04:05", None, "2024-02-03T00:00:00", None, None]
    rep = {r["column"]: r["coerced_to_null"] for r in rows(coercion_report(df, numeric=["x"], dates=["t"]))}
    assert rep == {"x": 2, "t": 2}


def test_id_cast_truncates_and_text_raises(spark):
    df = spark.createDataFrame([(1.9,)], "i double")
    assert rows(coerce_columns(df, ids=["i"]))[0]["i"] == 1
    bad = spark.createDataFrame([("abc",)], "i string")
    with pytest.raises(Exception):
        coerce_columns(bad, ids=["i"]).collect()


def test_orders_rules_reject_negative_amounts(spark):
    df = spark.createDataFrame([(1, 10, "2024-01-01", -5.0, 0.0, 0.0, 0.0, 10.0, 1)],
                               "order_id long, customer_id long, order_date string, subtotal double, "
                               "discount_percent double, shipping_cost double, tax_amount double, "
                               "total_amount double, _seq long")
    with pytest.raises(RuleViolation, match="range"):
        clean_orders(df)


def test_inventory_and_reviews_cleaners(spark):
    inv = spark.createDataFrame([(1, 10, 1, None, 10, 100, "2024-01-01", 1), (2, 20, 1, 50, None, 80, None, 2),
                                 (2, 20, 1, 60, 5, 80, None, 3)],
                                "inventory_id long, product_id long, warehouse_id long, quantity long, "
                                "min_stock_level long, max_stock_level long, last_restock_date string, _seq long")
    out = sorted(rows(clean_inventory(inv)), key=lambda r: r["inventory_id"])
    assert [(r["inventory_id"], r["quantity"], r["min_stock_level"]) for r in out] == [(1, 0, 10), (2, 60, 5)]
    rev = spark.createDataFrame([(1, 10, 101, 5, None, "2024-01-10", 1), (2, 11, 102, 3, 2, "2024-01-12", 2)],
                                "review_id long, product_id long, customer_id long, rating long, "
                                "helpful_votes long, created_at string, _seq long")
    assert [r["helpful_votes"] for r in rows(clean_reviews(rev))] == [0, 2]
    bad = spark.createDataFrame([(1, 10, 101, 7, 0, "2024-01-10", 1)],
                                "review_id long, product_id long, customer_id long, rating long, "
                                "helpful_votes long, created_at string, _seq long")
    with pytest.raises(RuleViolation, match="range"):
        clean_reviews(bad)


# (text, what pandas.to_numeric(errors="coerce") gives)
TO_NUMERIC_CASES = [
    ("1", 1.0), (" 2.5 ", 2.5), ("1e3", 1000.0), ("1E-2", 0.01), ("abc", None), ("n/a", None),
    ("inf", float("inf")), ("-inf", float("-inf")), ("Infinity", float("inf")), ("INF", float("inf")),
    ("NaN", None), ("1d", None), ("2f", None), (".5", 0.5), ("5.", 5.0), ("+3", 3.0), ("1,000", None),
    ("0x10", None), ("", None), ("1_000", None), ("1e", None), ("--1", None), ("12abc", None),
    ("9999999999999999999", 1e19), ("1.7976931348623157e309", None), ("\t4\n", 4.0), ("true", None),
]


def test_numeric_coercion_matches_pandas_to_numeric(spark):
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    from basketry.functions.coerce import numeric_expr
    df = spark.createDataFrame([(t,) for t, _ in TO_NUMERIC_CASES], "t string")
    got = [r[0] for r in df.select(numeric_expr(F.col("t"), T.StringType())).collect()]
    assert got == [w for _, w in TO_NUMERIC_CASES]


def _few_repeated(spark):
    """A hundred keys of one row each, and a few rows of repeated and of missing keys."""
    rows_ = [(k, k, f"v{k}") for k in range(100)] + [(7, 200, "later"), (None, 201, "x"), (None, 202, "y"), (9, -1, "earlier")]
    return spark.createDataFrame(rows_, "k long, _seq long, v string")


def test_keep_last_of_few_keeps_the_same_rows(spark):
    from basketry.operators.dedup import keep_last_of_few

    for df in (_few_repeated(spark), _few_repeated(spark).where("_seq between 0 and 99"), _few_repeated(spark).where("k is null"),
               _few_repeated(spark).where("k in (7, 9)"), _few_repeated(spark).where("false")):
        assert sorted(map(str, keep_last_of_few(df, "k").collect())) == sorted(map(str, keep_last(df, "k").collect()))


def test_keep_last_of_few_ranks_no_row_of_a_single_key(spark):
    from basketry.operators.dedup import keep_last_of_few

    def plan(df):
        return keep_last_of_few(df, "k")._jdf.queryExecution().executedPlan().toString()

    single = plan(_few_repeated(spark).where("_seq between 0 and 99"))
    assert "Sort" not in single and "Exchange" not in single
    assert "LeftAnti" in plan(_few_repeated(spark))
    assert "LeftAnti" not in plan(_few_repeated(spark).where("k is null"))


def test_cleaned_inventory_is_not_sorted(spark):
    from basketry.plans.clean import clean_inventory

    df = spark.createDataFrame([(1, 5, 6, 7, 1, 9, "2024-01-15", 0), (2, 5, 6, None, 1, 9, "2024-01-16 10:00:00", 1)],
                               "inventory_id long, product_id long, warehouse_id long, quantity long, min_stock_level long, max_stock_level long, "
                               "last_restock_date string, _seq long")
    out = clean_inventory(df, check=False)
    assert "Sort" not in out._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.inventory_id, r.quantity, str(r.last_restock_date)) for r in out.collect()) == [
        (1, 7, "2024-01-15 00:00:00"), (2, 0, "2024-01-16 10:00:00")]
