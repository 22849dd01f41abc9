"""Property tests: operators vs brute-force pandas on random small frames.

The source system's semantics are pandas'; these compare each operator with
the pandas expression it re-expresses, on generated data that includes
NULLs, ties and a hot key holding a large share of the rows.
"""

from __future__ import annotations

import math

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from basketry.operators.dedup import keep_last
from basketry.operators.metrics import monthly_sales, recurring_customers
from basketry.operators.nulls import NullStrategy, fill_nulls
from basketry.operators.quality import duplicate_counts
from basketry.operators.quantile import exact_quantile

SETTINGS = dict(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

keys = st.one_of(st.just(7), st.integers(0, 20))            # 7 is a hot key
amounts = st.one_of(st.none(), st.floats(0, 1000, allow_nan=False).map(lambda x: round(x, 2)))
labels = st.one_of(st.none(), st.sampled_from(["a", "b", "c", "d"]))
rows_st = st.lists(st.tuples(keys, amounts, labels), min_size=1, max_size=40)


def _frame(spark, rows):
    data = [(k, a, lab, i) for i, (k, a, lab) in enumerate(rows)]
    return spark.createDataFrame(data, "k long, a double, s string, _seq long"), \
        pd.DataFrame(data, columns=["k", "a", "s", "_seq"])


def _same(x, y):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return y is None or (isinstance(y, float) and math.isnan(y))
    if isinstance(x, float):
        return math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9)
    return x == y


@settings(**SETTINGS)
@given(rows=rows_st)
def test_keep_last_matches_drop_duplicates(spark, rows):
    sdf, pdf = _frame(spark, rows)
    got = sorted((r["k"], r["_seq"]) for r in keep_last(sdf, "k").collect())
    want = sorted(pdf.drop_duplicates(subset=["k"], keep="last")[["k", "_seq"]].itertuples(index=False))
    assert got == [tuple(w) for w in want]


@settings(**SETTINGS)
@given(rows=rows_st, how=st.sampled_from(["mean", "median", "mode"]))
def test_fills_match_pandas(spark, rows, how):
    sdf, pdf = _frame(spark, rows)
    col = "s" if how == "mode" else "a"
    strategy = {"mean": NullStrategy.FILL_MEAN, "median": NullStrategy.FILL_MEDIAN,
                "mode": NullStrategy.FILL_MODE}[how]
    got = [r[col] for r in fill_nulls(sdf, {col: strategy}).orderBy("_seq").collect()]
    series = pdf[col]
    if how == "mean":
        fill = series.mean()
    elif how == "median":
        fill = series.median()
    else:
        modes = series.mode()
        fill = modes.iloc[0] if not modes.empty else None
    want = series.where(series.notna(), fill).tolist()
    assert all(_same(g, w) for g, w in zip(got, want)), (got, want)


@settings(**SETTINGS)
@given(rows=rows_st)
def test_duplicate_counts_match_duplicated(spark, rows):
    sdf, pdf = _frame(spark, rows)
    got = duplicate_counts(sdf, ["k", "a", "s"]).collect()[0].asDict()
    for c in ("k", "a", "s"):
        assert got[f"{c}__dups"] == int(pdf[c].duplicated().sum()), c


@settings(max_examples=40, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=rows_st, p=st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.8, 0.99, 1.0]))
def test_exact_quantile_matches_pandas(spark, rows, p):
    sdf, pdf = _frame(spark, rows)
    got = exact_quantile(sdf, "a", p, accuracy=100).collect()[0][0]
    want = pdf["a"].quantile(p)
    assert _same(got, None if pd.isna(want) else float(want))


@settings(**SETTINGS)
@given(rows=rows_st)
def test_groupby_metrics_match_pandas(spark, rows):
    sdf, pdf = _frame(spark, rows)
    eo = (sdf.withColumnRenamed("k", "customer_id").withColumnRenamed("_seq", "order_id")
          .withColumnRenamed("a", "total_amount").withColumnRenamed("s", "email"))
    got = {(r["customer_id"], r["total_orders"]) for r in recurring_customers(eo, 2).collect()}
    counts = pdf.groupby("k")["_seq"].count()
    assert got == {(int(k), int(v)) for k, v in counts[counts >= 2].items()}
    # monthly revenue: sum per month (NULL amounts skipped, all-NULL month 0), order count
    eo_m = sdf.selectExpr("k", "cast(date_add(date'2024-01-01', cast(k as int) * 31) as date) as order_month",
                          "a as total_amount", "_seq as order_id")
    month_of = {r["k"]: r["order_month"] for r in eo_m.select("k", "order_month").distinct().collect()}
    got_m = {(r["order_month"], r["orders"]): r["total_revenue"] for r in monthly_sales(eo_m).collect()}
    want = pdf.groupby("k").agg(total=("a", "sum"), n=("_seq", "count"))
    want_m = {(month_of[k], int(r["n"])): float(r["total"]) for k, r in want.iterrows()}
    assert got_m.keys() == want_m.keys()
    assert all(math.isclose(got_m[k], want_m[k], rel_tol=1e-12, abs_tol=1e-9) for k in got_m)


def test_top_spenders_has_no_exact_percentile_buffer(spark, paid_orders):
    from basketry.operators.metrics import top_spenders
    plan = top_spenders(paid_orders)._jdf.queryExecution().executedPlan().toString()
    assert "percentile(" not in plan.lower().replace("percentile_approx", "")


def test_keep_last_hot_key_plan(spark):
    rows = [(1 if i % 3 == 0 else i, i) for i in range(300)]        # a third on key 1
    df = spark.createDataFrame(rows, "k long, _seq long")
    out = keep_last(df, "k")
    assert out.where("k = 1").collect()[0]["_seq"] == 297
    plan = out._jdf.queryExecution().executedPlan().toString()
    # a Partial WindowGroupLimit sits below (after, in the printed tree) the shuffle
    exchange = plan.index("Exchange hashpartitioning(k")
    partial = [i for i, line in enumerate(plan.splitlines()) if "WindowGroupLimit" in line and "Partial" in line]
    assert partial and sum(len(x) + 1 for x in plan.splitlines()[:partial[0]]) > exchange


@pytest.mark.parametrize("hot_share", [0.34, 0.9])
def test_uniqueness_check_on_hot_value(spark, hot_share):
    n = 300
    hot = int(n * hot_share)
    df = spark.createDataFrame([(0 if i < hot else i,) for i in range(n)], "k long")
    assert duplicate_counts(df, ["k"]).collect()[0]["k__dups"] == hot - 1
