"""Driver contract: entry, every registered query vs its DuckDB oracle, plan shape."""

from __future__ import annotations

import datetime as dt
import decimal
import functools
import math
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as E
from basketry.plans import catalog, oracle
from tests.conftest import SF_SMOKE

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, dt.datetime) and v.tzinfo is not None:
        return v.replace(tzinfo=None)
    return v


def _key(row):
    return tuple((0, "") if v is None else (1, type(v).__name__, v) for v in row)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMOKE}/{t}.parquet')")
    return con


@pytest.fixture(scope="module", autouse=True)
def one_batch_run():
    """The queries that read a batch run's tables share one run here; outside the tests each makes its own."""
    own = catalog.batch_output_dir
    catalog.batch_output_dir = functools.lru_cache(own)
    yield
    catalog.batch_output_dir = own


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["order_month", "total_revenue", "orders"]


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(oracle.oracle_sql())
    assert set(catalog.queries()) <= set(E.queries())


def test_entry_without_the_corpus_part():
    """The entry module works where the corpus operators and their pipeline are absent."""
    code = ("import sys; sys.modules['corpus_pipeline'] = None; sys.modules['basketry.llm'] = None; import __spark_entry__ as E; "
            "assert E.queries().keys() == E.oracle_sql().keys() and 'pipeline' not in E.queries()")
    root = os.path.dirname(os.path.abspath(E.__file__))
    assert subprocess.run([sys.executable, "-c", code], cwd=root).returncode == 0


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_oracle(spark, duck, name):
    sdf = catalog.queries()[name](spark, SF_SMOKE)
    cols = sdf.columns
    srows = [tuple(_norm(v) for v in r) for r in sdf.collect()]
    cur = duck.execute(oracle.oracle_sql()[name])
    dcols = [c[0] for c in cur.description]
    drows = [tuple(_norm(v) for v in r) for r in cur.fetchall()]
    assert sorted(cols) == sorted(dcols)
    order = sorted(cols)
    s = sorted((tuple(r[cols.index(c)] for c in order) for r in srows), key=_key)
    d = sorted((tuple(r[dcols.index(c)] for c in order) for r in drows), key=_key)
    assert len(s) == len(d)
    assert s == d


@pytest.mark.parametrize("name", sorted(n for n in catalog.queries() if n not in catalog.BATCH_OUTPUTS))
def test_no_python_udf_in_plans(spark, name):
    plan = catalog.queries()[name](spark, SF_SMOKE)._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "PythonUDF" not in plan


def test_top_n_plans_use_take_ordered(spark):
    for name in ("top_spenders", "top_products_by_quantity", "low_stock_items", "reviews_by_product"):
        plan = catalog.queries()[name](spark, SF_SMOKE)._jdf.queryExecution().executedPlan().toString()
        assert "TakeOrderedAndProject" in plan, name


def test_parquet_scans_are_pruned(spark):
    import re
    q = catalog.queries()["reviews_monthly"](spark, SF_SMOKE)
    plan = q._jdf.queryExecution().executedPlan().toString()
    schemas = [m for m in re.findall(r"ReadSchema: struct<([^>]*)>", plan) if "review_id" in m]
    assert schemas, plan
    # the monthly volume never needs the review text or the vote counts
    assert all("comment:" not in m and "helpful_votes:" not in m for m in schemas), schemas


@pytest.mark.parametrize("name", ["monthly_sales", "coerce_datetime", "csv_roundtrip", "reviews_monthly"])
def test_results_do_not_depend_on_session_time_zone(spark, duck, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        test_query_matches_oracle(spark, duck, name)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
