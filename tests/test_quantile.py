"""Exact distributed quantile against numpy on skewed and tie-heavy data."""

from __future__ import annotations

import numpy as np
import pytest

from basketry.operators.quantile import exact_quantile


@pytest.mark.parametrize("p", [0.0, 0.1, 0.5, 0.8, 0.999, 1.0])
def test_matches_linear_interpolation(spark, p):
    rng = np.random.default_rng(7)
    vals = np.concatenate([rng.lognormal(3, 2, 4000), np.full(3000, 42.0),   # a third of rows on one value
                           rng.integers(0, 5, 2000).astype(float)])
    df = spark.createDataFrame([(float(v),) for v in vals] + [(None,)], "v double")
    got = exact_quantile(df, "v", p, accuracy=500).collect()[0][0]
    assert got == pytest.approx(float(np.quantile(vals, p)), rel=1e-12)


def test_empty_is_null(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert exact_quantile(df, "v", 0.5).collect()[0][0] is None


def test_single_value_and_materialize(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert exact_quantile(df, "v", 0.8, materialize=True).collect()[0][0] == 3.0


def test_no_python_in_plan(spark):
    df = spark.createDataFrame([(1.0,)], "v double")
    plan = exact_quantile(df, "v", 0.5)._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "PythonUDF" not in plan
