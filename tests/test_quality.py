"""Fused data-quality rules (pass/raise, messages, counts, declared order)."""

from __future__ import annotations

import datetime as dt

import pytest

from basketry.errors import (
    RuleViolation,
)
from basketry.operators import quality as Q


@pytest.fixture
def valid(spark):
    rows = [(i, f"Product {c}", p, q, "cat", dt.datetime(2024, 1, i))
            for i, c, p, q in [(1, "A", 10.5, 100), (2, "B", 20.0, 50), (3, "C", 15.75, 75),
                               (4, "D", 30.0, 200), (5, "E", 12.25, 150)]]
    return spark.createDataFrame(rows, "id long, name string, price double, quantity long, "
                                       "category string, created_at timestamp_ntz")


def test_valid_table_passes_all_rules(valid):
    rules = [Q.required_columns(["id", "name", "price"]),
             Q.no_extra_columns(valid.columns),
             Q.data_types({"id": "int64", "name": "string", "price": "float", "created_at": "datetime"}),
             Q.numeric_range("price", 0, 100), Q.no_nulls(None), Q.unique(["id"])]
    assert Q.enforce(valid, rules) is valid


def test_required_columns_case_sensitive(valid):
    with pytest.raises(RuleViolation) as e:
        Q.enforce(valid, [Q.required_columns(["ID", "missing"])])
    assert e.value.rule == "required" and e.value.columns == ["ID", "missing"]


def test_extra_columns(valid):
    with pytest.raises(RuleViolation, match="no_extra"):
        Q.enforce(valid, [Q.no_extra_columns(["id", "name"])])


def test_types_collect_all_mismatches(spark):
    df = spark.createDataFrame([("1", "2.5", 3.0)], "id string, price string, quantity double")
    with pytest.raises(RuleViolation) as e:
        Q.enforce(df, [Q.data_types({"id": "int", "price": "float", "quantity": "int"})])
    assert e.value.rule == "types" and len(e.value.found) == 3


def test_range_bounds_inclusive_and_counts(spark):
    df = spark.createDataFrame([(0.0,), (100.0,), (None,)], "p double")
    Q.enforce(df, [Q.numeric_range("p", 0, 100)])
    bad = spark.createDataFrame([(-5.0,), (150.0,), (10.0,)], "p double")
    with pytest.raises(RuleViolation) as e:
        Q.enforce(bad, [Q.numeric_range("p", 0, 100)])
    assert e.value.rule == "range" and e.value.found == {"p": {"outside": 1, "low": -5.0, "high": 150.0}}


def test_range_disallowed_nulls(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "p double")
    with pytest.raises(RuleViolation) as e:
        Q.enforce(df, [Q.numeric_range("p", 0, allow_nulls=False)])
    assert e.value.found == {"p": (1, 50.0)}


def test_range_all_null_passes(spark):
    df = spark.createDataFrame([(None,)], "p double")
    Q.enforce(df, [Q.numeric_range("p", 0, 1)])


def test_no_nulls_all_columns_when_empty_list(spark):
    df = spark.createDataFrame([(1, None), (None, "x")], "a long, b string")
    with pytest.raises(RuleViolation) as e:
        Q.enforce(df, [Q.no_nulls([])])
    assert len(e.value.found) == 2


def test_unique_counts_per_column(spark):
    df = spark.createDataFrame([(1, "A"), (2, "B"), (2, "C"), (3, "B"), (None, None), (None, "D")],
                               "id long, name string")
    with pytest.raises(RuleViolation) as e:
        Q.enforce(df, [Q.unique(["id", "name"])])
    # id: one extra 2, one extra NULL; name: one extra B
    assert e.value.rule == "unique" and e.value.found == {"id": 2, "name": 1}


def test_first_failing_rule_in_declared_order(spark):
    df = spark.createDataFrame([(-1.0, None)], "p double, q string")
    with pytest.raises(RuleViolation, match="no_nulls"):
        Q.enforce(df, [Q.no_nulls(["q"]), Q.numeric_range("p", 0)])
    with pytest.raises(RuleViolation, match="range"):
        Q.enforce(df, [Q.numeric_range("p", 0), Q.no_nulls(["q"])])


def test_violations_rows(spark):
    df = spark.createDataFrame([(-1.0,), (5.0,), (None,)], "p double")
    assert Q.violations(df, Q.numeric_range("p", 0)).count() == 1
    assert Q.violations(df, Q.no_nulls(["p"])).count() == 1


def test_one_job_for_all_data_rules(spark, valid):
    m = Q.rule_metrics(valid, [Q.numeric_range("price", 0, 100), Q.no_nulls(None), Q.unique(["id", "name"])])
    r = m.collect()
    assert len(r) == 1 and r[0]["rows"] == 5 and r[0]["id__dups"] == 0
