"""The batch run on literal tables: outputs, run metrics, and both check modes."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from basketry.errors import RuleViolation
from basketry.plans import publish
from basketry.plans.batch import export_sources, run_batch, run_batch_from_csv


@pytest.mark.parametrize("checks", ["deferred", "eager"])
def test_batch_writes_every_table(spark, tmp_dir, batch_tables, checks):
    out = os.path.join(tmp_dir, "out")
    m = {(r["stage"], r["table"]): r for r in run_batch(spark, batch_tables, out, checks=checks).collect()}
    assert m[("enrich", "orders_enriched")]["rows"] == 3
    assert m[("aggregate", "monthly_sales")]["rows"] == 2
    for zone in ("output/parquet", "output/csv"):
        assert len(os.listdir(os.path.join(publish.version(spark, out), zone))) == 16
    ms = {str(r["order_month"]): r["orders"] for r in publish.read_table(spark, out, "output/parquet/monthly_sales").collect()}
    assert ms == {"2023-12-01": 1, "2024-01-01": 2}
    rates = {n: publish.read_table(spark, out, f"output/parquet/{n}").first()[n]
             for n in ("cancellation_rate", "delivery_rate", "promotion_usage_rate")}
    assert rates == {n: pytest.approx(1 / 3) for n in rates}
    # files rows: one per written table, with a size
    assert any(k[0] == "files" and k[1] == "processed/parquet/orders_enriched" for k in m)
    assert not any("work" in k[1] for k in m if k[0] == "files")


def test_batch_raises_on_null_key(spark, tmp_dir, batch_tables):
    keyless = dict(batch_tables, orders=batch_tables["orders"].withColumn("order_id", F.nullif("order_id", F.lit(31))))
    with pytest.raises(RuleViolation, match="no_nulls"):
        run_batch(spark, keyless, os.path.join(tmp_dir, "out"))


def test_batch_observed_rule_check_raises(spark, tmp_dir, batch_tables):
    out = os.path.join(tmp_dir, "out")
    with pytest.raises(RuleViolation, match="range"):
        run_batch(spark, dict(batch_tables, orders=batch_tables["orders"].withColumn("subtotal", F.lit(-5.0))), out)
    # nothing of the failed run is published
    assert publish.version(spark, out) is None and os.listdir(f"{out}/_runs") == []


def test_run_from_csv_takes_the_layout(spark, tmp_dir, batch_tables):
    raw, out = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "out")
    export_sources(batch_tables, raw, files_per_table=1)
    run_batch_from_csv(spark, raw, out, multi_line=False, formats=("parquet",))
    assert publish.read_table(spark, out, "processed/parquet/orders_enriched").count() == 3
