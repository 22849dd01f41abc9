"""The source's expressions try no cast that must fail, and a run writes no more than it has to."""

from __future__ import annotations

import glob

from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions.coerce import datetime_expr, numeric_expr
from basketry.plans.batch import export_sources
from basketry.sources import records as R
from basketry.sources.csv import read_csv, typed, whole


def test_casts_stand_behind_a_look_at_the_text(spark):
    df = spark.createDataFrame([("12.5",), ("12",), ("x",), ("1e309",), (" 7 ",), (None,), ("2f",), ("12\u0085",)], "t string")
    got = [tuple(r) for r in df.select(whole(F.col("t")), typed(F.col("t"), T.LongType()), numeric_expr(F.col("t"), T.StringType())).collect()]
    assert got == [(None, None, 12.5), (12, 12, 12.0), (None, None, None), (None, None, None), (7, 7, 7.0),
                   (None, None, None), (None, None, None), (None, None, None)]


def test_layouts_are_told_by_the_signs_in_the_text(spark):
    texts = ["2024-01-05", "2024-01-05 10:20:30", "2024-01-05T10:20:30", "2024-01-05 10:20:30.123456", "not a date", None]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    parsed = datetime_expr(F.col("t"), T.StringType())
    got = [r[0] for r in df.orderBy("k").select(parsed.cast("string")).collect()]
    assert got == ["2024-01-05 00:00:00", "2024-01-05 10:20:30", "2024-01-05 10:20:30", "2024-01-05 10:20:30.123456", None, None]
    assert "Contains" in df.select(parsed)._jdf.queryExecution().optimizedPlan().toString()


def _table(folder, *files):
    folder.mkdir()
    for k, text in enumerate(files):
        (folder / f"t_{k}.csv").write_text(text, encoding="utf-8", newline="")
    return str(folder)


def test_records_of_one_line_need_no_first_pass_in_python(spark, tmp_path):
    path = _table(tmp_path / "t", 'a,b\r\n1,"x,y"\r\n \r\n2,z\r\n', "\na,b\r\n3,\r\n")
    found = R.read_records(spark, path, numbered=False)
    assert "MapInArrow" not in found.rows._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["record"] for r in found.rows.collect()) == ['1,"x,y"', "2,z", "3,"] and found.names == ["a", "b"]
    rows = R.read_records(spark, path).rows.orderBy("_seq").collect()
    assert [(r["_seq"], r["record"]) for r in rows] == [(0, '1,"x,y"'), (1, "2,z"), (2, "3,")]


def test_other_tables_take_the_general_way(spark, tmp_path):
    texts = {"lines": ('a,b\n1,"x\ny"\n',), "again": ("a,b\n1,2\na,b\n",), "late": ("c,d\n1,2\na,b\n", "a,b\n")}
    paths = {n: _table(tmp_path / n, *t) for n, t in texts.items()}
    assert all(R.one_line_splits(spark, p, ",", "utf-8", True) is None for p in paths.values())
    assert [r["record"] for r in R.read_records(spark, paths["again"], numbered=False).rows.orderBy("_seq").collect()] == ["1,2", "a,b"]
    marked = R.read_records(spark, _table(tmp_path / "bom", "\ufeffa,b\n1,2\n"))
    assert marked.names == ["a", "b"] and [r["record"] for r in marked.rows.collect()] == ["1,2"]


def test_whole_numbers_of_any_shape(spark):
    texts = ["12", "+7", "007", " 8 ", "12.0", "1e3", "12.5", "abc", "12 euros", "-9223372036854775808", "1:2", None]
    got = [r[0] for r in spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").orderBy("k").select(typed(F.col("t"), T.LongType())).collect()]
    assert got == [12, 7, 7, 8, 12, 1000, None, None, None, -(2**63), None, None]


def test_first_pass_gives_one_row_for_a_batch_of_lines(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n" + "".join(f"{k},x\n" for k in range(500)))
    assert R._tagged(spark, str(tmp_path / "t.csv"), ",", "utf-8", True, with_text=False).count() < 10
    assert read_csv(spark, str(tmp_path / "t.csv"), infer_types=True).agg(F.sum("a")).first()[0] == 499 * 250


def test_a_compressed_raw_zone_keeps_the_arrival_order(spark, tmp_path):
    ordered = spark.createDataFrame([(k, f"v{k}", 100 - k) for k in range(100)], "order_id long, status string, _seq long")
    free = spark.range(100).select(F.col("id").alias("order_id"), (F.col("id") % 7).alias("product_id"))
    export_sources({"orders": ordered, "order_items": free}, str(tmp_path), compression="gzip")
    assert glob.glob(f"{tmp_path}/ecommerce_orders.csv/*.csv.gz")
    back = read_csv(spark, f"{tmp_path}/ecommerce_orders.csv").orderBy("_seq").collect()
    assert [int(r["order_id"]) for r in back] == list(range(99, -1, -1))
    items = read_csv(spark, f"{tmp_path}/ecommerce_order_items.csv", infer_types=True)
    assert sorted((r["order_id"], r["product_id"]) for r in items.collect()) == [(k, k % 7) for k in range(100)]
