"""What must not change or vanish on the way: text, digits, rows, files and written tables."""

import math
import os

import pytest
from pyspark.sql import functions as F

from basketry.errors import RuleViolation, SourceError
from basketry.functions.semantics import money_mean, money_sum
from basketry.operators import metrics as M
from basketry.operators import quality as Q
from basketry.operators.dedup import keep_last
from basketry.operators.nulls import NullStrategy, fill_nulls, fill_report
from basketry.operators.quantile import exact_quantile
from basketry.plans import publish
from basketry.plans.batch import run_batch
from basketry.plans.clean import clean_inventory, clean_orders, clean_reviews
from basketry.schemas import COERCED, SCHEMAS
from basketry.session import ensure_checkpoint_dir
from basketry.sources.csv import ingest_csv, read_csv
from basketry.sources.sinks import write_csv


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(str(folder), name)
    with open(path, "w") as f:
        f.write(text)
    return path


def test_dirty_numbers_survive_the_fill(spark, tmp_path):
    inventory = put(tmp_path, "i.csv", "inventory_id,product_id,warehouse_id,quantity,min_stock_level,max_stock_level,last_restock_date\n"
                    "1,1,1,3.5,2,9,2024-01-01\n2,1,1,abc,2,9,2024-01-01\n3,1,1,,2,9,2024-01-01\n4,1,1,7,2,9,2024-01-01\n")
    for read in (lambda: read_csv(spark, inventory, SCHEMAS["inventory"], coerced=COERCED["inventory"]),
                 lambda: ingest_csv(spark, inventory, str(tmp_path / "raw"), SCHEMAS["inventory"], coerced=COERCED["inventory"])):
        got = {r.inventory_id: r.quantity for r in clean_inventory(read()).collect()}
        assert got == {1: 3.5, 2: None, 3: 0.0, 4: 7.0}
    reviews = put(tmp_path, "r.csv", "review_id,product_id,customer_id,rating,comment,helpful_votes,created_at\n"
                  "1,1,1,4.5,x,,2024-01-01\n2,1,1,bad,x,2,2024-01-02\n")
    got = {r.review_id: (r.rating, r.helpful_votes) for r in clean_reviews(read_csv(spark, reviews, SCHEMAS["reviews"], coerced=COERCED["reviews"])).collect()}
    assert got == {1: (4.5, 0), 2: (None, 2)}
    head = "order_id,customer_id,order_date,promotion_id,subtotal,discount_percent,shipping_cost,tax_amount,total_amount,status,notes\n"
    orders = put(tmp_path, "o.csv", head + "1,1,2024-01-01,,10,abc,1,1,12,a,\n2,1,2024-01-01,3,10,,1,1,12,a,b\n")
    got = {r.order_id: r.discount_percent for r in clean_orders(read_csv(spark, orders, SCHEMAS["orders"], coerced=COERCED["orders"])).collect()}
    assert got == {1: None, 2: 0.0}


def test_whole_columns_keep_their_types(spark, tmp_path):
    path = put(tmp_path, "i.csv", "inventory_id,quantity\n1,3\n2,\n")
    assert dict(read_csv(spark, path, SCHEMAS["inventory"], coerced=("quantity",)).dtypes)["quantity"] == "bigint"


@pytest.mark.parametrize("row", ["4,5,6,,LOST", "7,8,9,", '1,"a,b",3,""', "1,2,3,4,5,6"])
@pytest.mark.parametrize("multi_line", [True, False])
def test_long_rows_never_pass(spark, tmp_path, row, multi_line):
    path = put(tmp_path, "x.csv", f'a,b,c\n1,2,3\n{row}\n"x,y",5\n')
    with pytest.raises(SourceError, match="1 rows have more"):
        read_csv(spark, path, multi_line=multi_line)
    kept, long_rows = read_csv(spark, path, malformed="quarantine", with_seq=False, multi_line=multi_line)
    assert kept.count() == 2 and long_rows.count() == 1
    assert [r.a for r in kept.where("b = '5'").collect()] == ["x,y"]


def test_another_column_order_is_refused(spark, tmp_path):
    put(tmp_path / "d", "a.csv", "id,qty,price\n1,2,3\n")
    put(tmp_path / "d", "b.csv", "id,price,qty\n1,2,3\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(tmp_path / "d")).collect()


def test_later_files_win_by_number(spark, tmp_path):
    for k in (9, 10):
        put(tmp_path / "d", f"orders_{k}.csv", f"id,v\n1,{k}\n")
    assert keep_last(read_csv(spark, str(tmp_path / "d")), "id").first().v == "10"


def test_csv_keeps_text_and_digits(spark, tmp_path):
    values = [0.0003333333333333333, 1e-7, 123456789.123456, 1e22, -0.1, 5e-324, 1 / 3, 0.0, math.inf]
    df = spark.createDataFrame([(k, "  x  ", v) for k, v in enumerate(values)], "id long, s string, v double")
    write_csv(df, str(tmp_path / "o"))
    got = sorted(read_csv(spark, str(tmp_path / "o"), df.schema, with_seq=False).collect())
    assert [r.v for r in got] == values and {r.s for r in got} == {"  x  "}


def test_sums_cut_nothing(spark):
    def one(values):
        return spark.createDataFrame([(v,) for v in values], "v double").agg(money_sum("v").alias("s"), money_mean("v").alias("m")).first()

    assert one([1e-7, 3e-7]).m == pytest.approx(2e-7, rel=1e-12)
    assert one([math.inf, 1.0]).m == math.inf
    assert one([1e33, 1.0]).s == pytest.approx(1e33)
    assert one([0.1] * 10).s == 1.0
    assert one([None]).s is None
    filled = fill_nulls(spark.createDataFrame([(1e-7,), (3e-7,), (None,)], "v double"), {"v": NullStrategy.FILL_MEAN})
    assert sorted(r.v for r in filled.collect())[1] == pytest.approx(2e-7, rel=1e-12)


def test_nan_is_missing_everywhere(spark):
    df = spark.createDataFrame([(1.0,), (math.nan,), (None,)], "v double")
    with pytest.raises(RuleViolation) as e:
        Q.enforce(df, [Q.no_nulls(["v"])])
    assert e.value.found == {"v": (2, 66.67)}
    assert Q.violations(df, Q.no_nulls(["v"])).count() == 2
    assert fill_nulls(df, {"v": NullStrategy.DROP}).count() == 1
    assert fill_report(df, {"v": NullStrategy.FILL_ZERO}).first().nulls_before == 2
    assert {r.v for r in fill_nulls(df, {"v": NullStrategy.FILL_MODE}).collect()} == {1.0}


def test_two_ranges_on_a_column(spark):
    df = spark.createDataFrame([(500.0,)], "x double")
    with pytest.raises(RuleViolation, match="range"):
        Q.enforce(df, [Q.numeric_range("x", min_value=0), Q.numeric_range("x", max_value=100)])


def test_no_single_task_ranking(spark):
    df = spark.range(2000).select((F.col("id") * 7 % 1999).cast("double").alias("v"))
    assert exact_quantile(df, "v", 0.37).first()[0] == pytest.approx(df.toPandas().v.quantile(0.37), rel=1e-12)
    plan = M.status_funnel(spark.range(3).select(F.lit("a").alias("status")))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_failed_run_leaves_the_zones(spark, batch_tables, tmp_path):
    out = str(tmp_path / "out")
    run_batch(spark, batch_tables, out, formats=("parquet",))

    def read():
        return {t: sorted(map(str, publish.read_table(spark, out, t).collect()))
                for t in ("processed/parquet/orders_enriched", "output/parquet/monthly_sales", "output/parquet/delivery_rate")}

    before = read()
    bad = dict(batch_tables, orders=batch_tables["orders"].withColumn("discount_percent", F.lit(-5.0)))
    for checks in ("deferred", "eager"):
        with pytest.raises(RuleViolation, match="range"):
            run_batch(spark, bad, out, formats=("parquet",), checks=checks)
        assert read() == before
    assert os.listdir(f"{out}/_runs") == []


@pytest.mark.parametrize("step", ["place", "switch"])
def test_a_killed_publish_leaves_readers_on_the_old_run(spark, batch_tables, tmp_path, monkeypatch, step):
    out = str(tmp_path / "out")
    tables = ("processed/parquet/orders_enriched", "output/parquet/monthly_sales", "output/parquet/average_ticket")

    def read():
        return {t: sorted(map(str, publish.read_table(spark, out, t).collect())) for t in tables}

    run_batch(spark, batch_tables, out, formats=("parquet",), run_id="first")
    before = read()
    more = dict(batch_tables, orders=batch_tables["orders"].withColumn("total_amount", F.lit(5.0)))
    with monkeypatch.context() as m:
        def killed(*args):
            raise KeyboardInterrupt

        m.setattr(publish, step, killed)
        with pytest.raises(KeyboardInterrupt):
            run_batch(spark, more, out, formats=("parquet",), run_id="second")
    assert read() == before and publish.version(spark, out).endswith("/first")
    run_batch(spark, more, out, formats=("parquet",), run_id="third")
    assert publish.version(spark, out).endswith("/third") and read() != before
    publish.prune(spark, out, orphans=True)
    assert sorted(os.listdir(f"{out}/_versions")) == ["first", "third"] and os.listdir(f"{out}/_runs") == []


def test_old_versions_go(spark, tmp_path):
    out = str(tmp_path)
    assert publish.version(spark, out) is None
    for k in range(5):
        spark.range(k).write.parquet(f"{out}/_runs/r{k}/output/t")
        publish.publish(spark, out, f"r{k}", f"{out}/_runs/r{k}")
        assert publish.read_table(spark, out, "output/t").count() == k
    assert sorted(os.listdir(f"{out}/_versions")) == ["r2", "r3", "r4"]
    with pytest.raises(FileExistsError):
        publish.place(spark, out, "r4", f"{out}/_runs/r4")


def test_private_scratch_is_for_local_masters(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda *a: None)

    with pytest.raises(RuntimeError, match="share"):
        ensure_checkpoint_dir(Session())
