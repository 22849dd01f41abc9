"""Sums of amounts against rational numbers, under several partitionings."""

import math
import random
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from basketry.operators.exact_sum import exact_mean, exact_sums
from basketry.operators.quantile import exact_quantiles


def amounts(rng, kind):
    return [[round(rng.uniform(-1e6, 1e6), 2) for _ in range(50)],
            [rng.uniform(-1, 1) * 10.0 ** rng.randint(-300, 300) for _ in range(30)],
            [9e31] * 20 + [1e-7] * 3 + [0.1] * 10, [1e16, 1.0, -1e16, 1e-7], [rng.uniform(0, 1) / 3 for _ in range(40)],
            [5e-324] * 7 + [-1e-320], [1.7e308, 1.7e308, -1.7e308], [-0.0, 0.0], [-9e31, 1e15, 999999999999999.9, 1e14 + 0.123456],
            [1e308] * 5, [-1e308] * 5, [0.1] * 10, [1e22, 1e-6, -1e22], [123456.123456, 1e-300]][kind]


def nearest(values):
    total = sum((Fraction(Decimal(repr(x))) for x in values), Fraction(0))
    try:
        return float(total)
    except OverflowError:
        return math.inf if total > 0 else -math.inf


def test_sums_are_the_nearest_doubles_in_any_order(spark):
    rng = random.Random(3)
    rows, want = [], {}
    for g in range(56):
        own = amounts(rng, g % 14)
        want[g] = (nearest(own), len(own))
        rows += [(g, x) for x in own]
    for parts in (1, 3, 9):
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, "g int, x double").repartition(parts)
        found = exact_sums(df, ["g"], {"total": "x"}, {"rows": (F.count(F.lit(1)), F.sum), "most": (F.max("x"), F.max)}).collect()
        assert {r.g: (r.total, r.total__n) for r in found} == want
        assert all(r.rows == r.total__n for r in found)


def test_missing_and_infinite_values(spark):
    nan, inf = math.nan, math.inf
    df = spark.createDataFrame([(1, inf, 1.0), (1, 1.0, None), (2, inf, nan), (2, -inf, 2.5), (3, None, 1e33), (3, nan, 1.0), (4, -inf, 4.0)],
                               "g int, x double, y double")
    got = {r.g: (r.s, r.s__n) for r in exact_sums(df, ["g"], {"s": "x"}).collect()}
    assert got[1] == (inf, 2) and math.isnan(got[2][0]) and got[3] == (None, 0) and got[4] == (-inf, 1)
    row = exact_sums(df, [], {"s": "x", "t": "y"}, {"rows": (F.count(F.lit(1)), F.sum)}).withColumn("m", exact_mean("t")).first()
    assert math.isnan(row.s) and (row.t, row.t__n, row.rows) == (1e33, 5, 7) and row.m == 1e33 / 5
    empty = exact_sums(df.where("g > 9"), [], {"s": "x"}).first()
    assert (empty.s, empty.s__n) == (None, 0)


@pytest.mark.parametrize("size,kind", [(1, 0), (2, 0), (7, 1), (3000, 0), (3000, 1), (3000, 2), (40000, 3)])
def test_quantiles_share_two_scans(spark, size, kind):
    rng = random.Random(size)
    draw = [lambda: rng.uniform(-5, 5), lambda: float(rng.randrange(3)), lambda: rng.choice([-math.inf, math.inf, 1e300 * rng.random(), 10.0 ** rng.randint(-300, 300)]),
            lambda: math.exp(rng.gauss(0, 9))][kind]
    rows = [(draw(), rng.choice([None, math.nan, float(rng.randrange(100))])) for _ in range(size)]
    df = spark.createDataFrame(rows, "x double, y double").repartition(3)
    wanted = {f"x{k}": ("x", p) for k, p in enumerate((0.0, 0.1, 0.37, 0.5, 0.99, 1.0))} | {f"y{k}": (F.col("y") * 2, p) for k, p in enumerate((0.25, 0.5))}
    got = exact_quantiles(df, wanted).first().asDict()
    held = {"x": sorted(a for a, _ in rows), "y": sorted(2 * b for _, b in rows if b is not None and not math.isnan(b))}
    for alias, (_, p) in wanted.items():
        own = held[alias[0]]
        if not own:
            assert got[alias] is None
            continue
        at = p * (len(own) - 1)
        lo, hi = own[math.floor(at)], own[math.ceil(at)]
        want = lo if lo == hi else lo + (hi - lo) * (at - math.floor(at))
        assert got[alias] == want or math.isnan(got[alias]) and math.isnan(want), (alias, got[alias], want)


def test_quantile_plan_reads_the_table_twice(spark, tmp_path):
    spark.range(5000).selectExpr("cast(id * 7 % 4999 as double) as v", "cast(id as double) as w").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    found = exact_quantiles(df, {"a": ("v", 0.1), "b": ("v", 0.9), "c": ("w", 0.5)})
    assert found.first().c == 2499.5
    final = found._jdf.queryExecution().executedPlan()
    found.collect()
    plan = final.toString().split("== Initial Plan ==")[0]
    assert "isFinalPlan=true" not in plan or plan.count("FileScan parquet") <= 2  # the sketch has a scan of its own, in a subquery
