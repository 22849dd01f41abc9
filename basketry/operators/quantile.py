"""Exact quantiles (linear interpolation) without one task holding every value.

``percentile``/``median``/``mode`` keep a map of every distinct value in one
final buffer; for a global aggregate that buffer lands in a single task and
grows with the data. Here any number of columns and probabilities share two
scans with bounded per-task state:

1. one aggregate sketches every column (``percentile_approx``, bounded, relative
   rank error 1/accuracy) and cuts the surroundings of each wanted rank at
   ``CUTS`` steps of that error: a histogram that is fine where it matters;
2. one group-by counts, for each wanted rank, the values below and above its cuts
   (one row a task) and every distinct value between them (about 6/accuracy of
   the data). The cuts divide those evenly by rank, whatever their spread; each
   part is divided again by value, ranked alone, and starts at the total of the
   parts before it.

The two neighbours of the rank are interpolated. The sketch can be one rank off
where there are few values, so the largest value below and the smallest above
count for the ranks next to the cuts. If a rank still lay outside, the query
fails through ``raise_error`` instead of returning a wrong number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.semantics import col_, nan_to_null
from basketry.operators.scalars import attach

DEFAULT_ACCURACY = 10000
#: Cuts around a rank, one step of the sketch's error apart, and parts by value between two of them.
CUTS, SLOTS = 7, 128


def exact_quantile(df: DataFrame, column: str, p: float, alias: str = "quantile",
                   accuracy: int = DEFAULT_ACCURACY, materialize: bool = False) -> DataFrame:
    """One-row DataFrame with the exact ``p`` quantile of ``column``; see ``exact_quantiles``.

    ``materialize=True`` checkpoints the single value column first, for an input
    that is an expensive plan.
    """
    if materialize:
        from basketry.session import materialize as _materialize
        df = _materialize(df.select(column))
    return exact_quantiles(df, {alias: (column, p)}, accuracy)


def exact_quantiles(df: DataFrame, wanted: dict[str, tuple[str | Column, float]],
                    accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """One row with a column for each alias: the exact quantile of (column, probability).

    Same definition as pandas ``Series.quantile`` / Spark ``percentile`` /
    DuckDB ``quantile_cont``: position ``p * (n - 1)`` over the sorted
    non-null values (NaN is missing), linear interpolation between its two
    neighbours. NULL when there are no values. The input is read twice.
    """
    if not wanted:
        raise ValueError("no quantile is wanted")
    if not all(0.0 <= p <= 1.0 for _, p in wanted.values()):
        raise ValueError("p must be within [0, 1]")
    names: dict[str, str] = {}
    for c, _ in wanted.values():
        names.setdefault(str(c), f"_v{len(names)}")
    of = {str(c): c for c, _ in wanted.values()}
    vals = df.select(*[nan_to_null(col_(of[k]).cast("double")).alias(n) for k, n in names.items()])
    asked = [(alias, names[str(c)], float(p)) for alias, (c, p) in wanted.items()]
    steps = [(k - CUTS // 2) / accuracy for k in range(CUTS)]
    sketch = vals.agg(*[
        F.percentile_approx(n, F.array(*[F.lit(min(1.0, max(0.0, p + s))) for _, m, p in asked if m == n for s in steps]),
                            F.lit(accuracy)).alias(n) for n in names.values()])
    place = {alias: sum(m == n for _, m, _ in asked[:k]) * CUTS + 1 for k, (alias, n, _) in enumerate(asked)}
    held = attach(vals, sketch, "_s").select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("q"), F.col(n).alias("v"), F.slice(F.col(f"_s.{n}"), place[alias], CUTS).alias("cuts"))
        for k, (alias, n, _) in enumerate(asked)])).alias("r")).select("r.*").where("v is not null")

    # 0: below the cuts, CUTS + 1: above, else between two of them
    v, cuts = F.col("v"), F.col("cuts")
    part = F.when(v > F.element_at(cuts, CUTS), F.lit(CUTS + 1)).otherwise(F.size(F.filter(cuts, lambda c: c <= v)))
    inside = F.col("part").between(1, CUTS)
    low, high = F.get(cuts, F.col("part") - 1), F.get(cuts, F.col("part"))
    spread = F.nanvl(F.try_divide(v - low, high - low), F.lit(0.0)) * SLOTS
    slot = F.when(inside & (F.abs(high - low) < float("inf")), F.least(F.floor(F.coalesce(spread, F.lit(0.0))), F.lit(SLOTS - 1)))
    cells = (held.withColumn("part", part).withColumn("slot", F.coalesce(slot, F.lit(0)).cast("int"))
             .groupBy("q", "part", "slot", F.when(inside, v).alias("value"))
             .agg(F.count(F.lit(1)).alias("n"), F.max("v").alias("most"), F.min("v").alias("least")))

    before = Window.partitionBy("q").orderBy("part", "slot").rowsBetween(Window.unboundedPreceding, -1)
    parts = cells.groupBy("q", "part", "slot").agg(F.sum("n").alias("m")).select(
        "q", "part", "slot", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("start"), F.sum("m").over(Window.partitionBy("q")).alias("all"))
    upto = Window.partitionBy("q", "part", "slot").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.col("start") + F.sum("n").over(upto)
    # below the cuts only the last rank is known, above them only the first
    ranked = cells.join(parts, ["q", "part", "slot"]).select(
        "q", "all", F.when(F.col("part") == 0, F.col("most")).when(F.col("part") == CUTS + 1, F.col("least")).otherwise(F.col("value")).alias("value"),
        F.when(F.col("part") == 0, end - 1).otherwise(end - F.col("n")).alias("first"),
        F.when(F.col("part") == CUTS + 1, F.col("start") + 1).otherwise(end).alias("end"))
    position = F.element_at(F.array(*[F.lit(p) for _, _, p in asked]), F.col("q") + 1) * (F.col("all") - 1)
    value = F.col("value")

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("first") <= rank) & (rank < F.col("end")), value))

    position_ = F.col("position")
    picked = (ranked.withColumn("position", position).groupBy("q")
              .agg(at(F.floor(position_)).alias("lo"), at(F.ceil(position_)).alias("hi"), F.max(position_ - F.floor(position_)).alias("share")))
    lo, hi = F.col("lo"), F.col("hi")
    out = (F.when(lo.isNull() | hi.isNull(), F.raise_error(F.lit("exact_quantiles: the sketch missed a rank")).cast("double"))
           .when(lo == hi, lo).otherwise(lo + (hi - lo) * F.col("share")))
    return picked.select("q", out.alias("value")).agg(*[F.max(F.when(F.col("q") == k, F.col("value"))).alias(alias) for k, (alias, _, _) in enumerate(asked)])
