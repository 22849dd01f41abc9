"""Null-handling strategies (drop / zero / string / mean / median / mode).

A fill plan is an ordered ``{column: NullStrategy}``. All statistics a plan
needs are computed as one-row DataFrames (means with :func:`exact_sums`, mode
with two partial aggregations, medians with :func:`exact_quantiles`) and
referenced as a scalar subquery, so the whole step stays one lazy plan with
no join and no driver round trip.
"""

from __future__ import annotations

from enum import Enum

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.errors import RuleViolation
from basketry.functions.coerce import numeric_expr
from basketry.functions.derived import FILL_STRING_VALUE
from basketry.functions.semantics import missing, nan_to_null
from basketry.operators.exact_sum import exact_mean, exact_sums
from basketry.operators.quantile import exact_quantiles
from basketry.operators.scalars import attach, with_scalars


class NullStrategy(Enum):
    DROP = "drop"
    FILL_MEAN = "fill_mean"
    FILL_MEDIAN = "fill_median"
    FILL_MODE = "fill_mode"
    FILL_STRING = "fill_string"
    FILL_ZERO = "fill_zero"


def _stat_name(c: str) -> str:
    return f"__fill_{c}"


def _keep_after_drops(df: DataFrame, drops: list[str]) -> Column:
    cond = F.lit(True)
    for d in drops:
        cond = cond & ~missing(d, df.schema[d].dataType)
    return cond


def _fill_parts(df: DataFrame, plan: dict[str, NullStrategy]) -> tuple[dict[str, Column], list[DataFrame]]:
    """The values that each mean is taken of, and one-row frames of the median and mode statistics."""
    drops: list[str] = []
    means: dict[str, Column] = {}
    medians: dict[str, tuple[Column, float]] = {}
    frames: list[DataFrame] = []
    for c, strategy in plan.items():
        if c not in df.columns:
            continue
        keep = _keep_after_drops(df, drops)
        dtype = df.schema[c].dataType
        if strategy is NullStrategy.DROP:
            drops.append(c)
        elif strategy is NullStrategy.FILL_MEAN:
            means[_stat_name(c)] = F.when(keep, numeric_expr(F.col(c), dtype))
        elif strategy is NullStrategy.FILL_MEDIAN:
            medians[_stat_name(c)] = (F.when(keep, numeric_expr(F.col(c), dtype)), 0.5)
        elif strategy is NullStrategy.FILL_MODE:
            frames.append(mode_value(df.where(keep), c, alias=_stat_name(c)))
    if medians:
        frames.insert(0, exact_quantiles(df, medians))
    return means, frames


def _one_row(df: DataFrame, aggs: list[Column], frames: list[DataFrame]) -> DataFrame | None:
    parts = ([df.agg(*aggs)] if aggs else []) + frames
    if not parts:
        return None
    return with_scalars(parts[0], *parts[1:])


def fill_statistics(df: DataFrame, plan: dict[str, NullStrategy]) -> DataFrame | None:
    """One row with the fill value of every mean/median/mode column.

    Statistics see the rows that survive DROP steps listed *before* their
    column, as the sequential source semantics require, and include duplicate
    rows (fills run before dedup). Means are exact sums / counts; all means come
    from one pass, all medians from two.
    """
    means, frames = _fill_parts(df, plan)
    if means:
        frames.insert(0, exact_sums(df, [], means).select(*[exact_mean(c).alias(c) for c in means]))
    return _one_row(df, [], frames)


def mode_value(df: DataFrame, column: str, alias: str = "mode") -> DataFrame:
    """Most frequent non-null value; ties go to the smallest value.

    Two partial aggregations (value counts, then a min_by over them) instead of
    ``mode()``, whose single global buffer holds every distinct value.
    """
    counts = (df.where(~missing(column, df.schema[column].dataType))
              .groupBy(column).agg(F.count(F.lit(1)).alias("_cnt")))
    return counts.agg(F.min_by(F.col(column), F.struct(-F.col("_cnt"), F.col(column))).alias(alias))


def fill_nulls(df: DataFrame, plan: dict[str, NullStrategy]) -> DataFrame:
    """Apply the plan in order; absent columns are skipped (a no-op).

    FILL_ZERO / FILL_STRING keep the column's type where the literal fits;
    FILL_MEAN / FILL_MEDIAN first coerce the column to a number (unparseable
    text becomes NULL and is then filled too), producing DOUBLE.
    """
    plan = {c: s for c, s in plan.items() if c in df.columns}
    if not plan:
        return df
    stats = fill_statistics(df, plan)
    # the statistics row is a scalar subquery, projected once: computed once, no join
    base = attach(df, stats, "__stats") if stats is not None else df

    def stat(c: str):
        return F.col(f"__stats.{_stat_name(c)}")
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        strategy = plan.get(f.name)
        if strategy is NullStrategy.FILL_ZERO:
            if isinstance(f.dataType, T.StringType):
                c = F.coalesce(c, F.lit("0"))
            elif isinstance(f.dataType, T.BooleanType):
                c = F.coalesce(c, F.lit(False))
            elif isinstance(f.dataType, (T.FloatType, T.DoubleType)):
                c = F.coalesce(nan_to_null(c), F.lit(0).cast(f.dataType))
            elif isinstance(f.dataType, T.NumericType):
                c = F.coalesce(c, F.lit(0).cast(f.dataType))
        elif strategy is NullStrategy.FILL_STRING:
            if isinstance(f.dataType, T.StringType):
                c = F.coalesce(c, F.lit(FILL_STRING_VALUE))
        elif strategy in (NullStrategy.FILL_MEAN, NullStrategy.FILL_MEDIAN):
            c = F.coalesce(numeric_expr(c, f.dataType), stat(f.name))
        elif strategy is NullStrategy.FILL_MODE:
            c = F.when(missing(c, f.dataType), stat(f.name).cast(f.dataType)).otherwise(c)
        out.append(c.alias(f.name))
    result = base.select(*out)
    drops = [c for c, s in plan.items() if s is NullStrategy.DROP]
    if drops:
        result = result.where(_keep_after_drops(df, drops))
    return result


def fill_report(df: DataFrame, plan: dict[str, NullStrategy],
                extra: dict[str, Column] | None = None) -> DataFrame:
    """Per filled column: nulls before, nulls after, filled count (one row each).

    Null counts come from ONE aggregate over the input
    (``extra`` aggregates by name — e.g. key-null counts — ride along and
    are repeated on every row); median/mode statistics add their own small passes. The
    nulls-after count follows from the statistic: a mean/median fill leaves
    the coerced-NULL values NULL only when the statistic itself is NULL.
    """
    plan = {c: s for c, s in plan.items() if c in df.columns and s is not NullStrategy.DROP}
    extra = dict(extra or {})
    if not plan:
        raise ValueError("fill_report needs at least one filled column present in the table")
    aggs = []
    for c, s in plan.items():
        dtype = df.schema[c].dataType
        aggs.append(F.count_if(missing(c, dtype)).alias(f"_b_{c}"))
        if s in (NullStrategy.FILL_MEAN, NullStrategy.FILL_MEDIAN):
            aggs.append(F.count_if(numeric_expr(F.col(c), dtype).isNull()).alias(f"_cn_{c}"))
    means, frames = _fill_parts(df, plan)
    # whether there is a mean is all that counts here
    there = [F.when(F.count(nan_to_null(v.cast("double"))) > 0, F.lit(0.0)).alias(c) for c, v in means.items()]
    counts = _one_row(df, aggs + there + [e.alias(n) for n, e in extra.items()], frames)
    extra_names = list(extra)
    rows = []
    for c, s in plan.items():
        before = F.col(f"_b_{c}")
        if s in (NullStrategy.FILL_MEAN, NullStrategy.FILL_MEDIAN):
            after = F.when(F.col(_stat_name(c)).isNull(), F.col(f"_cn_{c}")).otherwise(F.lit(0))
        elif s is NullStrategy.FILL_MODE:
            after = F.when(F.col(_stat_name(c)).isNull(), before).otherwise(F.lit(0))
        elif s is NullStrategy.FILL_STRING and not isinstance(df.schema[c].dataType, T.StringType):
            after = before
        else:
            after = F.lit(0)
        rows.append(F.struct(F.lit(c).alias("column"), F.lit(s.value).alias("strategy"),
                             before.cast("bigint").alias("nulls_before"),
                             after.cast("bigint").alias("nulls_after"),
                             (before - after).cast("bigint").alias("filled")))
    return counts.select(F.explode(F.array(*rows)).alias("r"), *extra_names).select("r.*", *extra_names)


def assert_fill_invariant(report_rows) -> None:
    """Raise if a fill increased a column's nulls."""
    for r in report_rows:
        if r["nulls_after"] > r["nulls_before"]:
            raise RuleViolation("fill", {r["column"]: r["nulls_after"]}, f"at most {r['nulls_before']} nulls after {r['strategy']}")
