"""Attach one-row results (statistics, totals, thresholds) to a larger query.

Two forms, both with a proven size bound of ONE row:

* ``attach`` — a scalar subquery (``DataFrame.scalar()``) projected once as a
  struct column: used where a single one-row result feeds a row-wise
  expression (fill values, a threshold). No join at all; every field read
  shares the one execution.
* ``join_row`` / ``with_scalars`` — a broadcast of the single row joined to
  every row of ``base``: used where several one-row results are combined or
  a one-row result is read inside further aggregates (quantile bracket,
  rule-metric rows). The build side is exactly one row, so the output has
  exactly as many rows as ``base``; AQE runs the one-row stages concurrently
  (subqueries run one after another).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def scalar_row(one_row: DataFrame) -> Column:
    """Every column of a one-row DataFrame as one struct-valued scalar subquery."""
    return one_row.select(F.struct(*[F.col(f"`{c}`") for c in one_row.columns]).alias("_row")).scalar()


def attach(base: DataFrame, one_row: DataFrame, name: str) -> DataFrame:
    """``base`` plus a struct column ``name`` holding the one-row result.

    Reference fields as ``F.col(f"{name}.field")``.
    """
    return base.select("*", scalar_row(one_row).alias(name))


def join_row(base: DataFrame, one_row: DataFrame) -> DataFrame:
    """``base`` with the columns of a ONE-row DataFrame appended to every row.

    ``one_row`` must be a global aggregate (or built from them): one row by
    construction, broadcast, so no pairs are formed and nothing is shuffled.
    """
    return base.crossJoin(F.broadcast(one_row))


def with_scalars(base: DataFrame, *one_rows: DataFrame) -> DataFrame:
    """``base`` plus every column of each one-row DataFrame."""
    out = base
    for one in one_rows:
        out = join_row(out, one)
    return out
