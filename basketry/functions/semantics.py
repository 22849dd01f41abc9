"""Column builders that pin down null, NaN and float semantics.

The source system runs on pandas; these helpers reproduce the behaviours its
results depend on with JVM-side expressions only (no Python UDF):

* comparisons with a missing operand are False, never NULL;
* division by zero yields NULL instead of an ANSI error;
* money sums of six-decimal amounts do not depend on task order: each value is
  summed as a DECIMAL, and what that form cannot hold (digits past the sixth,
  huge values, infinity) is summed apart as DOUBLE and added, so nothing is cut
  (``operators.exact_sum`` depends on no order at all);
* NaN is treated as missing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY_DECIMAL = T.DecimalType(24, 6)  # sums of it have 38 digits: they hold 10^14 values


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    """NaN -> NULL for floating columns (pandas treats NaN as missing)."""
    c = col_(c)
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def apart(c: Column, how: Callable[[Column], Column]) -> Column:
    """``how(c)``, kept out of the code that Spark generates for a row.

    For the long expression of rare values next to a short one of all others:
    in line for some columns it makes methods too long for the JVM to compile.
    """
    return F.get(F.transform(F.array(c), how), F.lit(0))


def false_if_null(pred: Column) -> Column:
    """A predicate over a missing value is False (pandas comparison semantics)."""
    return F.coalesce(pred, F.lit(False))


def safe_div(num, den) -> Column:
    """num / den, NULL when den is 0 or NULL (ANSI mode would raise)."""
    return F.try_divide(col_(num).cast("double"), col_(den).cast("double"))


def money_sum(c) -> Column:
    """Sum of a DOUBLE amount as DOUBLE; order-independent for values of up to six decimals.

    The part of each value that the DECIMAL holds is summed exactly; the rest
    (0.0 for six-decimal amounts, the whole value for infinity) is a DOUBLE
    sum. NaN is missing. NULL-only groups give NULL; wrap in ``coalesce(..., 0)`` where the
    sum of nothing is zero.
    """
    x = nan_to_null(col_(c).cast("double"))
    held = x.try_cast(MONEY_DECIMAL)
    rest = x - F.coalesce(held.cast("double"), F.lit(0.0))
    return F.coalesce(F.sum(held).cast("double"), F.lit(0.0)) + F.sum(rest)


def missing(c, dtype: T.DataType) -> Column:
    """Whether a value counts as missing: NULL, or NaN in a floating column."""
    c = col_(c)
    return c.isNull() | F.isnan(c) if isinstance(dtype, (T.FloatType, T.DoubleType)) else c.isNull()


def money_mean(c) -> Column:
    """Mean of a DOUBLE amount via the exact sum; NULL if no values."""
    return safe_div(money_sum(c), F.count(nan_to_null(col_(c).cast("double"))))


def rate(pred: Column) -> Column:
    """Share of rows where ``pred`` holds (NULL predicate counts as False)."""
    return F.avg(false_if_null(pred).cast("int"))
