"""Type-coercion expressions (unparseable -> NULL, never an ANSI error)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions.semantics import apart, nan_to_null

# What counts as a number and which datetime layouts are parsed.
# A number is what Spark's string->double cast parses (decimal or scientific
# literal, optional sign, surrounding spaces, "inf"/"infinity"/"nan" in any
# case) minus the Java-only type suffixes ("1d", "2f") that pandas.to_numeric
# rejects; NaN counts as missing.
JAVA_SUFFIXES = ("d", "D", "f", "F")
DATETIME_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss",
                    "yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd")

# A plain number: no exponent, no word and no suffix, so it is neither missing nor beyond a DOUBLE.
PLAIN_SHAPE = r"^[+-]?+(?:[0-9]{1,300}+(?:\.[0-9]*+)?+|\.[0-9]++)\z"
# Every text that casts to a DOUBLE has this shape. Trying a cast or a layout on a text that
# can't have it costs an exception a value, far more than the look at its shape.
NUMBER_SHAPE = r"(?s)^[\x00-\x20]*+[+-]?+(?:0[xX].*|(?i:inf|nan).*|[0-9.]++(?:[eE][+-]?+[0-9]++)?+[dDfF]?+[\x00-\x20]*+)$"

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)


def _dtype(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def numeric_expr(c: Column, dtype: T.DataType) -> Column:
    """Coerce to a number; unparseable text becomes NULL.

    Integral inputs stay BIGINT (the source keeps int columns integral);
    fractional inputs become DOUBLE with NaN as NULL; text is trimmed and
    parsed to DOUBLE only when it looks like a number.
    """
    if isinstance(dtype, _INTEGRAL):
        return c.cast("bigint")
    if isinstance(dtype, _FRACTIONAL):
        return nan_to_null(c.cast("double"))
    if isinstance(dtype, T.BooleanType):
        return c.cast("bigint")
    txt = F.trim(c.cast("string"))
    return (F.when(txt.rlike(PLAIN_SHAPE), txt.try_cast("double"))
            .when(txt.rlike(NUMBER_SHAPE), apart(txt, _any_number)))


def _any_number(txt: Column) -> Column:
    spelled_inf = F.lower(txt).contains("inf")
    java_suffix = F.substring(txt, -1, 1).isin(list(JAVA_SUFFIXES)) & ~F.lower(txt).endswith("inf")
    num = nan_to_null(txt.try_cast("double"))
    overflow = (F.abs(num) == float("inf")) & ~spelled_inf      # "1e309": pandas gives NaN
    return F.when(java_suffix | overflow, F.lit(None).cast("double")).otherwise(num)


def _may_have(txt: Column, fmt: str) -> Column:
    """Whether a text holds the signs that a layout of digits writes, and none that it never does."""
    fields = re.sub("'[^']*'", "", fmt)
    if not set(fields) <= set("yMdHmsS-/:. "):
        return F.lit(True)
    out = F.lit(True)
    for sign in ":. ":
        out = out & (txt.contains(sign) if sign in fields else ~txt.contains(sign))
    for letter in re.findall("'([A-Za-z])'", fmt):
        out = out & (txt.contains(letter.upper()) | txt.contains(letter.lower()))
    return out


def datetime_expr(c: Column, dtype: T.DataType, formats=DATETIME_FORMATS) -> Column:
    """Coerce to TIMESTAMP_NTZ; unparseable text becomes NULL.

    Formats are explicit and tried in order (the source system infers one
    format from the first value; a fixed list is the deterministic analogue).
    """
    if isinstance(dtype, (T.TimestampNTZType,)):
        return c
    if isinstance(dtype, (T.TimestampType, T.DateType)):
        return c.cast("timestamp_ntz")
    txt = F.trim(c.cast("string"))
    if tuple(formats) == DATETIME_FORMATS:
        return F.coalesce(iso_seconds(txt), _by_formats(txt, formats))
    return _by_formats(txt, formats)


#: Dates with whole seconds or none, from the year 1 on: the cast and the layouts read them as the same time.
ISO_SHAPE = r"^(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}(?: [0-9]{2}:[0-9]{2}:[0-9]{2})?+\z"


def iso_seconds(txt: Column) -> Column:
    """Text of the layouts ``yyyy-MM-dd HH:mm:ss`` and ``yyyy-MM-dd`` as TIMESTAMP_NTZ, cast without a formatter; NULL for any other."""
    return F.when(txt.rlike(ISO_SHAPE), txt.try_cast("timestamp_ntz"))


def _by_formats(txt: Column, formats) -> Column:
    parsed = [F.when(_may_have(txt, fmt), F.try_to_timestamp(txt, F.lit(fmt))) for fmt in formats]
    return F.coalesce(*parsed).cast("timestamp_ntz")


def id_expr(c: Column, dtype: T.DataType) -> Column:
    """Hard cast of an id to BIGINT (fractions truncate, as int64 casts do).

    Under ANSI mode text that is not an integer raises, like the source's
    ``astype('int64')``; NULLs survive (the cleaners forbid them earlier).
    """
    if isinstance(dtype, _INTEGRAL):
        return c.cast("bigint")
    if isinstance(dtype, _FRACTIONAL):
        return c.cast("double").cast("bigint")
    return c.cast("string").cast("double").cast("bigint")


def coerce_columns(df: DataFrame, numeric=(), dates=(), ids=(), date_formats=DATETIME_FORMATS) -> DataFrame:
    """Apply id / numeric / datetime coercion to the listed columns that exist.

    One ``select`` so the whole step stays inside a single codegen stage.
    """
    numeric, dates, ids = set(numeric), set(dates), set(ids)
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in ids:
            c = id_expr(c, f.dataType)
        elif f.name in numeric:
            c = numeric_expr(c, f.dataType)
        elif f.name in dates:
            c = datetime_expr(c, f.dataType, date_formats)
        out.append(c.alias(f.name))
    return df.select(*out)


def coercion_report(df: DataFrame, numeric=(), dates=(), date_formats=DATETIME_FORMATS) -> DataFrame:
    """Per coerced column: how many present values became NULL (one aggregate)."""
    aggs, names = [], []
    for c in list(numeric) + list(dates):
        if c not in df.columns:
            continue
        dtype = df.schema[c].dataType
        conv = numeric_expr(F.col(c), dtype) if c in numeric else datetime_expr(F.col(c), dtype, date_formats)
        aggs.append(F.count_if(F.col(c).isNotNull() & conv.isNull()).alias(c))
        names.append(c)
    if not aggs:
        return df.sparkSession.createDataFrame([], "column string, coerced_to_null bigint")
    row = df.agg(*aggs)
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("bigint").alias("coerced_to_null"))
        for c in names])).alias("r")).select("r.*")
