"""Delimited-file source with pandas-compatible parsing rules.

* Records are found by ``sources.records``: a file is read by many tasks, also
  where quoted fields hold newlines, and every record gets its number in the
  table (``_seq``, for keep-last dedup). Fields are text at first (quotes
  removed, doubled quotes halved), then converted to the target schema with
  non-raising expressions. White-space-only lines are skipped.
* The pandas default null tokens (``NA``, ``null``, ``n/a``, ``NaN``, ...)
  become NULL.
* Malformed rows: a row with more fields than the header is long, whatever the
  fields hold. Long rows raise a ``SourceError`` or go to quarantine. Short
  rows are padded with NULLs and kept.
* Every file must have the same header. An empty name becomes ``Unnamed: 3``,
  a repeated one ``a.1``.
* Columns that a cleaner coerces (``COERCED``) take the narrowest type that all
  their values have (whole numbers, numbers, else text), so a fill sees what
  the file holds and the cleaner's coercion comes after it. With
  ``infer_types`` columns that the schema doesn't name do so too, booleans
  included.
* An empty file, a quote that is never closed, and bytes that are invalid in
  the declared encoding (checked before decoding) raise ``SourceError``.
* ``multi_line=False`` ends a record at every newline, quoted or not.

Validation is ONE aggregate job (long rows, types), or none with
``validate=False``; ``malformed="quarantine"`` instead returns the long rows as
a separate DataFrame, lazily.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.errors import SourceError
from basketry.functions.coerce import numeric_expr
from basketry.functions.semantics import apart
from basketry.operators.dedup import SEQ
from basketry.schemas import COERCED, SCHEMAS, SOURCE_TABLES
from basketry.sources.records import fields, read_records

# The tokens pandas.read_csv treats as missing by default.
PANDAS_NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
                    "nan", "null")
# Text pandas reads as booleans.
TRUE_TOKENS = ("True", "TRUE", "true")
FALSE_TOKENS = ("False", "FALSE", "false")


def named(name: str) -> Column:
    """The column of that name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


#: Every text that casts to a whole number of 64 bits has this shape: trying the cast on any other text costs an exception.
WHOLE_SHAPE = r"^[^0-9.A-Za-z]*+[0-9]++[^0-9.A-Za-z]*+$"


def whole(c: Column, dtype: T.DataType | str = "bigint") -> Column:
    """Text as a whole number; NULL for any other text.

    A CASE, as Spark takes a cast that several conditions of ``&`` share out of them and tries it on every value.
    """
    return F.when(c.rlike(WHOLE_SHAPE), c.try_cast(dtype))


def likely_whole(c: Column, dtype: T.DataType | str = "bigint") -> Column:
    """Text as a whole number where two looks at its bytes let it be one; NULL may still be a whole number's text."""
    return F.when((c < ":") & ~c.contains("."), c.try_cast(dtype))


def null_tokens(c: Column, tokens=PANDAS_NA_TOKENS) -> Column:
    return F.when(c.isin(list(tokens)), F.lit(None).cast("string")).otherwise(c)


def typed(c: Column, dtype: T.DataType) -> Column:
    """Text -> target type; text that does not parse becomes NULL."""
    if isinstance(dtype, T.StringType):
        return c
    if isinstance(dtype, T.BooleanType):
        return (F.when(c.isin(list(TRUE_TOKENS)), F.lit(True))
                .when(c.isin(list(FALSE_TOKENS)), F.lit(False)))
    if isinstance(dtype, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        # integer text converts directly; otherwise whole numbers such as
        # "12.0" or "1e3" are kept (pandas would read the column as float)
        def rounded(text: Column) -> Column:
            num = numeric_expr(text, T.StringType())
            return F.when(num == F.floor(num), num).try_cast(dtype)
        return F.coalesce(likely_whole(c, dtype), F.when(c.isNotNull(), apart(c, lambda x: F.coalesce(whole(x, dtype), rounded(x)))))
    if isinstance(dtype, T.NumericType):
        return numeric_expr(c, T.StringType()).cast(dtype)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        from basketry.functions.coerce import datetime_expr
        return datetime_expr(c, T.StringType()).cast(dtype)
    return c.try_cast(dtype)


def _flagged(spark: SparkSession, path: str, schema: T.StructType | None, sep: str, encoding: str,
             multi_line: bool, validate: bool, with_seq: bool) -> tuple[DataFrame, T.StructType]:
    """Text columns (null tokens applied), ``_seq`` and ``_is_long``; the schema in file order."""
    found = read_records(spark, path, sep, encoding, multi_line, validate, numbered=with_seq)
    # Columns bind by header NAME (as pandas does), in file order; declared
    # types apply to the columns they name, any other column is text at first.
    declared = {f.name: f.dataType for f in schema.fields} if schema is not None else {}
    schema = T.StructType([T.StructField(n, declared.get(n, T.StringType()), True) for n in found.names])
    split = found.rows.select(fields(F.col("record"), sep).alias("_fields"), SEQ)
    flagged = split.select(*[null_tokens(F.get("_fields", F.lit(k))).alias(n) for k, n in enumerate(found.names)], SEQ,
                           (F.size("_fields") > len(found.names)).alias("_is_long"))
    return flagged, schema


def _problem_counts() -> list[Column]:
    return [F.count_if("_is_long").alias("long_rows")]


#: Bits of a value's code: no number (text), no whole number (part), no boolean (other).
_TEXT, _PART, _OTHER = 1, 2, 4


def _coded(flagged: DataFrame, schema: T.StructType, free: Iterable[str]) -> DataFrame:
    """``flagged`` with the code ``_code_{name}`` of each column typed by its values; NULL where there is no value.

    A column of its own, so that a value is looked at once however many counts are taken of it.
    """
    codes = []
    for name in free:
        if name in schema.names:
            c = named(name)
            codes.append(F.when(F.col("_is_long") | c.isNull(), F.lit(None).cast("int"))
                         .when(likely_whole(c).cast("string") == c, F.lit(_OTHER)).when(c.rlike(r"^[+-]?+[0-9]{1,300}+\.[0-9]*+\z"), F.lit(_PART + _OTHER))
                         .otherwise(apart(c, _code)).alias(f"_code_{name}"))
    return flagged.select("*", *codes)


def _code(c: Column) -> Column:
    num = numeric_expr(c, T.StringType())
    beyond = c.rlike(r"^\s*[+-]?[0-9]+\s*$") & whole(c).isNull()  # whole, but no 64-bit number
    return (F.when(num.isNull() | beyond, F.lit(_TEXT)).otherwise(F.lit(0)) + F.when(whole(c).isNull(), F.lit(_PART)).otherwise(F.lit(0))
            + F.when(c.isin(list(TRUE_TOKENS + FALSE_TOKENS)), F.lit(0)).otherwise(F.lit(_OTHER)))


def _shape_counts(schema: T.StructType, free: Iterable[str]) -> list[Column]:
    """For each column typed by its values: values at all, values that are not numbers, not whole numbers, not booleans."""
    out = []
    for name in free:
        if name in schema.names:
            code = named(f"_code_{name}")
            out += [F.count(code).alias(f"_any_{name}"),
                    *[F.count_if(code.bitwiseAND(F.lit(bit)) > 0).alias(f"{kind}_{name}")
                      for kind, bit in (("_text", _TEXT), ("_part", _PART), ("_other", _OTHER))]]
    return out


def _narrowed(schema: T.StructType, coerced: Iterable[str], undeclared: Iterable[str], counts) -> T.StructType:
    """``schema`` with each column typed by its values as wide as they need; text where they weren't counted.

    The lattice: nothing (a DOUBLE column of NULLs, as in pandas), booleans, whole numbers, numbers, text.
    """
    def kind(f: T.StructField) -> T.DataType:
        if f.name not in coerced and f.name not in undeclared:
            return f.dataType
        if counts is None:
            return T.StringType()
        free = f.name in undeclared
        if free and not counts[f"_any_{f.name}"]:
            return T.DoubleType()
        if free and not counts[f"_other_{f.name}"]:
            return T.BooleanType()
        if counts[f"_text_{f.name}"]:
            return T.StringType()
        whole = (free or isinstance(f.dataType, T.LongType)) and not counts[f"_part_{f.name}"]
        return T.LongType() if whole else T.DoubleType()

    return T.StructType([T.StructField(f.name, kind(f), True) for f in schema.fields])


def _free(schema: T.StructType, declared: T.StructType | None, infer_types: bool) -> tuple[str, ...]:
    known = set(declared.names) if declared is not None else set()
    return tuple(n for n in schema.names if infer_types and n not in known)


def _raise_problems(counts, path: str, sep: str, encoding: str) -> None:
    if counts["long_rows"]:
        raise SourceError("layout", path, f"{counts['long_rows']} rows have more fields than the header "
                                          f"(sep={sep!r}, encoding={encoding})")


def _typed_rows(flagged: DataFrame, schema: T.StructType, with_seq: bool) -> DataFrame:
    return flagged.select(*[typed(named(f.name), f.dataType).alias(f.name) for f in schema.fields],
                          *([F.col(SEQ)] if with_seq else []))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, *,
             sep: str = ",", encoding: str = "utf-8", with_seq: bool = True,
             validate: bool = True, malformed: str = "raise",
             multi_line: bool = True, coerced: tuple[str, ...] = (),
             infer_types: bool = False) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Read one delimited file (or directory) with the rules in the module doc.

    ``malformed``: ``"raise"`` (default, source-system behaviour),
    ``"quarantine"`` (returns ``(rows, long_rows)``) or ``"ignore"``.
    ``coerced`` columns are typed by their values, from the validating job;
    with ``validate=False`` they stay text. So are columns that ``schema``
    doesn't name, with ``infer_types``.
    """
    flagged, declared = _flagged(spark, path, schema, sep, encoding, multi_line, validate, with_seq)
    free = _free(declared, schema, infer_types)
    counts = None
    if validate and (malformed == "raise" or coerced or free):
        counts = _coded(flagged, declared, (*coerced, *free)).agg(*_problem_counts(), *_shape_counts(declared, (*coerced, *free))).first()
        if malformed == "raise":
            _raise_problems(counts, path, sep, encoding)
    kinds = _narrowed(declared, coerced, free, counts)
    rows = flagged
    if malformed in ("raise", "quarantine"):
        rows = flagged.where(~F.col("_is_long"))
    out = _typed_rows(rows, kinds, with_seq)
    if malformed == "quarantine":
        return out, _typed_rows(flagged.where(F.col("_is_long")), kinds, with_seq)
    return out


def ingest_csv(spark: SparkSession, path: str, out_path: str, schema: T.StructType | None = None, *,
               sep: str = ",", encoding: str = "utf-8", with_seq: bool = True,
               multi_line: bool = True, coerced: tuple[str, ...] = (), infer_types: bool = False) -> DataFrame:
    """Parse a delimited file ONCE into typed Parquet and return the Parquet table.

    Columns typed by their values are written as text and counted on the write;
    the returned table reads them in the type that the counts allow.

    The malformed-row check is observed on the write itself
    (``DataFrame.observe``), so fields are parsed a single time; the error is
    raised after the write, before anything reads the staged table.
    """
    from pyspark.sql import Observation

    flagged, declared = _flagged(spark, path, schema, sep, encoding, multi_line, True, with_seq)
    free = _free(declared, schema, infer_types)
    obs = Observation()
    observed = _coded(flagged, declared, (*coerced, *free)).observe(obs, *_problem_counts(), *_shape_counts(declared, (*coerced, *free)))
    as_text = _narrowed(declared, coerced, free, None)
    _typed_rows(observed.where(~F.col("_is_long")), as_text, with_seq) \
        .write.mode("overwrite").option("compression", "zstd").parquet(out_path)
    counts = obs.get
    _raise_problems(counts, path, sep, encoding)
    return _typed_rows(spark.read.parquet(out_path), T.StructType([
        f if f.name in coerced or f.name in free else T.StructField(f.name, T.StringType())
        for f in _narrowed(declared, coerced, free, counts).fields]), with_seq)


def read_source_table(spark: SparkSession, source_dir: str, name: str, *, sep: str = ",",
                      encoding: str = "utf-8", validate: bool = True, multi_line: bool = True) -> DataFrame:
    """One of the eight logical tables from ``{source_dir}/{stem}.csv``; columns beyond its schema are typed by their values."""
    if not name:
        raise ValueError("source name is required")
    stem = SOURCE_TABLES.get(name, name)
    return read_csv(spark, f"{source_dir.rstrip('/')}/{stem}.csv", SCHEMAS.get(name), sep=sep, encoding=encoding,
                    validate=validate, multi_line=multi_line, coerced=COERCED.get(name, ()), infer_types=True)
