"""Sinks: CSV and Parquet writers with load profiles.

Writers produce a directory per table (``{dir}/{name}.csv/part-*``), the
distributed analogue of one file per table. Small bounded tables (metrics)
may be written as one part with ``single_file=True``; large tables keep
their partitioning. The pre-load profile (rows, missing cells) rides on the
write job through ``DataFrame.observe`` — no extra pass over the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions.derived import month_text, week_text
from basketry.functions.semantics import apart
from basketry.operators.profile import observe_profile, profile_from_observation

TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss"
TIMESTAMP_FRACTION_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def timestamp_text(c):
    """``2024-01-15 10:00:00``; microseconds only when present."""
    # a year of four digits: the cast's text, whose fraction ends at its last digit
    text = c.cast("string")
    usual = (F.substring(text, 5, 1) == "-") & ~text.startswith("0000")
    return F.when(usual, F.when(F.length(text) == 19, text).otherwise(F.rpad(text, 26, "0"))).otherwise(apart(c, _formatted))


def _formatted(c):
    return F.when(F.date_format(c, "SSSSSS") == "000000", F.date_format(c, TIMESTAMP_TEXT)) \
        .otherwise(F.date_format(c, TIMESTAMP_FRACTION_TEXT))


def double_text(c):
    """Plain decimal text (``48705233.797266``, ``120.0``) where it reads back as
    the same double, else Spark's shortest form (``1.0E-7``), which always does.
    NULL and NaN are written empty."""
    # up to seven digits in front of the point and no zeros behind it: the shortest form is the plain one
    short = (c == 0) | ((F.abs(c) >= 0.1) & (F.abs(c) < 1e7))
    return (F.when(c.isNull() | F.isnan(c), F.lit(None).cast("string"))
            .when(short, c.cast("string")).otherwise(apart(c, _plain)))


def _plain(c):
    plain = c.try_cast("decimal(38,18)").cast("string")
    plain = F.regexp_replace(F.regexp_replace(plain, r"0+$", ""), r"\.$", ".0")
    return F.when((plain.try_cast("double") == c) & (F.abs(c) >= 1e-4), plain).otherwise(c.cast("string"))


MONTH_COLUMNS = ("order_month", "review_month")
WEEK_COLUMNS = ("order_week",)


def csv_text_columns(df: DataFrame, months=MONTH_COLUMNS, weeks=WEEK_COLUMNS) -> DataFrame:
    """Render values the way the source system's CSV files show them.

    Timestamps ``2024-01-15 00:00:00``, booleans ``True``/``False``, month
    periods ``2024-01``, week periods ``2024-01-08/2024-01-14``.
    """
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in months and isinstance(f.dataType, T.DateType):
            c = month_text(c)
        elif f.name in weeks and isinstance(f.dataType, T.DateType):
            c = week_text(c)
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = timestamp_text(c)
        elif isinstance(f.dataType, T.DoubleType):
            c = double_text(c)
        elif isinstance(f.dataType, T.BooleanType):
            c = F.when(c, F.lit("True")).when(~c, F.lit("False"))
        out.append(c.alias(f.name))
    return df.select(*out)


def write_csv(df: DataFrame, path: str, *, sep: str = ",", encoding: str = "utf-8",
              single_file: bool = False, profile: bool = True, compression: str | None = None) -> dict | None:
    """Write ``df`` as headered CSV under ``path`` (overwrite), plain or by a codec such as ``gzip``."""
    data = csv_text_columns(df)
    obs = None
    if profile:
        data, obs = observe_profile(data)
    if single_file:
        data = data.coalesce(1)
    # the codec's default level takes more time than all else in the write
    (data.write.mode("overwrite").option("header", True).option("sep", sep).option("compression", compression or "none")
     .option("zlib.compress.level", "BEST_SPEED").option("encoding", encoding).option("quote", '"').option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))
    return profile_from_observation(obs, df) if obs is not None else None


def write_parquet(df: DataFrame, path: str, *, compression: str = "snappy",
                  single_file: bool = False, profile: bool = True) -> dict | None:
    data = df
    obs: Observation | None = None
    if profile:
        data, obs = observe_profile(data)
    if single_file:
        data = data.coalesce(1)
    data.write.mode("overwrite").option("compression", compression).parquet(path)
    return profile_from_observation(obs, df) if obs is not None else None


def written_tables_size(spark: SparkSession, root: str) -> DataFrame:
    """Post-load profile of every table written under ``root`` in ONE job.

    One row per table folder (``{zone}/{format}/{table}``): part-file count and
    total size in MB (2 dp). Lists files only (``binaryFile`` without its
    content column).
    """
    root = root.rstrip("/")
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", "part-*").load(root).select("path", "length"))
    table = F.regexp_extract("path", r"^(.*)/[^/]+$", 1)
    return (files.groupBy(table.alias("target"))
            .agg(F.count(F.lit(1)).alias("files"),
                 F.round(F.sum("length") / (1024 * 1024), 2).alias("file_size_mb")))


def written_size(spark: SparkSession, path: str) -> DataFrame:
    """Post-load profile: file count and total size (MB, 2 dp) of a written table.

    Reads file listings only (``binaryFile`` without its content column).
    """
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "part-*")
             .load(path).select("path", "length"))
    return files.agg(F.count(F.lit(1)).alias("files"),
                     F.round(F.coalesce(F.sum("length"), F.lit(0)) / (1024 * 1024), 2).alias("file_size_mb"),
                     F.lit(path).alias("target"))
