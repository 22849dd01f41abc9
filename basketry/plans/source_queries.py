"""Registered queries of the delimited-file source, and their DuckDB SQL.

Each query writes whole driver tables as text files of the kind in question and
reads them back through the source.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.operators.dedup import keep_last
from basketry.plans.oracle_ctes import with_ctes
from basketry.schemas import SCHEMAS
from basketry.session import scratch_dir
from basketry.sources.csv import PANDAS_NA_TOKENS, read_csv
from basketry.sources.sinks import write_csv
from basketry.sources.views import DriverViews

Query = Callable[[SparkSession, str], DataFrame]
#: Texts that are none of the tokens.
NEARLY_MISSING = ("nil", "nA", "N/a", "-", " NA", "0")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return DriverViews(spark, sf_dir).orders()


def _lines(df: DataFrame, header: str, path: str) -> str:
    """Write a one-column frame of ready-made lines under a header line, as one file."""
    head = df.sparkSession.range(1, numPartitions=1).select(F.lit(header).alias("value"))
    head.union(df.toDF("value")).coalesce(1).write.text(path)
    return path


def _noted() -> Column:
    """Notes with newlines, separators, doubled quotes, and a stray quote."""
    number = F.col("order_id").cast("string")
    return (F.when(F.col("order_id") % 3 == 0, F.concat(F.lit('first, "'), number, F.lit('"\n\nlast "line"\n,'), F.col("status")))
            .when(F.col("order_id") % 3 == 1, F.concat(number, F.lit('" wide')))
            .otherwise(F.col("notes")))


def csv_split_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file whose quoted fields hold newlines: its splits are read apart."""
    path = scratch_dir(spark, "split-quoted") + "/orders.csv"
    write_csv(_orders(spark, sf_dir).select("order_id", _noted().alias("notes"), "status"), path, single_file=True, profile=False)
    return read_csv(spark, path, SCHEMAS["orders"], with_seq=False)


def csv_stray_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes inside unquoted fields are text and open nothing; what follows a closing quote stays."""
    number = F.col("order_id").cast("string")
    field = (F.when(F.col("order_id") % 3 == 0, F.concat(number, F.lit('" wide')))
             .when(F.col("order_id") % 3 == 1, F.concat(F.lit('"'), number, F.lit('\n""x"" "tail'))).otherwise(number))
    path = _lines(_orders(spark, sf_dir).select(F.concat_ws(",", number, field, "status")), "order_id,notes,status",
                  scratch_dir(spark, "stray-quotes") + "/orders.csv")
    return read_csv(spark, path, SCHEMAS["orders"], with_seq=False)


def csv_keep_last_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several files that hold an order more than once: the last row of the last file stays, with its number in the table."""
    versions = F.sequence(F.lit(1), (F.col("order_id") % 4 + 1).cast("int"))
    path = scratch_dir(spark, "keep-last") + "/orders.csv"
    (_orders(spark, sf_dir).select("order_id", F.explode(versions).alias("total_amount"), "status")
     .repartitionByRange(9, "total_amount", "order_id").sortWithinPartitions("total_amount", "order_id")
     .write.option("header", True).csv(path))
    return keep_last(read_csv(spark, path, SCHEMAS["orders"]), "order_id")


def csv_encoding_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A replacement character that the file itself holds is text like any other."""
    note = F.when(F.col("order_id") % 2 == 0, F.concat(F.lit("�é"), F.col("status"))).otherwise(F.col("notes"))
    path = scratch_dir(spark, "encoding") + "/orders.csv"
    write_csv(_orders(spark, sf_dir).select("order_id", note.alias("notes")), path, profile=False)
    return read_csv(spark, path, SCHEMAS["orders"], with_seq=False)


def csv_latin1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file in another encoding, decoded in the tasks."""
    path = scratch_dir(spark, "latin-1") + "/orders.csv"
    note = F.when(F.col("order_id") % 2 == 0, F.concat(F.lit("añejo, «ß»\n"), F.col("status"))).otherwise(F.col("notes"))
    write_csv(_orders(spark, sf_dir).select("order_id", note.alias("notes")), path, encoding="ISO-8859-1", profile=False)
    return read_csv(spark, path, SCHEMAS["orders"], encoding="cp1252", with_seq=False)


def csv_inferred_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns without a declared type take the narrowest one that all their values have."""
    key = F.col("order_id")
    path = scratch_dir(spark, "inferred") + "/orders.csv"
    write_csv(_orders(spark, sf_dir).select(
        "order_id", "customer_id", "total_amount", (key % 2 == 0).alias("even"),
        F.when(key % 3 > 0, key % 3 == 1).alias("some_flag"), F.when(key % 5 > 0, key * 10).alias("some_whole"),
        F.when(key % 7 == 0, F.lit("12 euros")).otherwise(key.cast("string")).alias("mixed"),
        F.when(key % 2 == 0, F.lit("True")).otherwise(F.lit("1")).alias("flag_or_one"),
        F.lit(None).cast("string").alias("nothing"), "notes"), path, profile=False)
    return read_csv(spark, path, infer_types=True, with_seq=False)


def csv_header_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated, dotted and empty header names, and lines of white space between the rows."""
    number = F.col("order_id").cast("string")
    row = F.concat_ws(",", number, "status", F.concat(F.lit("n"), number), F.lit("x"), F.lit("z"))
    blank = F.when(F.col("order_id") % 3 == 0, F.lit("  \t ")).when(F.col("order_id") % 3 == 1, F.lit(""))
    lines = _orders(spark, sf_dir).select(F.explode(F.array_compact(F.array(row, blank))))
    return read_csv(spark, _lines(lines, "order_id,a.b,a.b,,a.b.1", scratch_dir(spark, "header") + "/orders.csv"),
                    SCHEMAS["orders"], with_seq=False)


def csv_null_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every token that stands for a missing value, quoted or not, and texts that nearly are one."""
    words = [*PANDAS_NA_TOKENS, *NEARLY_MISSING]
    note = F.element_at(F.array(*map(F.lit, words)), (F.col("order_id") % len(words) + 1).cast("int"))
    path = scratch_dir(spark, "null-tokens") + "/orders.csv"
    write_csv(_orders(spark, sf_dir).select("order_id", note.alias("notes"), "status"), path, profile=False)
    return read_csv(spark, path, SCHEMAS["orders"], with_seq=False)


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (csv_null_tokens, csv_split_quoted, csv_stray_quotes, csv_keep_last_files, csv_encoding_bytes, csv_latin1,
                                    csv_inferred_types, csv_header_names)}


_NL, _Q = "chr(10)", "'\"'"
_TOKENS = len(PANDAS_NA_TOKENS)
SOURCE_SQL: dict[str, str] = {
    "csv_null_tokens": "SELECT order_id, status, CASE order_id % " + str(_TOKENS + len(NEARLY_MISSING)) + " " + " ".join(
        f"WHEN {_TOKENS + k} THEN '{w}'" for k, w in enumerate(NEARLY_MISSING)) + " END AS notes FROM r_orders",
    "csv_split_quoted": f"""
SELECT order_id, CASE WHEN order_id % 3 = 0 THEN concat('first, "', order_id, '"', {_NL}, {_NL}, 'last "line"', {_NL}, ',', status)
                      WHEN order_id % 3 = 1 THEN concat(order_id, '" wide') ELSE notes END AS notes, status FROM r_orders""",
    "csv_stray_quotes": f"""
SELECT order_id, CASE WHEN order_id % 3 = 0 THEN concat(order_id, '" wide')
                      WHEN order_id % 3 = 1 THEN concat(order_id, {_NL}, '"x" tail') ELSE CAST(order_id AS VARCHAR) END AS notes, status
FROM r_orders""",
    "csv_keep_last_files": """
SELECT order_id, CAST(v AS DOUBLE) AS total_amount, status, row_number() OVER (ORDER BY v, order_id) - 1 AS _seq
FROM (SELECT order_id, unnest(range(1, CAST(order_id % 4 + 2 AS BIGINT))) AS v, status FROM r_orders) QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY v DESC) = 1""",
    "csv_encoding_bytes": """
SELECT order_id, CASE WHEN order_id % 2 = 0 THEN concat(chr(65533), 'é', status) ELSE notes END AS notes FROM r_orders""",
    "csv_latin1": f"""
SELECT order_id, CASE WHEN order_id % 2 = 0 THEN concat('añejo, «ß»', {_NL}, status) ELSE notes END AS notes FROM r_orders""",
    "csv_inferred_types": """
SELECT order_id, customer_id, total_amount, order_id % 2 = 0 AS even,
       CASE WHEN order_id % 3 > 0 THEN order_id % 3 = 1 END AS some_flag,
       CASE WHEN order_id % 5 > 0 THEN order_id * 10 END AS some_whole,
       CASE WHEN order_id % 7 = 0 THEN '12 euros' ELSE CAST(order_id AS VARCHAR) END AS mixed,
       CASE WHEN order_id % 2 = 0 THEN 'True' ELSE '1' END AS flag_or_one, CAST(NULL AS DOUBLE) AS nothing, notes FROM r_orders""",
    "csv_header_names": """
SELECT order_id, status AS "a.b", concat('n', order_id) AS "a.b.2", 'x' AS "Unnamed: 3", 'z' AS "a.b.1" FROM r_orders""",
}


def oracle_sql() -> dict[str, str]:
    return {k: with_ctes(v) for k, v in SOURCE_SQL.items()}
