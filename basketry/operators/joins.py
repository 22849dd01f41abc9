"""Dimension joins (all equi, single-key, left outer) with their guards.

Join strategy is left to Spark up to a bound: the planner broadcasts a side whose
*estimated* size is under ``spark.sql.autoBroadcastJoinThreshold``, and AQE
re-plans a sort-merge join into a broadcast join when the *measured* shuffle
output of a side is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``
and splits skewed partitions otherwise. No dimension is force-broadcast.

The estimate is the size of a table's files, and compressed Parquet can be a
sixtieth of the rows that the driver then collects and hashes. So a side's rows
are measured first (``unless_large``), and a large one is sorted and merged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of rows up to which a side may be broadcast; their hash table takes up to some five times as much on the driver.
BROADCAST_BYTES = 20 * 2**20


def measured(df: DataFrame) -> int:
    """Bytes of the values of ``df``, texts by their length and 8 for any other, and 8 for each row; one aggregate."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    row = df.agg(F.count(F.lit(1)).alias("rows"), *[F.coalesce(F.sum(F.octet_length(f"`{c}`")), F.lit(0)).alias(f"text{k}") for k, c in enumerate(texts)]).first()
    return row["rows"] * 8 * (1 + len(df.columns)) + sum(row[1:])


def unless_large(side: DataFrame) -> DataFrame:
    """``side`` as it is, or marked to be sorted and merged where its rows are too many to be broadcast."""
    return side.hint("merge") if measured(side) > BROADCAST_BYTES else side


def check_key_types(left: DataFrame, right: DataFrame, key: str) -> None:
    lt = left.schema[key].dataType
    rt = right.schema[key].dataType
    if lt != rt:
        from pyspark.sql.types import NumericType
        if not (isinstance(lt, NumericType) and isinstance(rt, NumericType)):
            raise TypeError(f"join key '{key}' types differ: {lt.simpleString()} vs {rt.simpleString()}")


def left_join(left: DataFrame, right: DataFrame, key: str, columns: list[str] | None = None, measure: bool = True) -> DataFrame:
    """``left ⟕ right[columns]`` on ``key``; raises on non-key name collisions.

    Only the listed right columns travel through the shuffle (explicit
    projection before the join, on top of Catalyst's own pruning).
    ``measure=False`` for a right side that is the result of a long plan.
    """
    cols = columns if columns is not None else right.columns
    if key not in cols:
        cols = [key] + [c for c in cols if c != key]
    clash = (set(cols) - {key}) & set(left.columns)
    if clash:
        raise ValueError(f"join would duplicate columns {sorted(clash)}")
    check_key_types(left, right, key)
    side = right.select(*cols)
    return left.join(unless_large(side) if measure else side, on=key, how="left")
