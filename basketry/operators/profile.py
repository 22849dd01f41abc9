"""Table profiles: rows, columns, missing cells, missing percentage, dtypes.

``profile`` is a lazy one-row DataFrame (one partial aggregate).
``observe_profile`` attaches the same counts to a DataFrame via
``DataFrame.observe`` so they are collected by whatever action consumes it
(a write), with no extra job.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def _missing_expr(df: DataFrame):
    cells = F.lit(0)
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        miss = c.isNull()
        if f.dataType.typeName() in ("double", "float"):
            miss = miss | F.isnan(c)
        cells = cells + miss.cast("bigint")
    return F.sum(cells)


def profile(df: DataFrame) -> DataFrame:
    """One row: rows, columns, missing_values, missing_percentage (2 dp)."""
    n_cols = len(df.columns)
    agg = df.agg(F.count(F.lit(1)).alias("rows"),
                 F.coalesce(_missing_expr(df), F.lit(0)).cast("bigint").alias("missing_values"))
    cells = F.greatest(F.col("rows") * n_cols, F.lit(1))
    return agg.select(
        "rows",
        F.lit(n_cols).cast("bigint").alias("columns"),
        "missing_values",
        F.round(F.col("missing_values") / cells * 100, 2).alias("missing_percentage"),
    )


def dtypes(df: DataFrame) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in df.schema.fields}


def observe_profile(df: DataFrame, name: str | None = None) -> tuple[DataFrame, Observation]:
    obs = Observation(name) if name else Observation()
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"),
                          F.coalesce(_missing_expr(df), F.lit(0)).cast("bigint").alias("missing_values"))
    return observed, obs


def profile_from_observation(obs: Observation, df: DataFrame, with_names: bool = True) -> dict:
    """Profile dict (source-system keys) from a completed observation."""
    m = obs.get
    rows, miss = int(m.get("rows", 0)), int(m.get("missing_values", 0))
    ncols = len(df.columns)
    out = {
        "rows": rows,
        "columns": ncols,
        "missing_values": miss,
        "missing_percentage": round(miss / max(rows * ncols, 1) * 100, 2),
        "dtypes": dtypes(df),
        "timestamp": _dt.datetime.now().isoformat(),
    }
    if with_names:
        out["column_names"] = list(df.columns)
    return out
