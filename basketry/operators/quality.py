"""Declarative data-quality rules, fused into one aggregate per table.

A rule set is an ordered list. Schema rules (required columns, no extra
columns, type families) are resolved on the driver from ``df.schema`` with no
job. Data rules (ranges, nulls, uniqueness) become columns of ONE aggregate
row: range and null counts in a single partial aggregate, uniqueness in
one pre-aggregated group-by for each listed column (nulls grouped together as
equal values). ``enforce`` collects that single row and
raises the first failing rule in declared order, so the same error surfaces
as with rule-by-rule evaluation. ``violations`` returns the offending rows
themselves as a DataFrame.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.operators.scalars import with_scalars
from basketry.errors import RuleViolation
from basketry.functions.semantics import missing as is_missing

# Type families accepted for an expected type name.
TYPE_FAMILIES: dict[str, tuple[type, ...]] = {
    "int": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    "int64": (T.LongType,),
    "float": (T.FloatType, T.DoubleType),
    "float64": (T.DoubleType,),
    "string": (T.StringType,),
    "datetime": (T.TimestampType, T.TimestampNTZType),
    "bool": (T.BooleanType,),
}


@dataclass
class Rule:
    kind: str                      # required | no_extra | types | range | no_nulls | unique
    columns: list[str] = field(default_factory=list)
    types: dict[str, str] = field(default_factory=dict)
    min_value: float | None = None
    max_value: float | None = None
    allow_nulls: bool = True


def required_columns(cols) -> Rule:
    return Rule("required", list(cols))


def no_extra_columns(cols) -> Rule:
    return Rule("no_extra", list(cols))


def data_types(types: dict[str, str]) -> Rule:
    return Rule("types", list(types), types=dict(types))


def numeric_range(col: str, min_value=None, max_value=None, allow_nulls: bool = True) -> Rule:
    return Rule("range", [col], min_value=min_value, max_value=max_value, allow_nulls=allow_nulls)


def no_nulls(cols=None) -> Rule:
    # None or an empty list means every column
    return Rule("no_nulls", list(cols or []))


def unique(cols) -> Rule:
    # each column is checked on its own, not as a composite key
    return Rule("unique", list(cols))


def type_matches(dtype: T.DataType, expected: str) -> bool:
    fam = TYPE_FAMILIES.get(expected)
    if fam is None:
        return dtype.simpleString() == expected
    return isinstance(dtype, fam)


# ---------------------------------------------------------------- schema --
def _check_schema_rule(df: DataFrame, rule: Rule) -> None:
    cols = list(df.columns)  # case-sensitive comparison in Python
    if rule.kind == "required":
        missing = [c for c in rule.columns if c not in cols]
        if missing:
            raise RuleViolation("required", dict.fromkeys(sorted(missing)), sorted(cols))
    elif rule.kind == "no_extra":
        extra = [c for c in cols if c not in rule.columns]
        if extra:
            raise RuleViolation("no_extra", dict.fromkeys(sorted(extra)), sorted(rule.columns))
    elif rule.kind == "types":
        bad = []
        for c, expected in rule.types.items():
            if c not in cols:
                raise RuleViolation("required", {c: None}, sorted(cols))
            dt = df.schema[c].dataType
            if not type_matches(dt, expected):
                bad.append((c, expected, dt.simpleString()))
        if bad:
            raise RuleViolation("types", {c: found for c, _, found in bad}, {c: expected for c, expected, _ in bad})


def _data_columns(df: DataFrame, rule: Rule) -> list[str]:
    cols = rule.columns if rule.columns else list(df.columns)
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise RuleViolation("required", dict.fromkeys(sorted(missing)), sorted(df.columns))
    return cols


# ------------------------------------------------------------------ data --
def _row_aggregates(df: DataFrame, rules: list[Rule]) -> tuple[list[Column], list[str]]:
    """Aggregates of the row-level rules (+ the columns needing uniqueness)."""
    aggs: list[Column] = [F.count(F.lit(1)).alias("rows")]
    seen: set[str] = {"rows"}
    uniq: list[str] = []

    def add(name: str, expr: Column):
        if name not in seen:
            seen.add(name)
            aggs.append(expr.alias(name))

    for rule in rules:
        if rule.kind in ("required", "no_extra", "types"):
            continue
        cols = _data_columns(df, rule)
        if rule.kind == "no_nulls":
            for c in cols:
                add(f"{c}__nulls", F.count_if(is_missing(c, df.schema[c].dataType)))
        elif rule.kind == "range":
            c = cols[0]
            x = F.col(c)
            if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)):
                x = F.when(F.isnan(x), None).otherwise(x)
            add(f"{c}__nulls", F.count_if(x.isNull()))
            add(f"{c}__n", F.count(x))
            if rule.min_value is not None:
                add(bound_name(c, "below", rule.min_value), F.count_if(x < rule.min_value))
            if rule.max_value is not None:
                add(bound_name(c, "above", rule.max_value), F.count_if(x > rule.max_value))
            add(f"{c}__min", F.min(x).cast("double"))
            add(f"{c}__max", F.max(x).cast("double"))
        elif rule.kind == "unique":
            uniq += [c for c in cols if c not in uniq]
    return aggs, uniq


def bound_name(column: str, side: str, bound) -> str:
    """Metric of one bound: two rules on a column with different bounds are two metrics."""
    return f"{column}__{side}_{bound!r}".replace(".", "p").replace("-", "m")


def observe_rules(df: DataFrame, rules: list[Rule]):
    """Attach the row-level rule counts to ``df`` (no extra job).

    Returns ``(observed_df, observation)``; after the action that consumes
    ``observed_df`` (a write), ``evaluate(df, rules, observation.get)``
    raises like ``enforce``. Uniqueness needs a shuffle and cannot be
    observed: such rules must be satisfied by construction or checked apart.
    """
    from pyspark.sql import Observation

    aggs, uniq = _row_aggregates(df, rules)
    if uniq:
        raise ValueError(f"uniqueness of {uniq} cannot be observed on a write")
    obs = Observation()
    return df.observe(obs, *aggs), obs


def rule_metrics(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row holding every count the data rules need.

    Columns: ``rows``; per null-checked column ``{c}__nulls``; per range
    rule ``{c}__n``, ``{c}__min``, ``{c}__max`` and for each bound
    ``{c}__below_{bound}`` / ``{c}__above_{bound}``; per unique column ``{c}__dups`` (rows beyond the first
    of each value, NULLs equal).
    """
    aggs, uniq = _row_aggregates(df, rules)
    row = df.agg(*aggs)
    if uniq:
        row = with_scalars(row, duplicate_counts(df, uniq))
    return row


def duplicate_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row, ``{c}__dups`` per column: rows beyond the first of each value.

    Each column is grouped alone in its own type, reading only that column; a
    value that a third of the rows hold collapses map-side.
    """
    def extra(c: str) -> DataFrame:
        counted = df.groupBy(c).agg(F.count(F.lit(1)).alias("n"))
        return counted.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias(f"{c}__dups"))

    return with_scalars(*map(extra, cols))


def _pct(n: int, total: int) -> float:
    return round(n / total * 100, 2) if total else 0.0


def evaluate(df: DataFrame, rules: list[Rule], metrics: dict) -> None:
    """Raise the first failing rule, in declared order, from a metrics row."""
    total = metrics["rows"]
    for rule in rules:
        if rule.kind in ("required", "no_extra", "types"):
            _check_schema_rule(df, rule)
            continue
        cols = _data_columns(df, rule)
        if rule.kind == "no_nulls":
            bad = [(c, metrics[f"{c}__nulls"], _pct(metrics[f"{c}__nulls"], total))
                   for c in cols if metrics[f"{c}__nulls"] > 0]
            if bad:
                raise RuleViolation("no_nulls", {c: (n, share) for c, n, share in bad}, "no nulls (count, percent)")
        elif rule.kind == "range":
            c = cols[0]
            nulls = metrics[f"{c}__nulls"]
            if not rule.allow_nulls and nulls > 0:
                raise RuleViolation("no_nulls", {c: (nulls, _pct(nulls, total))}, "no nulls (count, percent)")
            if metrics[f"{c}__n"] == 0:
                continue  # nothing to check (the source warns and passes)
            for side, bound in (("below", rule.min_value), ("above", rule.max_value)):
                n = 0 if bound is None else metrics[bound_name(c, side, bound)]
                if n > 0:
                    raise RuleViolation("range", {c: {"outside": n, "low": metrics[f"{c}__min"], "high": metrics[f"{c}__max"]}},
                                        (rule.min_value, rule.max_value))
        elif rule.kind == "unique":
            bad = [c for c in cols if metrics[f"{c}__dups"] > 0]
            if bad:
                raise RuleViolation("unique", {c: metrics[f"{c}__dups"] for c in bad}, "one row for each value")


def enforce(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Validate ``df`` against ``rules`` with at most one Spark job; return df.

    Schema rules that precede every data rule fail before any job runs.
    """
    for rule in rules:
        if rule.kind not in ("required", "no_extra", "types"):
            break
        _check_schema_rule(df, rule)
    if any(r.kind not in ("required", "no_extra", "types") for r in rules):
        metrics = rule_metrics(df, rules).first().asDict()
        evaluate(df, rules, metrics)
    return df


def violations(df: DataFrame, rule: Rule) -> DataFrame:
    """The offending rows of one row-level rule (range or null rule)."""
    cols = _data_columns(df, rule)
    if rule.kind == "no_nulls":
        cond = F.lit(False)
        for c in cols:
            cond = cond | is_missing(c, df.schema[c].dataType)
        return df.where(cond)
    if rule.kind == "range":
        x = F.col(cols[0])
        cond = F.lit(False)
        if rule.min_value is not None:
            cond = cond | (x < rule.min_value)
        if rule.max_value is not None:
            cond = cond | (x > rule.max_value)
        if not rule.allow_nulls:
            cond = cond | x.isNull()
        return df.where(F.coalesce(cond, F.lit(False)))
    raise ValueError(f"rule kind {rule.kind} has no row-level form")
