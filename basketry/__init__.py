"""basketry — retail reporting operators on Spark.

Every operator is a ``DataFrame -> DataFrame`` function built from the public
DataFrame API, so Catalyst sees one declarative plan per query.

Sub-packages
------------
functions   column-expression builders (null/NaN-safe predicates, money sums,
            coercion, derived flags)
sources     CSV scan with pandas-compatible null tokens, sinks, driver views
operators   null fills, keep-last dedup, joins, quality rules, profiles,
            exact quantile, business metrics
plans       cleaners, enrichers, the batch run and the query registry
streaming   (no streaming surface exists in the source system; see README)
"""

from basketry.session import get_spark, scratch_dir  # noqa: F401

__all__ = ["get_spark", "scratch_dir"]
