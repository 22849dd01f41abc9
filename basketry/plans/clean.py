"""Table cleaners: null handling -> keep-last dedup -> type coercion -> checks.

The step order is observable and kept: means include duplicate rows (fills
run before dedup), and text in a zero-filled column becomes NULL only at the
later coercion step and then stays NULL.

``check``:
  * ``True``  — eager: key-null check and fill invariant before cleaning, then
    the cleaned plan is written once to the shared scratch folder with the
    table's rule set observed on that write, and the written rows are returned;
  * ``False`` — build the plan only (which takes one aggregate for the layouts
    of dates and one for the repeated keys); the batch run validates the
    written output instead of re-running the plan for the checks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.errors import RuleViolation
from basketry.functions.coerce import coerce_columns
from basketry.operators.datetimes import coerce_datetimes, infer_layouts
from basketry.functions.semantics import missing
from basketry.operators import quality as Q
from basketry.operators.dedup import SEQ, keep_last_of_few
from basketry.operators.nulls import NullStrategy, assert_fill_invariant, fill_nulls, fill_report
from basketry.session import scratch_dir

# ----------------------------------------------------------- fixed values --
ORDERS_KEYS = ["order_id", "customer_id", "order_date"]
ORDERS_FILL = {
    "subtotal": NullStrategy.FILL_MEAN,
    "total_amount": NullStrategy.FILL_MEAN,
    "discount_percent": NullStrategy.FILL_ZERO,
    "shipping_cost": NullStrategy.FILL_ZERO,
    "tax_amount": NullStrategy.FILL_ZERO,
    "notes": NullStrategy.FILL_STRING,
    "promotion_id": NullStrategy.FILL_ZERO,
}
ORDERS_IDS = ["order_id", "customer_id", "promotion_id"]
ORDERS_NUMERIC = ["subtotal", "discount_percent", "shipping_cost", "tax_amount", "total_amount"]
ORDERS_DATES = ["order_date"]
ORDERS_REQUIRED = ["order_id", "customer_id", "order_date", "subtotal", "total_amount"]
ORDERS_RULES = [
    Q.required_columns(ORDERS_REQUIRED),
    Q.data_types({"order_id": "int64", "customer_id": "int64", "subtotal": "float",
                  "total_amount": "float"}),
    Q.numeric_range("subtotal", min_value=0),
    Q.numeric_range("total_amount", min_value=0),
    Q.numeric_range("discount_percent", min_value=0, max_value=100),
    Q.numeric_range("shipping_cost", min_value=0),
    Q.numeric_range("tax_amount", min_value=0),
    Q.unique(["order_id"]),
]

INVENTORY_KEYS = ["inventory_id", "product_id", "warehouse_id"]
INVENTORY_FILL = {
    "quantity": NullStrategy.FILL_ZERO,
    "min_stock_level": NullStrategy.FILL_ZERO,
    "max_stock_level": NullStrategy.FILL_ZERO,
}
INVENTORY_NUMERIC = ["quantity", "min_stock_level", "max_stock_level"]
INVENTORY_DATES = ["last_restock_date"]
INVENTORY_REQUIRED = ["inventory_id", "product_id", "warehouse_id", "quantity",
                      "min_stock_level", "max_stock_level"]
INVENTORY_RULES = [
    Q.required_columns(INVENTORY_REQUIRED),
    Q.numeric_range("quantity", min_value=0),
    Q.numeric_range("min_stock_level", min_value=0),
    Q.numeric_range("max_stock_level", min_value=0),
    Q.unique(["inventory_id"]),
]

REVIEWS_KEYS = ["review_id", "product_id", "customer_id", "rating", "created_at"]
REVIEWS_FILL = {"helpful_votes": NullStrategy.FILL_ZERO}
REVIEWS_NUMERIC = ["rating", "helpful_votes"]
REVIEWS_DATES = ["created_at"]
REVIEWS_REQUIRED = ["review_id", "product_id", "customer_id", "rating", "created_at"]
REVIEWS_RULES = [
    Q.required_columns(REVIEWS_REQUIRED),
    Q.numeric_range("rating", min_value=1, max_value=5),
    Q.numeric_range("helpful_votes", min_value=0),
    Q.unique(["review_id"]),
]


# ------------------------------------------------------------- operators --
def recalc_total(df: DataFrame) -> DataFrame:
    """Fill a missing total_amount from its parts where subtotal is present.

    total = subtotal + shipping + tax - subtotal * discount / 100, missing
    parts counting as 0; rows without subtotal keep a NULL total.
    """
    if "total_amount" not in df.columns:
        return df

    def part(c):
        return F.coalesce(F.col(c), F.lit(0.0)) if c in df.columns else F.lit(0.0)

    sub = part("subtotal")
    recomputed = sub + part("shipping_cost") + part("tax_amount") - sub * part("discount_percent") / 100
    has_sub = F.col("subtotal").isNotNull() if "subtotal" in df.columns else F.lit(False)
    total = F.when(F.col("total_amount").isNull() & has_sub, recomputed).otherwise(F.col("total_amount"))
    return df.withColumn("total_amount", total)


def precheck(df: DataFrame, keys: list[str], fill: dict) -> None:
    """Key-null rule + fill invariant from ONE aggregate over the raw table.

    The key-null counts, the per-column null counts and the mean statistics
    are plain aggregates computed in a single pass (median/mode statistics,
    if any, add their own bounded passes); the result is a handful of rows.
    """
    missing_keys = [c for c in keys if c not in df.columns]
    if missing_keys:
        raise RuleViolation("required", dict.fromkeys(sorted(missing_keys)), sorted(df.columns))
    present = {c: s for c, s in fill.items() if c in df.columns}
    key_aggs = {"rows": F.count(F.lit(1))}
    key_aggs.update({f"{k}__nulls": F.count_if(missing(k, df.schema[k].dataType)) for k in keys})
    if not present:
        Q.enforce(df, [Q.no_nulls(keys)])
        return
    rows = fill_report(df, present, extra=key_aggs).collect()
    Q.evaluate(df, [Q.no_nulls(keys)], rows[0].asDict())
    assert_fill_invariant(rows)


def _post_clean(rules):
    """The rule set as checked after keep-last: uniqueness of the dedup key
    holds by construction and is not re-counted."""
    return [r for r in rules if r.kind != "unique"]


def _checked(df: DataFrame, rules) -> DataFrame:
    """``df`` written once with its rules observed on the write; raises, or returns the written rows."""
    rules = _post_clean(rules)
    observed, obs = Q.observe_rules(df, rules)
    path = scratch_dir(df.sparkSession, "checked")
    observed.write.parquet(path)
    Q.evaluate(df, rules, obs.get)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _require_order(df: DataFrame, order: str) -> None:
    if order not in df.columns:
        raise ValueError(
            f"keep-last dedup needs an arrival-order column '{order}': read the source with "
            "basketry.sources.csv.read_csv (which attaches it) or pass order=<column>")


def _clean(df: DataFrame, *, keys, fill, key_col, ids, numeric, dates, rules,
           check: bool, order: str) -> DataFrame:
    _require_order(df, order)
    if check:
        precheck(df, keys, fill)
    layouts = infer_layouts(df, dates, order)
    out = fill_nulls(df, fill)
    out = keep_last_of_few(out, key_col, order).drop(order)
    out = coerce_columns(out, numeric=numeric, ids=ids)
    # dates in the column's own layout, or in an ISO one
    return coerce_datetimes(out, dates, layouts=layouts, iso_too=True)


def clean_orders(df: DataFrame, check: bool = True, order: str = SEQ) -> DataFrame:
    out = _clean(df, keys=ORDERS_KEYS, fill=ORDERS_FILL, key_col="order_id", ids=ORDERS_IDS,
                 numeric=ORDERS_NUMERIC, dates=ORDERS_DATES, rules=ORDERS_RULES,
                 check=check, order=order)
    out = recalc_total(out)
    return _checked(out, ORDERS_RULES) if check else out


def clean_inventory(df: DataFrame, check: bool = True, order: str = SEQ) -> DataFrame:
    out = _clean(df, keys=INVENTORY_KEYS, fill=INVENTORY_FILL, key_col="inventory_id", ids=[],
                 numeric=INVENTORY_NUMERIC, dates=INVENTORY_DATES, rules=INVENTORY_RULES,
                 check=check, order=order)
    return _checked(out, INVENTORY_RULES) if check else out


def clean_reviews(df: DataFrame, check: bool = True, order: str = SEQ) -> DataFrame:
    out = _clean(df, keys=REVIEWS_KEYS, fill=REVIEWS_FILL, key_col="review_id", ids=[],
                 numeric=REVIEWS_NUMERIC, dates=REVIEWS_DATES, rules=REVIEWS_RULES,
                 check=check, order=order)
    return _checked(out, REVIEWS_RULES) if check else out
