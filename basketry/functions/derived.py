"""Derived business columns (calendar periods, flags, ratios)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from basketry.functions.semantics import col_, false_if_null, nan_to_null, safe_div

# Fixed values of the source system.
HIGH_DISCOUNT_PERCENT = 20
POSITIVE_RATING = 4
NEGATIVE_RATING = 2
IN_PROGRESS_STATUSES = ("pending", "processing", "shipped")
CANCELLED_STATUS = "cancelled"
DELIVERED_STATUS = "delivered"
FILL_STRING_VALUE = "Sin Especificar"


def month_start(ts) -> Column:
    """Calendar month as the DATE of its first day."""
    return F.trunc(col_(ts), "MM")


def week_start(ts) -> Column:
    """Monday-to-Sunday week as the DATE of its Monday."""
    return F.trunc(col_(ts), "WEEK")


def month_text(d) -> Column:
    return F.date_format(col_(d), "yyyy-MM")


def week_text(d) -> Column:
    d = col_(d)
    return F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit("/"),
                    F.date_format(F.date_add(d, 6), "yyyy-MM-dd"))


def used_promotion(promotion_id="promotion_id") -> Column:
    # 0 marks "no promotion" after the zero fill; a missing id compares unequal.
    return F.coalesce(col_(promotion_id) != 0, F.lit(True))


def is_free_shipping(shipping="shipping_cost") -> Column:
    return F.coalesce(col_(shipping), F.lit(0)) == 0


def is_high_discount(discount="discount_percent") -> Column:
    return F.coalesce(col_(discount), F.lit(0)) >= HIGH_DISCOUNT_PERCENT


def avg_item_price(total="total_amount", items="items_count") -> Column:
    # items 0 or missing, or total missing -> 0.0
    return F.coalesce(safe_div(total, items), F.lit(0.0))


def is_low_stock(qty="quantity", min_level="min_stock_level") -> Column:
    return false_if_null(nan_to_null(qty) <= nan_to_null(min_level))


def is_overstock(qty="quantity", max_level="max_stock_level") -> Column:
    return false_if_null(nan_to_null(qty) >= nan_to_null(max_level))


def stock_gap(qty="quantity", min_level="min_stock_level") -> Column:
    """max(min - qty, 0); a missing operand stays missing (clip keeps NaN)."""
    gap = col_(min_level) - col_(qty)
    return F.when(gap < 0, F.lit(0)).otherwise(gap)


def comment_length(comment="comment") -> Column:
    return F.length(F.coalesce(col_(comment), F.lit(""))).cast("bigint")


def is_positive(rating="rating") -> Column:
    return false_if_null(nan_to_null(rating) >= POSITIVE_RATING)


def is_negative(rating="rating") -> Column:
    return false_if_null(nan_to_null(rating) <= NEGATIVE_RATING)


def status_in(status, values) -> Column:
    return false_if_null(F.lower(col_(status)).isin(list(values)))
