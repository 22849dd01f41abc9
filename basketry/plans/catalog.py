"""Registered queries: ``name -> f(spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables at ``sf_dir`` through the domain views
and runs the library operators over them, whole tables, no sampling.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions.coerce import coerce_columns, coercion_report
from basketry.operators import metrics as M
from basketry.operators import quality as Q
from basketry.operators.dedup import dedup_report, keep_last
from basketry.operators.nulls import NullStrategy, fill_nulls, fill_report
from basketry.operators.profile import profile
from basketry.operators.quantile import exact_quantiles
from basketry.operators.scalars import with_scalars
from basketry.plans import clean as CL
from basketry.plans import enrich as EN
from basketry.plans import date_queries, number_queries, source_queries
from basketry.plans.clean import clean_inventory, clean_orders, clean_reviews
from basketry.plans.enrich import enrich_inventory, enrich_orders, enrich_reviews
from basketry.plans.publish import read_table
from basketry.session import scratch_dir
from basketry.schemas import COERCED, SCHEMAS
from basketry.sources.csv import ingest_csv, read_csv
from basketry.sources.sinks import write_csv, write_parquet
from basketry.sources.views import DriverViews, cached_plan

Query = Callable[[SparkSession, str], DataFrame]


# ------------------------------------------------------------ shared legs --
# With check=True the checks run (eagerly) on every call; the unchecked plans
# are built once per session and shared by the queries that read them.
def _shared(spark, sf_dir, name, check, build):
    if check:
        return build()
    return cached_plan(spark, ("plan", sf_dir.rstrip("/"), name), build)


def cleaned_orders(spark, sf_dir, check=False) -> DataFrame:
    return _shared(spark, sf_dir, "cleaned_orders", check,
                   lambda: clean_orders(DriverViews(spark, sf_dir).orders(), check=check))


def cleaned_inventory(spark, sf_dir, check=False) -> DataFrame:
    return _shared(spark, sf_dir, "cleaned_inventory", check,
                   lambda: clean_inventory(DriverViews(spark, sf_dir).inventory(), check=check))


def cleaned_reviews(spark, sf_dir, check=False) -> DataFrame:
    return _shared(spark, sf_dir, "cleaned_reviews", check,
                   lambda: clean_reviews(DriverViews(spark, sf_dir).reviews(), check=check))


def enriched_orders(spark, sf_dir, check=False) -> DataFrame:
    v = DriverViews(spark, sf_dir)
    return _shared(spark, sf_dir, "enriched_orders", check, lambda: enrich_orders(
        cleaned_orders(spark, sf_dir, check), v.customers(), v.promotions(), v.order_items(), check=check))


def enriched_inventory(spark, sf_dir, check=False) -> DataFrame:
    v = DriverViews(spark, sf_dir)
    return _shared(spark, sf_dir, "enriched_inventory", check, lambda: enrich_inventory(
        cleaned_inventory(spark, sf_dir, check), v.products(), v.warehouses(), check=check))


def enriched_reviews(spark, sf_dir, check=False) -> DataFrame:
    v = DriverViews(spark, sf_dir)
    return _shared(spark, sf_dir, "enriched_reviews", check, lambda: enrich_reviews(
        cleaned_reviews(spark, sf_dir, check), v.products(), v.customers(), check=check))


# The metric queries read enriched tables built without re-running the
# cleaning checks; the checks themselves are exercised by the clean_* and
# enrich_* queries (check=True) and by the batch run.
def _eo(s, d):
    return enriched_orders(s, d)


def _ei(s, d):
    return enriched_inventory(s, d)


def _er(s, d):
    return enriched_reviews(s, d)


def metric_queries() -> dict[str, Query]:
    return {
        # orders
        "monthly_sales": lambda s, d: M.monthly_sales(_eo(s, d)),
        "top_spenders": lambda s, d: M.top_spenders(_eo(s, d)),
        "recurring_customers": lambda s, d: M.recurring_customers(_eo(s, d)),
        "average_ticket": lambda s, d: M.average_ticket(_eo(s, d)),
        "promotion_usage_rate": lambda s, d: M.promotion_usage_rate(_eo(s, d)),
        "status_funnel": lambda s, d: M.status_funnel(_eo(s, d)),
        "cancellation_rate": lambda s, d: M.cancellation_rate(_eo(s, d)),
        "delivery_rate": lambda s, d: M.delivery_rate(_eo(s, d)),
        "backlog_in_progress": lambda s, d: M.in_progress_backlog(_eo(s, d)),
        "order_rates": lambda s, d: M.order_rates(_eo(s, d)),
        # products
        "top_products_by_quantity": lambda s, d: M.top_products_by_quantity(
            DriverViews(s, d).order_items(), DriverViews(s, d).products()),
        "top_products_by_revenue": lambda s, d: M.top_products_by_revenue(
            DriverViews(s, d).order_items(), DriverViews(s, d).products()),
        "items_per_order": lambda s, d: M.items_per_order(DriverViews(s, d).order_items()),
        # inventory
        "inventory_health": lambda s, d: M.stock_health_summary(_ei(s, d)),
        "low_stock_items": lambda s, d: M.low_stock_items(_ei(s, d)),
        "warehouse_utilization": lambda s, d: M.warehouse_utilization(_ei(s, d)),
        # reviews
        "reviews_overview": lambda s, d: M.rating_overview(_er(s, d)),
        "reviews_by_product": lambda s, d: M.rating_by_product(_er(s, d), min_reviews=M.MIN_REVIEWS_FOR_PRODUCT),
        "reviews_monthly": lambda s, d: M.monthly_review_volume(_er(s, d)),
    }


def table_queries() -> dict[str, Query]:
    return {
        "clean_orders": lambda s, d: cleaned_orders(s, d, check=True),
        "clean_inventory": lambda s, d: cleaned_inventory(s, d, check=True),
        "clean_reviews": lambda s, d: cleaned_reviews(s, d, check=True),
        "enrich_orders": lambda s, d: enriched_orders(s, d, check=True),
        "enrich_inventory": lambda s, d: enriched_inventory(s, d, check=True),
        "enrich_reviews": lambda s, d: enriched_reviews(s, d, check=True),
    }


# ------------------------------------------------- operator-level queries --
FILL_PLANS = {
    "fill_drop": {"total_amount": NullStrategy.DROP},
    "fill_zero": {"discount_percent": NullStrategy.FILL_ZERO, "shipping_cost": NullStrategy.FILL_ZERO,
                  "tax_amount": NullStrategy.FILL_ZERO, "promotion_id": NullStrategy.FILL_ZERO},
    "fill_string": {"notes": NullStrategy.FILL_STRING},
    "fill_mean": {"subtotal": NullStrategy.FILL_MEAN, "total_amount": NullStrategy.FILL_MEAN},
    "fill_median": {"subtotal": NullStrategy.FILL_MEDIAN, "total_amount": NullStrategy.FILL_MEDIAN},
    "fill_mode": {"notes": NullStrategy.FILL_MODE, "shipping_cost": NullStrategy.FILL_MODE},
}

ROUNDTRIP_SCHEMA = T.StructType([
    T.StructField("order_id", T.LongType()), T.StructField("customer_id", T.LongType()),
    T.StructField("order_date", T.TimestampNTZType()), T.StructField("promotion_id", T.LongType()),
    T.StructField("subtotal", T.DoubleType()), T.StructField("discount_percent", T.DoubleType()),
    T.StructField("shipping_cost", T.DoubleType()), T.StructField("tax_amount", T.DoubleType()),
    T.StructField("total_amount", T.DoubleType()), T.StructField("status", T.StringType()),
    T.StructField("notes", T.StringType()),
])

QUANTILES = (("total_amount_p10", 0.1), ("total_amount_p50", 0.5), ("total_amount_p80", 0.8),
             ("total_amount_p99", 0.99))


def _raw_orders(s, d):
    return DriverViews(s, d).orders().drop("_seq")


def _fill_query(plan):
    return lambda s, d: fill_nulls(_raw_orders(s, d), plan)


def _csv_roundtrip(s, d):
    path = scratch_dir(s, "csv_roundtrip") + "/orders.csv"
    write_csv(_raw_orders(s, d), path)
    return read_csv(s, path, ROUNDTRIP_SCHEMA, with_seq=False)


def _parquet_roundtrip(s, d):
    path = scratch_dir(s, "parquet_roundtrip") + "/orders_enriched"
    write_parquet(enriched_orders(s, d), path)
    return s.read.parquet(path)


def _quantiles(s, d):
    o = _raw_orders(s, d)
    items = DriverViews(s, d).order_items()
    return with_scalars(exact_quantiles(o, {name: ("total_amount", p) for name, p in QUANTILES}),
                        exact_quantiles(items, {"quantity_p50": ("quantity", 0.5)}))


def _dim_checks(s, d):
    v = DriverViews(s, d)
    cust = Q.rule_metrics(v.customers(), EN.CUSTOMER_RULES)
    promo = Q.rule_metrics(v.promotions(), EN.PROMOTION_RULES)
    prod = Q.rule_metrics(v.products(), EN.REVIEW_PRODUCT_RULES)
    wh = Q.rule_metrics(v.warehouses(), EN.WAREHOUSE_RULES)

    def tag(df, prefix):
        return df.select(*[F.col(c).alias(f"{prefix}__{c}") for c in df.columns])
    return with_scalars(tag(cust, "customers"), tag(promo, "promotions"), tag(prod, "products"),
                        tag(wh, "warehouses"))


def batch_output_dir(s, d) -> str:
    """Run the whole batch over ``d``'s tables, from a CSV raw zone exported
    from them; returns the output folder. Each call is a run of its own.

    The raw zone and the enriched tables' CSV are gzip parts: as plain text
    they would be half of all that a run writes. Each driver table's view is
    read once, by the export, so none is staged. The views' arrival order is the
    key that keep-last goes by: it puts no row of a key before another, so only
    the rows of a part are sorted by it, for their compression."""
    from basketry.plans.batch import export_sources, run_batch_from_csv

    src, out = scratch_dir(s, "raw-zone"), scratch_dir(s, "batch-out")
    views = DriverViews(s, d, staged=False).all()
    export_sources({n: v.sortWithinPartitions("_seq").drop("_seq") if "_seq" in v.columns else v for n, v in views.items()}, src, compression="gzip")
    run_batch_from_csv(s, src, out, csv_compression="gzip")
    return out


def _batch_output(zone: str, table: str):
    return lambda s, d: read_table(s, batch_output_dir(s, d), f"{zone}/parquet/{table}")


BATCH_OUTPUTS = {
    "batch_monthly_sales": ("output", "monthly_sales"),
    "batch_top_spenders": ("output", "top_spenders"),
    "batch_top_products": ("output", "top_products"),
    "batch_inventory_health": ("output", "inventory_health"),
    "batch_warehouse_utilization": ("output", "warehouse_utilization"),
    "batch_reviews_by_product": ("output", "reviews_by_product"),
    "batch_cancellation_rate": ("output", "cancellation_rate"),
    "batch_status_funnel": ("output", "status_funnel"),
    "batch_recurring_customers": ("output", "recurring_customers"),
    "batch_backlog_in_progress": ("output", "backlog_in_progress"),
    "batch_low_stock_items": ("output", "low_stock_items"),
    "batch_reviews_monthly": ("output", "reviews_monthly"),
    "batch_enriched_reviews": ("processed", "reviews_enriched"),
    "batch_enriched_inventory": ("processed", "inventory_enriched"),
    "batch_enriched_orders": ("processed", "orders_enriched"),
}


def _batch_scalars(s, d):
    """The one-row tables of a run, side by side."""
    out = batch_output_dir(s, d)
    return with_scalars(*[read_table(s, out, f"output/parquet/{t}") for t in ("average_ticket", "promotion_usage_rate", "delivery_rate", "reviews_overview")])


# ---------------------------------------------------------- dirty CSV zone --
def _from_csv(s, df, table, clean):
    """Write ``df`` as the table's CSV, ingest that file and clean what was read."""
    path = scratch_dir(s, "dirty-csv")
    write_csv(df, f"{path}/raw.csv", profile=False)
    return clean(ingest_csv(s, f"{path}/raw.csv", f"{path}/raw", SCHEMAS[table], coerced=COERCED[table]), check=False)


def _junk(key: str, column: str, *cases):
    """``column`` as text with (divisor of ``key``, text) put in; None keeps the number and adds a half."""
    out, text = None, F.col(column).cast("string")
    for divisor, junk in cases:
        value = F.concat(F.regexp_replace(text, r"\.0$", ""), F.lit(".5")) if junk is None else F.lit(junk)
        hit = F.col(key) % divisor == 0
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out.otherwise(text)


def dirty_queries() -> dict[str, Query]:
    return {
        "batch_dirty_orders": lambda s, d: _from_csv(s, _raw_orders(s, d).withColumns({
            "discount_percent": _junk("order_id", "discount_percent", (29, "abc")),
            "shipping_cost": _junk("order_id", "shipping_cost", (31, "12 euros"))}), "orders", clean_orders),
        "batch_dirty_inventory": lambda s, d: _from_csv(s, DriverViews(s, d).inventory().drop("_seq").withColumns({
            "quantity": _junk("inventory_id", "quantity", (11, "abc"), (13, None)),
            "min_stock_level": _junk("inventory_id", "min_stock_level", (17, None))}), "inventory", clean_inventory),
        "batch_dirty_reviews": lambda s, d: _from_csv(s, DriverViews(s, d).reviews().drop("_seq").withColumns({
            "rating": _junk("review_id", "rating", (17, "bad"), (19, "4.5")),
            "helpful_votes": _junk("review_id", "helpful_votes", (23, "many"))}), "reviews", clean_reviews),
        "csv_long_rows": _csv_long_rows,
        "check_nulls_nan": lambda s, d: Q.rule_metrics(
            _raw_orders(s, d).withColumn("subtotal", F.when(F.col("order_id") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("subtotal"))),
            [Q.no_nulls(["subtotal", "total_amount"])]),
        "check_range_split": lambda s, d: Q.rule_metrics(
            _raw_orders(s, d), [Q.numeric_range("subtotal", min_value=1000), Q.numeric_range("subtotal", max_value=100000)]),
    }


def _csv_long_rows(s, d):
    """Rows with too many fields, empty ones among them, are told from the others."""
    path = scratch_dir(s, "long-rows") + "/rows.csv"
    row = F.concat_ws(",", F.col("order_id").cast("string"), F.col("customer_id").cast("string"), "status")
    extra = F.when(F.col("order_id") % 10 == 0, ",,LOST").when(F.col("order_id") % 10 == 1, ",").otherwise("")
    (DriverViews(s, d).orders().select(F.concat(row, extra).alias("order_id,customer_id,status"))
     .write.option("header", True).option("sep", "|").option("quote", "").csv(path))
    kept, long_rows = read_csv(s, path, SCHEMAS["orders"], with_seq=False, validate=False, malformed="quarantine")
    return (kept.withColumn("is_long", F.lit(False)).unionByName(long_rows.withColumn("is_long", F.lit(True))))


RANGE_RULES = [r for r in CL.ORDERS_RULES if r.kind == "range"]
UNIQUE_COLUMNS = ["order_id", "customer_id", "status", "notes"]


def operator_queries() -> dict[str, Query]:
    q: dict[str, Query] = {name: _fill_query(plan) for name, plan in FILL_PLANS.items()}
    q.update({
        "fill_report": lambda s, d: fill_report(_raw_orders(s, d), CL.ORDERS_FILL),
        "dedup_keep_last": lambda s, d: keep_last(
            DriverViews(s, d).orders_with_duplicates(), "order_id", "_seq").drop("_seq"),
        "dedup_report": lambda s, d: dedup_report(DriverViews(s, d).orders_with_duplicates(), "order_id"),
        "coerce_numeric": lambda s, d: coerce_columns(
            DriverViews(s, d).orders_text_amounts().drop("_seq"), numeric=CL.ORDERS_NUMERIC),
        "coerce_datetime": lambda s, d: coerce_columns(
            DriverViews(s, d).orders_text_dates().drop("_seq"), dates=CL.ORDERS_DATES),
        "coercion_report": lambda s, d: coercion_report(
            DriverViews(s, d).orders_text_amounts(), numeric=CL.ORDERS_NUMERIC),
        "recalc_total": lambda s, d: clean_orders(DriverViews(s, d).orders_null_totals(), check=True),
        "clean_orders_duplicates": lambda s, d: clean_orders(
            DriverViews(s, d).orders_with_duplicates(), check=True),
        "status_funnel_null_status": lambda s, d: M.status_funnel(
            DriverViews(s, d).orders_null_status()),
        "cancellation_rate_null_status": lambda s, d: M.cancellation_rate(
            DriverViews(s, d).orders_null_status()),
        "check_keys": lambda s, d: Q.rule_metrics(_raw_orders(s, d), [Q.no_nulls(CL.ORDERS_KEYS)]),
        "check_keys_inventory": lambda s, d: Q.rule_metrics(DriverViews(s, d).inventory().drop("_seq"), [Q.no_nulls(CL.INVENTORY_KEYS)]),
        "check_keys_reviews": lambda s, d: Q.rule_metrics(DriverViews(s, d).reviews().drop("_seq"), [Q.no_nulls(CL.REVIEWS_KEYS)]),
        "fill_absent": lambda s, d: fill_nulls(_raw_orders(s, d), {
            "no_such_column": NullStrategy.FILL_ZERO, "notes": NullStrategy.FILL_STRING, "another": NullStrategy.FILL_MEAN}),
        "check_nulls": lambda s, d: Q.rule_metrics(_raw_orders(s, d), [Q.no_nulls(None)]),
        "check_range": lambda s, d: Q.rule_metrics(_raw_orders(s, d), RANGE_RULES),
        "check_unique": lambda s, d: Q.rule_metrics(
            DriverViews(s, d).orders_with_duplicates(), [Q.unique(UNIQUE_COLUMNS)]),
        "check_orders_rules": lambda s, d: Q.rule_metrics(cleaned_orders(s, d), CL.ORDERS_RULES),
        "check_inventory_rules": lambda s, d: Q.rule_metrics(cleaned_inventory(s, d), CL.INVENTORY_RULES),
        "check_reviews_rules": lambda s, d: Q.rule_metrics(cleaned_reviews(s, d), CL.REVIEWS_RULES),
        "check_dimensions": _dim_checks,
        "profile_table": lambda s, d: profile(_raw_orders(s, d)),
        "csv_roundtrip": _csv_roundtrip,
        "parquet_roundtrip": _parquet_roundtrip,
        "exact_quantiles": _quantiles,
        # joins as stand-alone operators on cleaned facts
        "join_orders_customers": lambda s, d: EN.join_customers(
            cleaned_orders(s, d), DriverViews(s, d).customers()),
        "join_orders_promotions": lambda s, d: EN.join_promotions(
            cleaned_orders(s, d), DriverViews(s, d).promotions()),
        "join_orders_items": lambda s, d: EN.join_items_count(
            cleaned_orders(s, d), DriverViews(s, d).order_items()),
        "join_inventory_products": lambda s, d: EN.join_products(
            cleaned_inventory(s, d), DriverViews(s, d).products()),
        "join_inventory_warehouses": lambda s, d: EN.join_warehouses(
            cleaned_inventory(s, d), DriverViews(s, d).warehouses()),
        "join_reviews_products": lambda s, d: EN.join_products(
            cleaned_reviews(s, d), DriverViews(s, d).products()),
        "join_reviews_customers": lambda s, d: EN.join_review_customers(
            cleaned_reviews(s, d), DriverViews(s, d).customers()),
    })
    q.update(dirty_queries())
    # the batch run end to end (CSV raw zone -> written outputs)
    q.update({name: _batch_output(zone, table) for name, (zone, table) in BATCH_OUTPUTS.items()})
    q["batch_scalars"] = _batch_scalars
    return q


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    out.update(metric_queries())
    out.update(table_queries())
    out.update(operator_queries())
    out.update(source_queries.queries())
    out.update(number_queries.queries())
    out.update(date_queries.queries())
    return out
