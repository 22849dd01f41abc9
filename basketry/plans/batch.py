"""The batch run: extract -> clean -> enrich -> metrics -> load.

Shape of the Spark jobs:

1. input checks: ONE aggregate per raw fact table (key-null rule, fill
   invariant, mean statistics) and ONE rule job per dimension table (the
   guards of every join reading it), run concurrently;
2. each cleaned + enriched plan is written ONCE as Parquet (processed zone);
   the load profile and the cleaned table's range/null rules are observed on
   that same write (``DataFrame.observe``: no extra job);
3. every metric is computed from the written enriched Parquet as soon as its
   table is written (and the input checks passed), written as Parquet, and
   its CSV is rendered from the written Parquet (no recompute). The four order
   ratios come from one pass.

All tables are written under the run's own folder, the ingested raw tables too.
Only when every check and write has succeeded does one switch publish them
(``plans.publish``); a run that fails or is killed leaves readers on the version
before.

Uniqueness of the dedup key is guaranteed by keep-last and is not re-checked
on the written tables (an enrichment join may legitimately fan rows out).
"""

from __future__ import annotations

import datetime as _dt
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from basketry.operators import metrics as M
from basketry.operators import quality as Q
from basketry.plans import clean as C
from basketry.plans import enrich as EN
from basketry.plans import publish as P
from basketry.plans.enrich import enrich_inventory, enrich_orders, enrich_reviews
from basketry.sources.sinks import write_csv, write_parquet, written_tables_size

# Metric tables with a bounded row count (top-N, months, statuses, one row):
# written as a single part file.
DEDUP_TABLES = ("orders", "inventory", "reviews")

BOUNDED_METRICS = {
    "top_spenders", "average_ticket", "top_products", "monthly_sales", "promotion_usage_rate",
    "status_funnel", "cancellation_rate", "delivery_rate", "backlog_in_progress",
    "inventory_health", "low_stock_items", "reviews_overview", "reviews_by_product",
    "reviews_monthly",
}


def in_parallel(tasks, max_workers: int = 8) -> list:
    """Run independent driver-side actions concurrently (Spark runs concurrent
    jobs from several threads); re-raises the first failure in task order."""
    tasks = list(tasks)
    if len(tasks) <= 1:
        return [t() for t in tasks]
    with ThreadPoolExecutor(max_workers=min(max_workers, len(tasks))) as pool:
        futures = [pool.submit(t) for t in tasks]
        return [f.result() for f in futures]


def enforce_all(df: DataFrame, rule_sets) -> None:
    """Several rule lists on one table from ONE metrics job, each raised in order."""
    rules = [r for rs in rule_sets for r in rs]
    for r in rules:
        if r.kind in ("required", "no_extra", "types"):
            Q._check_schema_rule(df, r)
    if any(r.kind not in ("required", "no_extra", "types") for r in rules):
        metrics = Q.rule_metrics(df, rules).first().asDict()
        for rs in rule_sets:
            Q.evaluate(df, rs, metrics)


def input_checks(tables: dict[str, DataFrame]) -> list:
    """Every check on the inputs as independent actions (run concurrently).

    Facts: key nulls + fill invariant (one job each). Dimensions: the guards
    of every enrichment join that reads them, fused into one job per table.
    """
    t = tables
    return [
        lambda: C.precheck(t["orders"], C.ORDERS_KEYS, C.ORDERS_FILL),
        lambda: C.precheck(t["inventory"], C.INVENTORY_KEYS, C.INVENTORY_FILL),
        lambda: C.precheck(t["reviews"], C.REVIEWS_KEYS, C.REVIEWS_FILL),
        lambda: enforce_all(t["customers"], [EN.CUSTOMER_RULES, EN.REVIEW_CUSTOMER_RULES]),
        lambda: enforce_all(t["promotions"], [EN.PROMOTION_RULES]),
        lambda: enforce_all(t["products"], [EN.INVENTORY_PRODUCT_RULES, EN.REVIEW_PRODUCT_RULES]),
        lambda: enforce_all(t["warehouses"], [EN.WAREHOUSE_RULES]),
    ]


def clean_and_enrich(tables: dict[str, DataFrame], checks: str = "deferred",
                     run_input_checks: bool = True) -> dict[str, DataFrame]:
    """Lazy enriched plans for orders, inventory and reviews.

    ``deferred``: the input checks (a few one-row jobs) run concurrently —
    here, or alongside the writes when the caller schedules them itself
    (``run_input_checks=False``); the cleaned tables' rule sets are then
    observed on their write. ``eager``: each cleaner and enricher validates
    as it goes.
    """
    eager = checks == "eager"
    t = tables
    if not eager and run_input_checks:
        in_parallel(input_checks(t))
    cleaners = [lambda: C.clean_orders(t["orders"], check=eager), lambda: C.clean_inventory(t["inventory"], check=eager),
                lambda: C.clean_reviews(t["reviews"], check=eager)]
    # eager checks raise in the tables' order
    co, ci, cr = [clean() for clean in cleaners] if eager else in_parallel(cleaners)
    enrichers = [lambda: enrich_orders(co, t["customers"], t["promotions"], t["order_items"], check=eager),
                 lambda: enrich_inventory(ci, t["products"], t["warehouses"], check=eager),
                 lambda: enrich_reviews(cr, t["products"], t["customers"], check=eager)]
    # each measures the dimensions that it joins
    return dict(zip(("orders", "inventory", "reviews"), [enrich() for enrich in enrichers] if eager else in_parallel(enrichers)))


def metric_builders(eo: DataFrame, ei: DataFrame, er: DataFrame,
                    order_items: DataFrame, products: DataFrame) -> dict:
    """The sixteen metric tables of a run, as zero-argument builders.

    Building is deferred so that metrics whose construction runs a job (the
    top-spenders checkpoint) build concurrently with the other writes.
    """
    return {
        "top_spenders": lambda: M.top_spenders(eo, M.TOP_SPENDERS_N, M.TOP_SPENDERS_PERCENTILE),
        "recurring_customers": lambda: M.recurring_customers(eo, M.RECURRING_MIN_ORDERS),
        "average_ticket": lambda: M.average_ticket(eo),
        "top_products": lambda: M.top_products_by_quantity(order_items, products, M.TOP_PRODUCTS_N),
        "monthly_sales": lambda: M.monthly_sales(eo),
        "promotion_usage_rate": lambda: M.promotion_usage_rate(eo),
        "status_funnel": lambda: M.status_funnel(eo),
        "cancellation_rate": lambda: M.cancellation_rate(eo),
        "delivery_rate": lambda: M.delivery_rate(eo),
        "backlog_in_progress": lambda: M.in_progress_backlog(eo),
        "inventory_health": lambda: M.stock_health_summary(ei),
        "low_stock_items": lambda: M.low_stock_items(ei, M.LOW_STOCK_ITEMS_N),
        "warehouse_utilization": lambda: M.warehouse_utilization(ei),
        "reviews_overview": lambda: M.rating_overview(er),
        "reviews_by_product": lambda: M.rating_by_product(er, M.MIN_REVIEWS_FOR_PRODUCT,
                                                          M.TOP_REVIEWED_PRODUCTS_N),
        "reviews_monthly": lambda: M.monthly_review_volume(er),
    }


METRIC_SOURCE = {
    "top_spenders": "orders", "recurring_customers": "orders", "average_ticket": "orders",
    "top_products": None, "monthly_sales": "orders", "promotion_usage_rate": "orders",
    "status_funnel": "orders", "cancellation_rate": "orders", "delivery_rate": "orders",
    "backlog_in_progress": "orders", "inventory_health": "inventory", "low_stock_items": "inventory",
    "warehouse_utilization": "inventory", "reviews_overview": "reviews",
    "reviews_by_product": "reviews", "reviews_monthly": "reviews",
}


ORDER_RATES = ("average_ticket", "promotion_usage_rate", "cancellation_rate", "delivery_rate")


def run_folder(out_dir: str, run_id: str) -> str:
    """Where a run writes until it is published."""
    return f"{out_dir.rstrip('/')}/_runs/{run_id}"


def run_batch(spark: SparkSession, tables: dict[str, DataFrame], out_dir: str,
              formats=("parquet", "csv"), checks: str = "deferred",
              run_id: str | None = None, csv_compression: str | None = None) -> DataFrame:
    """Run the whole batch; returns the run-metrics table (also appended to disk).

    Run metrics: one row per step (``check`` / ``enrich`` / ``aggregate`` /
    ``load_csv``: rows and seconds) and one ``files`` row per written table
    (``rows`` holds the part-file count, ``seconds`` the size in MB).

    Layout of a version (``publish.version``, ``publish.read_table``):
    ``processed/parquet/{t}_enriched``, ``processed/csv/{t}_enriched``,
    ``output/{fmt}/{metric}``; beside the versions, ``run_metrics``. The CSV of
    the enriched tables, which grows with the input, is written plain or by
    ``csv_compression``; the metrics' CSV is plain.
    """
    run_id = run_id or uuid.uuid4().hex[:12]
    published = out_dir.rstrip("/")
    out = run_folder(published, run_id)
    log: list[tuple] = []

    def note(stage, table, rows, started):
        now = _dt.datetime.now()
        log.append((run_id, stage, table, int(rows), round((now - started).total_seconds(), 3), now))

    eager = checks == "eager"
    enriched = clean_and_enrich(tables, checks, run_input_checks=False)
    rules = {"orders": C.ORDERS_RULES, "inventory": C.INVENTORY_RULES, "reviews": C.REVIEWS_RULES}

    def check_inputs() -> None:
        started = _dt.datetime.now()
        if not eager:
            in_parallel(input_checks(tables))
        note("check", "inputs", 0, started)

    def materialise(name: str, df: DataFrame) -> DataFrame:
        started = _dt.datetime.now()
        path = f"{out}/processed/parquet/{name}_enriched"
        obs = None
        if not eager:
            # the cleaned table's range/null rules ride on its single write
            df, obs = Q.observe_rules(df, C._post_clean(rules[name]))
        prof = write_parquet(df, path, compression="zstd")
        if obs is not None:
            Q.evaluate(df, C._post_clean(rules[name]), obs.get)
        note("enrich", f"{name}_enriched", prof["rows"], started)
        back = spark.read.parquet(path)
        if "csv" in formats:
            started = _dt.datetime.now()
            write_csv(back, f"{out}/processed/csv/{name}_enriched", profile=False, compression=csv_compression)
            note("load_csv", f"{name}_enriched", prof["rows"], started)
        return back

    def publish(name: str, build) -> None:
        started = _dt.datetime.now()
        single = name in BOUNDED_METRICS
        ppath = f"{out}/output/parquet/{name}"
        prof = write_parquet(build(), ppath, single_file=single)
        note("aggregate", name, prof["rows"], started)
        if "csv" in formats:
            started = _dt.datetime.now()
            write_csv(spark.read.parquet(ppath), f"{out}/output/csv/{name}", single_file=single,
                      profile=False)
            note("load_csv", name, prof["rows"], started)

    # Independent Spark jobs run side by side; a metric starts as soon as the
    # enriched table it reads is written and the input checks have passed.
    with ThreadPoolExecutor(max_workers=8) as pool:
        checked = pool.submit(check_inputs)
        written = {n: pool.submit(materialise, n, df) for n, df in enriched.items()}

        def metric(name: str):
            checked.result()
            src = METRIC_SOURCE[name]
            eo, ei, er = (written[n].result() if src == n else None
                          for n in ("orders", "inventory", "reviews"))
            if name in ORDER_RATES:
                build = lambda: rates.result().select(name)
            else:
                build = metric_builders(eo, ei, er, tables["order_items"], tables["products"])[name]
            publish(name, build)

        def order_rates() -> DataFrame:
            checked.result()
            path = f"{out}/work/order_rates"
            M.order_rates(written["orders"].result()).write.parquet(path)
            return spark.read.parquet(path)

        rates = pool.submit(order_rates)

        # metrics reading the same table start in the order their table is written
        order = sorted(METRIC_SOURCE, key=lambda n: (METRIC_SOURCE[n] is not None, n == "top_spenders"))
        pending = [pool.submit(metric, n) for n in order]
        try:
            for f in [checked, *written.values(), *pending]:
                f.result()
        except BaseException:
            for f in [rates, *pending]:
                f.cancel()
            pool.shutdown(wait=True)
            P.drop(spark, out)
            raise
    # post-load profile of every written table: one file-listing job
    sizes = {r["target"]: (r["files"], r["file_size_mb"])
             for r in written_tables_size(spark, out).where("target not like '%/work/%' and target not like '%/raw/%'").collect()}
    for target, (files, mb) in sorted(sizes.items()):
        rel = target.split(f"{out}/", 1)[-1] if f"{out}/" in target else target
        log.append((run_id, "files", rel, int(files), float(mb), _dt.datetime.now()))

    metrics_df = spark.createDataFrame(
        log, "run_id string, stage string, table string, rows bigint, seconds double, "
             "recorded_at timestamp")
    P.drop(spark, f"{out}/work")
    P.publish(spark, published, run_id, out)
    metrics_df.coalesce(1).write.mode("append").parquet(f"{published}/run_metrics")
    return metrics_df


def export_sources(tables: dict[str, DataFrame], source_dir: str, files_per_table: int | None = None,
                   compression: str | None = None) -> None:
    """Write the eight logical tables as a CSV raw zone ({stem}.csv/part-*).

    Rows of a table with an arrival order (``_seq``) keep it, so keep-last
    sees the same one on every export: ``files_per_table`` parts of ranges
    (default: the default parallelism, or the partitions if they are more, so
    that a part's size stays bounded). Of the others nothing depends on the
    order: without ``files_per_table`` their partitions are written as they are.
    """
    from basketry.schemas import SOURCE_TABLES

    root = source_dir.rstrip("/")

    def one(name: str, df: DataFrame) -> None:
        if "_seq" in df.columns:
            n = files_per_table or max(df.sparkSession.sparkContext.defaultParallelism, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
            df = df.repartitionByRange(n, "_seq").sortWithinPartitions("_seq").drop("_seq")
        elif files_per_table:
            key = df.columns[0]
            df = df.repartitionByRange(files_per_table, key).sortWithinPartitions(key)
        write_csv(df, f"{root}/{SOURCE_TABLES[name]}.csv", profile=False, compression=compression)

    in_parallel([lambda n=n, df=df: one(n, df) for n, df in tables.items()])


def ingest_sources(spark: SparkSession, source_dir: str, out_dir: str, sep: str = ",",
                   encoding: str = "utf-8", multi_line: bool = True) -> dict[str, DataFrame]:
    """Parse every raw CSV once into typed Parquet under ``{out_dir}/raw``."""
    from basketry.schemas import COERCED, SCHEMAS, SOURCE_TABLES
    from basketry.sources.csv import ingest_csv

    root, out = source_dir.rstrip("/"), out_dir.rstrip("/")
    names = list(SOURCE_TABLES)
    # only the tables deduplicated with keep-last need their arrival order
    frames = in_parallel([
        lambda n=n: ingest_csv(spark, f"{root}/{SOURCE_TABLES[n]}.csv", f"{out}/raw/{n}",
                               SCHEMAS[n], sep=sep, encoding=encoding, with_seq=n in DEDUP_TABLES, multi_line=multi_line,
                             coerced=COERCED.get(n, ()))
        for n in names])
    return dict(zip(names, frames))


def run_batch_from_csv(spark: SparkSession, source_dir: str, out_dir: str, *, sep: str = ",", encoding: str = "utf-8",
                       multi_line: bool = True, **kw) -> DataFrame:
    """Full run from the CSV raw zone: ingest -> clean -> enrich -> metrics -> load."""
    run_id = kw.pop("run_id", None) or uuid.uuid4().hex[:12]
    try:
        tables = ingest_sources(spark, source_dir, run_folder(out_dir, run_id), sep, encoding, multi_line)
    except BaseException:
        P.drop(spark, run_folder(out_dir, run_id))
        raise
    return run_batch(spark, tables, out_dir, run_id=run_id, **kw)
