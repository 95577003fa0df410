"""The daily run: load, build, check."""

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from advisorbook import fixed_values as fv
from advisorbook.contracts import CUSTOMERS, INGESTED_AT, KPI_KEYS, MONEY, PRODUCTS, SNAPSHOT_DATE
from advisorbook.operators.checks import require_passed
from advisorbook.operators.incremental import watermark
from advisorbook.plans.changes import MaintainedFact, MaintainedReport
from advisorbook.plans.dimensions import dim_agent, dim_customer, dim_product
from advisorbook.plans.ingest import load_master, load_metrics, load_new_dates, load_summary, rebuild_history
from advisorbook.plans.kpis import monthly_kpis
from advisorbook.plans.performance import monthly_performance, with_agent_names
from advisorbook.plans.quality import standard_report
from advisorbook.plans.staging import (
    KPI_INPUTS,
    TIEBREAK,
    stage_customers,
    stage_latest,
    stage_products,
)
from advisorbook.session import cut_lineage
from advisorbook.sources.change_log import StagedChange, notes, recover
from advisorbook.sources.latest_table import BUCKETS, LatestTable
from advisorbook.sources.snapshots import list_snapshots
from advisorbook.sources.tables import create_database, merge_table, read_table, replace_table

RAW_HISTORY = "raw.portfolio_histories"
RAW_LATEST = "raw.portfolio_latest"
LOAD_LOG = "raw.load_log"
HEADS = "raw.snapshot_heads"
RAW_CUSTOMERS = "raw.customers"
RAW_PRODUCTS = "raw.products"
DIM_AGENT = "marts.dim_agent"
DIM_CUSTOMER = "marts.dim_customer"
DIM_PRODUCT = "marts.dim_product"
FACT = "marts.agent_monthly_kpis"
MONTH_ENTRIES = "marts.month_entries"
MONTH_TOTALS = "marts.agent_month_totals"
FACT_PRODUCTS = "marts.fact_products"
REPORT_ROWS = "marts.report_rows"
REPORT_CARRY = "marts.report_carry"
REPORT = "agent_monthly_performance"


@dataclass(frozen=True)
class Settings:
    """Where data lies and how the fact is built.

    A run loads the snapshot dates that no run has loaded; ``reload_dates`` names dates whose files
    were corrected since. Rows that a corrected file lacks leave only with ``full_refresh``.

    ``by_changes`` keeps the fact up by changed entries, over all months and whatever the order of
    loading; it does not drop entries after ``as_of``. Without it the months inside the lookback
    are recomputed.
    """

    snapshot_folder: str
    customers_csv: str
    products_csv: str
    warehouse: str
    threshold: int = fv.CORE_CUSTOMER_THRESHOLD
    lookback_days: int = fv.LOOKBACK_DAYS
    full_refresh: bool = False
    as_of: dt.date | None = None
    money: DataType = MONEY
    by_changes: bool = False
    buckets: int = BUCKETS
    reload_dates: tuple[dt.date, ...] = ()


def stage_views(spark: SparkSession) -> dict[str, DataFrame]:
    """Staging is lazy: temporary views over the raw tables and the newest entries."""
    staged = {
        "stg_portfolio": stage_latest(latest_table(spark).rows()),
        "stg_products": stage_products(spark.table(RAW_PRODUCTS)),
        "stg_customers": stage_customers(spark.table(RAW_CUSTOMERS)),
    }
    for name, df in staged.items():
        df.createOrReplaceTempView(name)
    return staged


def latest_table(spark: SparkSession, buckets: int = BUCKETS) -> LatestTable:
    return LatestTable(spark, RAW_LATEST, ["id"], INGESTED_AT, TIEBREAK, buckets)


def load_history(spark: SparkSession, settings: Settings) -> tuple[DataFrame, list[str], DataFrame]:
    """Load the dates not loaded yet, all of them on a first run or full refresh.

    Returns the rows of these dates, the dates, and the load metrics. A date counts as loaded
    once its rows have reached the newest entries.
    """
    recover(spark, LOAD_LOG)
    needed = [RAW_HISTORY, RAW_LATEST, *([FACT_PRODUCTS] if settings.by_changes else [])]
    if settings.full_refresh or not all(map(spark.catalog.tableExists, needed)):
        for table in (RAW_LATEST, LOAD_LOG, MONTH_ENTRIES, MONTH_TOTALS, FACT_PRODUCTS, REPORT_ROWS, REPORT_CARRY,
                      *([FACT] if settings.by_changes else [])):
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        metrics = rebuild_history(spark, settings.snapshot_folder, RAW_HISTORY, heads=HEADS)
        loaded = [r[0].isoformat() for r in metrics.select(SNAPSHOT_DATE).collect()]
        return read_table(spark, RAW_HISTORY), loaded, metrics
    files = list_snapshots(spark, settings.snapshot_folder)
    known = notes(spark, LOAD_LOG)
    dates = [r[0] for r in files.select(SNAPSHOT_DATE).distinct().collect()]
    dates = sorted(d for d in dates if d.isoformat() not in known or d in settings.reload_dates)
    if dates:
        load_new_dates(spark, settings.snapshot_folder, RAW_HISTORY, dates, heads=HEADS)
    history = read_table(spark, RAW_HISTORY)
    return history.filter(F.col(SNAPSHOT_DATE).isin(dates)), [d.isoformat() for d in dates], load_metrics(history, files)


def reclassified_products(spark: SparkSession, products: DataFrame) -> DataFrame | None:
    """Products whose bucket is not the one the fact was last folded with."""
    if not spark.catalog.tableExists(FACT_PRODUCTS):
        return None
    now = products.select("product_id", F.col("asset_class_bucket").alias("now"))
    both = spark.table(FACT_PRODUCTS).join(now, "product_id", "full_outer")
    return both.filter(~F.col("asset_class_bucket").eqNullSafe(F.col("now"))).select("product_id")


def build_fact(spark: SparkSession, settings: Settings, entries: DataFrame) -> None:
    """Rebuild the fact, or recompute the months inside the lookback and merge them."""
    rebuild = settings.full_refresh or not spark.catalog.tableExists(FACT)
    since = None
    if not rebuild:
        since = watermark(spark.table(FACT), "month_start_date", settings.lookback_days)
    facts = monthly_kpis(
        entries,
        spark.table(DIM_PRODUCT),
        settings.threshold,
        since,
        settings.as_of,
        settings.money,
        F.current_timestamp(),
    )
    if rebuild:
        replace_table(facts.hint("rebalance", "month_start_date"), FACT, ["month_start_date"])
    else:
        merge_table(facts, FACT, KPI_KEYS, "month_start_date")


def run_daily(spark: SparkSession, settings: Settings) -> dict:
    """Load the new files, build dimensions, fact and report, and check them.

    The newest entries, and with ``by_changes`` the fact, change together or not at all; a run after
    a failure first finishes what was staged. Fails on an empty history before anything is built, and on error-level check results
    at the end. Returns load summary, metrics, report view and check report.
    """
    for name in ("raw", "marts"):
        create_database(spark, name, f"{settings.warehouse}/{name}")
    arrived, dates, metrics = load_history(spark, settings)
    masters = {
        RAW_CUSTOMERS: load_master(spark, settings.customers_csv, RAW_CUSTOMERS, CUSTOMERS),
        RAW_PRODUCTS: load_master(spark, settings.products_csv, RAW_PRODUCTS, PRODUCTS),
    }
    products = cut_lineage(dim_product(stage_products(spark.table(RAW_PRODUCTS))), "products")
    change = StagedChange(spark, LOAD_LOG)
    feed = latest_table(spark, settings.buckets).merge(arrived, change)
    if settings.by_changes:
        maintained = MaintainedFact(
            spark, MONTH_ENTRIES, MONTH_TOTALS, FACT, settings.threshold, settings.money, F.current_timestamp()
        )
        months, facts = maintained.apply(feed, products, change, reclassified_products(spark, products))
        MaintainedReport(spark, FACT, REPORT_ROWS, REPORT_CARRY).apply(months, facts, change)
    change.commit(dates)
    staged = stage_views(spark)
    as_of = F.current_date() if settings.as_of is None else F.lit(settings.as_of)
    replace_table(products, DIM_PRODUCT)
    replace_table(dim_customer(staged["stg_customers"], as_of), DIM_CUSTOMER)
    entries = stage_latest(latest_table(spark).rows().select(*KPI_INPUTS))
    replace_table(dim_agent(entries, spark.table(DIM_CUSTOMER)), DIM_AGENT)
    if settings.by_changes:
        replace_table(products.select("product_id", "asset_class_bucket"), FACT_PRODUCTS)
    else:
        build_fact(spark, settings, entries)

    if settings.by_changes:
        report = with_agent_names(spark.table(REPORT_ROWS), spark.table(DIM_AGENT))
    else:
        report = monthly_performance(spark.table(FACT), spark.table(DIM_AGENT))
    report.createOrReplaceTempView(REPORT)
    checks = standard_report(
        history=read_table(spark, RAW_HISTORY),
        staged=entries,
        products=spark.table(DIM_PRODUCT),
        customers=spark.table(DIM_CUSTOMER),
        agents=spark.table(DIM_AGENT),
        kpis=spark.table(FACT),
        as_of=as_of,
        threshold=settings.threshold,
        money=settings.money,
    )
    results = checks.collect()
    require_passed(spark.createDataFrame(results, checks.schema))
    return {
        "summary": load_summary(metrics, masters),
        "metrics": metrics,
        "report": report,
        "checks": results,
    }
