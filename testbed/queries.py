"""Every operator of the library, run over the test tables."""

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType

from advisorbook.functions.dates import (
    business_date,
    business_timestamp,
    date_from_name,
    month_start,
)
from advisorbook.functions.text import key_hash, null_tokens, strip
from advisorbook.operators import checks
from advisorbook.operators.drift import union_with_drift
from advisorbook.operators.incremental import after, upsert, watermark
from advisorbook.operators.latest import latest_per_key
from advisorbook.operators.profiling import detect_business_key, profile_columns
from advisorbook.operators.ranking import rank_in_group
from advisorbook.operators.reconcile import (
    rerun_drift,
    rerun_drift_by_period,
    split_differences,
    stack_totals,
)
from advisorbook.plans import kpis as kpi_plans
from advisorbook.plans.changes import MaintainedFact, MaintainedReport
from advisorbook.plans.dimensions import agent_activity, dim_agent, dim_customer, dim_product
from advisorbook.plans.ingest import load_master, load_metrics, load_new_dates, rebuild_history
from advisorbook.plans.performance import (
    monthly_performance,
    top_agents_latest_month,
    with_agent_names,
    with_monthly_change,
)
from advisorbook.plans.staging import (
    KPI_INPUTS,
    TIEBREAK,
    is_active,
    stage_customers,
    stage_portfolio,
    stage_products,
)
from advisorbook.session import cut_lineage, work_path
from advisorbook.sources.change_log import StagedChange
from advisorbook.sources.history_table import HistoryTable
from advisorbook.sources.latest_table import LatestTable
from advisorbook.sources.snapshots import FROM_FOLDER
from advisorbook.sources.tables import append_table, create_database, merge_table, read_table, replace_table
from advisorbook.sources.zones import ZoneTable
from testbed import tables as tb

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        return run

    return register


def _entries(spark: SparkSession, d: str) -> DataFrame:
    return stage_portfolio(tb.history(spark, d), KPI_INPUTS)


def _products(spark: SparkSession, d: str) -> DataFrame:
    return dim_product(stage_products(tb.listed_funds(spark, d), tb.RULES))


def _kpis(spark: SparkSession, d: str, threshold: int = tb.THRESHOLD) -> DataFrame:
    return kpi_plans.monthly_kpis(_entries(spark, d), _products(spark, d), threshold)


def _agents(spark: SparkSession, d: str, entries: DataFrame) -> DataFrame:
    names = dim_customer(stage_customers(tb.customers(spark, d)), _date(tb.AS_OF))
    return dim_agent(entries, names)


def _fact_and_agents(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The stored fact and the agents, both built from entries found once."""
    entries = cut_lineage(_entries(spark, d), "entries")
    facts = kpi_plans.monthly_kpis(entries, _products(spark, d), tb.THRESHOLD)
    return cut_lineage(facts, "kpis"), _agents(spark, d, entries)


def _date(text: str) -> Column:
    return F.lit(text).cast("date")


def _lines(spark: SparkSession, d: str) -> DataFrame:
    return tb.table(spark, d, "lineitem").withColumn("id", tb.entry_id())


def _database(spark: SparkSession, name: str) -> tuple[str, str]:
    """A fresh database for the tables of one query, and its folder."""
    folder = work_path(spark, name)
    database = folder.rsplit("/", 1)[1].replace("-", "_")
    create_database(spark, database, f"{folder}/tables")
    return database, folder


# Fact, report and their parts.


@query("agent_monthly_kpis")
def agent_monthly_kpis(spark: SparkSession, d: str) -> DataFrame:
    return _kpis(spark, d)


@query("agent_monthly_performance")
def agent_monthly_performance(spark: SparkSession, d: str) -> DataFrame:
    return monthly_performance(*_fact_and_agents(spark, d))


@query("top_agents_latest_month")
def top_agents(spark: SparkSession, d: str) -> DataFrame:
    return top_agents_latest_month(*_fact_and_agents(spark, d))


@query("total_aum")
def total_aum(spark: SparkSession, d: str) -> DataFrame:
    return kpi_plans.total_aum(_entries(spark, d))


@query("total_aum_four_decimals")
def total_aum_four_decimals(spark: SparkSession, d: str) -> DataFrame:
    """Balances net of discount, which carry four decimals."""
    net = F.col("ending_balance") * (1 - F.col("redeem_unit"))
    raw = tb.history(spark, d).withColumn("ending_balance", net)
    return kpi_plans.total_aum(stage_portfolio(raw, KPI_INPUTS))


@query("aum_split")
def aum_split(spark: SparkSession, d: str) -> DataFrame:
    return _kpis(spark, d).select(
        "agent_id",
        "month_start_date",
        "aum_equity_campuran",
        "aum_fixed_income",
        "aum_unknown_class",
        "pct_equity_campuran",
        "pct_fixed_income",
    )


@query("core_customers")
def core_customers(spark: SparkSession, d: str) -> DataFrame:
    entries = kpi_plans.month_end_entries(_entries(spark, d))
    return kpi_plans.core_customers(entries, tb.THRESHOLD)


@query("aum_mom_change")
def aum_mom_change(spark: SparkSession, d: str) -> DataFrame:
    return with_monthly_change(_kpis(spark, d)).select(
        "agent_id",
        "month_start_date",
        "total_aum",
        "prev_month_aum",
        "aum_mom_change_idr",
        "aum_mom_change_pct",
    )


@query("core_mom_change")
def core_mom_change(spark: SparkSession, d: str) -> DataFrame:
    return with_monthly_change(_kpis(spark, d)).select(
        "agent_id",
        "month_start_date",
        "core_customer_count",
        "prev_month_core_customers",
        "core_customers_mom_change",
    )


@query("rank_in_month")
def rank_in_month(spark: SparkSession, d: str) -> DataFrame:
    totals = cut_lineage(kpi_plans.total_aum(_entries(spark, d)), "totals")
    return rank_in_group(
        totals, ["month_start_date"], "total_aum", "rank_aum_in_month", few_groups=True
    )


@query("month_end_positions")
def month_end_positions(spark: SparkSession, d: str) -> DataFrame:
    """Last event with a value per user, type and week."""
    events = tb.table(spark, d, "events").filter(F.col("value").isNotNull())
    weekly = events.select(
        "user_id",
        "event_type",
        F.trunc("ts", "week").alias("week"),
        "ts",
        "event_id",
        "value",
    )
    return latest_per_key(weekly, ["user_id", "event_type", "week"], ["ts", "event_id"])


@query("month_end_entries")
def month_end_entries(spark: SparkSession, d: str) -> DataFrame:
    return kpi_plans.month_end_entries(_entries(spark, d)).withColumn(
        "ending_balance", F.col("ending_balance").cast("double")
    )


@query("kpis_since_month")
def kpis_since_month(spark: SparkSession, d: str) -> DataFrame:
    return kpi_plans.since_month(_kpis(spark, d), dt.date(2000, 3, 1))


@query("join_unknown_product")
def join_unknown_product(spark: SparkSession, d: str) -> DataFrame:
    return _kpis(spark, d).filter("aum_unknown_class > 0").select(
        "agent_id", "month_start_date", "total_aum", "aum_unknown_class"
    )


@query("aum_recompute_union")
def aum_recompute_union(spark: SparkSession, d: str) -> DataFrame:
    entries = _entries(spark, d)
    persisted = kpi_plans.monthly_kpis(entries, _products(spark, d), tb.THRESHOLD)
    return stack_totals(kpi_plans.total_aum(entries), persisted).orderBy(
        F.asc_nulls_last("agent_id"), F.asc_nulls_last("month_start_date")
    )


@query("aum_split_differences")
def aum_split_differences(spark: SparkSession, d: str) -> DataFrame:
    return split_differences(_kpis(spark, d))


# Staging and dimensions.


@query("latest_per_key")
def latest_version_per_key(spark: SparkSession, d: str) -> DataFrame:
    return latest_per_key(_lines(spark, d), ["id"], ["l_shipdate", "l_partkey", "l_suppkey"])


@query("stg_portfolio")
def stg_portfolio(spark: SparkSession, d: str) -> DataFrame:
    return stage_portfolio(tb.history(spark, d))


@query("active_entry_filter")
def active_entry_filter(spark: SparkSession, d: str) -> DataFrame:
    """The flag is NULL for N, true for R and false for A; only A stays."""
    flag = F.col("l_returnflag")
    deleted = F.when(flag == "R", True).when(flag == "A", False)
    lines = _lines(spark, d).withColumn("is_active_entry", is_active(deleted))
    return lines.filter("is_active_entry").select(
        "id", "l_partkey", "l_suppkey", "l_shipdate", "l_returnflag", "is_active_entry"
    )


@query("business_date_shift")
def business_date_shift(spark: SparkSession, d: str) -> DataFrame:
    ts = F.col("ts")
    return tb.table(spark, d, "events").select(
        "event_id",
        business_timestamp(ts).alias("business_ts"),
        business_date(ts).alias("business_date"),
        month_start(business_date(ts)).alias("business_month"),
    )


def _all_parts(spark: SparkSession, d: str) -> DataFrame:
    return tb.table(spark, d, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_brand").alias("hpfid"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("sid"),
    )


@query("classify_products")
def classify_products(spark: SparkSession, d: str) -> DataFrame:
    staged = stage_products(_all_parts(spark, d), tb.RULES)
    return staged.drop("created_at", "updated_at")


@query("dim_product")
def product_dimension(spark: SparkSession, d: str) -> DataFrame:
    return dim_product(stage_products(_all_parts(spark, d), tb.RULES))


@query("dim_agent")
def agent_dimension(spark: SparkSession, d: str) -> DataFrame:
    return _agents(spark, d, _entries(spark, d))


@query("agent_activity")
def agent_activity_span(spark: SparkSession, d: str) -> DataFrame:
    return agent_activity(_entries(spark, d))


@query("kyc_tenure")
def kyc_tenure(spark: SparkSession, d: str) -> DataFrame:
    return dim_customer(stage_customers(tb.customers(spark, d)), _date(tb.AS_OF))


# Upserts and incremental runs.


def _batches(spark: SparkSession, d: str, lookback_days: int) -> tuple[DataFrame, DataFrame]:
    """The fact as stored before the cut, and the months recomputed from all entries."""
    raw = tb.history(spark, d)
    products = _products(spark, d)
    before = raw.filter(F.col("ingested_at") < F.lit(tb.CUT).cast("timestamp_ntz"))
    stored = kpi_plans.monthly_kpis(stage_portfolio(before, KPI_INPUTS), products, tb.THRESHOLD)
    target = cut_lineage(stored, "target")
    mark = watermark(target, "month_start_date", lookback_days)
    source = kpi_plans.monthly_kpis(
        stage_portfolio(raw, KPI_INPUTS), products, tb.THRESHOLD, since=mark
    )
    return target, source


@query("incremental_window")
def incremental_window(spark: SparkSession, d: str) -> DataFrame:
    entries = _entries(spark, d)
    before = entries.filter(F.col("portfolio_date") < _date(tb.CUT))
    mark = watermark(before, "portfolio_month")
    return after(entries, "portfolio_month", mark)


@query("incremental_merge_kpis")
def incremental_merge_kpis(spark: SparkSession, d: str) -> DataFrame:
    return upsert(*_batches(spark, d, 90), keys=["agent_id", "month_start_date"])


@query("late_arrival_merge")
def late_arrival_merge(spark: SparkSession, d: str) -> DataFrame:
    """Entries dated by order but carried by later shipments: some fall before the window.

    History and fact are stored tables; of the history only the partitions the window needs are read.
    """
    database, _ = _database(spark, "late")
    raw, products = tb.history(spark, d, "o_orderdate"), _products(spark, d)
    raw = raw.select(*KPI_INPUTS, "updated_at", "snapshot_date", "ingested_at", F.trunc("snapshot_date", "MM").alias("arrived"))
    replace_table(raw.hint("rebalance", "arrived"), f"{database}.history", ["arrived"])
    history, fact = spark.table(f"{database}.history"), f"{database}.fact"
    zones = ZoneTable(spark, f"{database}.zones", "arrived")
    zones.record(history)
    before = history.filter(F.col("arrived") < _date(tb.CUT))
    stored = kpi_plans.monthly_kpis(stage_portfolio(before, KPI_INPUTS), products, tb.THRESHOLD)
    merge_table(stored, fact, ["agent_id", "month_start_date"], "month_start_date")
    mark = watermark(spark.table(fact), "month_start_date", 90)
    needed = stage_portfolio(zones.rows_since(history, mark), KPI_INPUTS)
    source = kpi_plans.monthly_kpis(needed, products, tb.THRESHOLD, since=mark)
    merge_table(source, fact, ["agent_id", "month_start_date"], "month_start_date")
    return spark.table(fact)


def _snapshots(spark: SparkSession, d: str) -> DataFrame:
    return _lines(spark, d).withColumn("snapshot_date", F.col("l_shipdate").cast("date"))


@query("merge_history")
def merge_history(spark: SparkSession, d: str) -> DataFrame:
    """Snapshots from 1998 arrive again with corrected prices, by the month."""
    lines = _snapshots(spark, d)
    early = lines.filter(F.col("snapshot_date") < _date("2000-01-01"))
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    again = lines.filter(F.col("snapshot_date") >= _date("1998-01-01")).withColumn("l_extendedprice", net)
    database, _ = _database(spark, "versions")
    table = HistoryTable(spark, f"{database}.history", ["id", "snapshot_date"], "month", ["l_partkey", "l_suppkey"])
    for source in (early, again):
        change = StagedChange(spark, f"{database}.log")
        table.merge(source.withColumn("month", F.trunc("snapshot_date", "MM")), change)
        change.commit()
    return table.rows().drop("month")


@query("merge_latest_guarded")
def merge_latest_guarded(spark: SparkSession, d: str) -> DataFrame:
    """The newer snapshots are loaded first, then the older ones, one year of them twice."""
    lines = _snapshots(spark, d)
    newer = lines.filter(F.col("snapshot_date") >= _date("1998-01-01"))
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    older = lines.filter(F.col("snapshot_date") < _date("1999-01-01")).withColumn("l_extendedprice", net)
    database, _ = _database(spark, "latest")
    for source in (newer, older):
        table = LatestTable(spark, f"{database}.latest", ["id"], "snapshot_date", ["l_partkey", "l_suppkey"], buckets=8)
        change = StagedChange(spark, f"{database}.log")
        table.merge(source, change)
        change.commit()
    return table.rows()


def _maintain(spark: SparkSession, d: str, increments: Sequence[Column]) -> str:
    """Fact and report kept up over increments of the history; returns the database."""
    history, products = tb.history(spark, d).select(*KPI_INPUTS, "updated_at", "snapshot_date", "ingested_at"), _products(spark, d)
    database, _ = _database(spark, "maintained")
    for increment in increments:
        change = StagedChange(spark, f"{database}.log")
        latest = LatestTable(spark, f"{database}.latest", ["id"], "ingested_at", TIEBREAK, buckets=8)
        feed = latest.merge(history.filter(increment), change)
        fact = MaintainedFact(spark, f"{database}.entries", f"{database}.totals", f"{database}.fact", tb.THRESHOLD)
        months, facts = fact.apply(feed, products, change)
        MaintainedReport(spark, f"{database}.fact", f"{database}.report", f"{database}.carry").apply(months, facts, change)
        change.commit()
    return database


@query("maintained_monthly_kpis")
def maintained_monthly_kpis(spark: SparkSession, d: str) -> DataFrame:
    """The fact after three increments of the history, the newest first and the oldest next."""
    year = F.year("snapshot_date")
    return spark.table(f"{_maintain(spark, d, [year >= 1999, year < 1997, year.between(1997, 1998)])}.fact")


@query("maintained_monthly_performance")
def maintained_monthly_performance(spark: SparkSession, d: str) -> DataFrame:
    """The report after a first load and a year that arrives late."""
    late = F.year("snapshot_date") == 1998
    database = _maintain(spark, d, [~late, late])
    newest = LatestTable(spark, f"{database}.latest", ["id"], "ingested_at", TIEBREAK).rows()
    agents = _agents(spark, d, stage_portfolio(newest, KPI_INPUTS)).select("agent_id", "agent_name")
    return with_agent_names(spark.table(f"{database}.report"), cut_lineage(agents, "agents"))


def _two_runs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """A second run stamps every row anew and changes the totals of unclassified money."""
    before = _kpis(spark, d).withColumn("updated_at", _date("2001-12-01"))
    changed = F.when(F.col("aum_unknown_class") > 0, F.col("total_aum") + 1)
    rerun = before.withColumns(
        {
            "updated_at": F.when(F.col("core_customer_count") > 0, _date("2001-12-02")).otherwise(
                F.col("updated_at")
            ),
            "total_aum": F.coalesce(changed, F.col("total_aum")),
        }
    )
    return before, rerun


@query("rerun_drift")
def rerun_drift_counts(spark: SparkSession, d: str) -> DataFrame:
    return rerun_drift(*_two_runs(spark, d), "updated_at")


@query("rerun_drift_by_month")
def rerun_drift_by_month(spark: SparkSession, d: str) -> DataFrame:
    """The same on stored versions, of which the second changes from 1998 on only."""
    database, _ = _database(spark, "drift")
    before, rerun = _two_runs(spark, d)
    early = F.col("month_start_date") < _date("1998-01-01")
    replace_table(before.hint("rebalance", "month_start_date"), f"{database}.before", ["month_start_date"])
    mixed = spark.table(f"{database}.before").filter(early).unionByName(rerun.filter(~early))
    replace_table(mixed.hint("rebalance", "month_start_date"), f"{database}.after", ["month_start_date"])
    return rerun_drift_by_period(spark.table(f"{database}.before"), spark.table(f"{database}.after"), "updated_at")


# Ingest.


@query("schema_drift_union")
def schema_drift_union(spark: SparkSession, d: str) -> DataFrame:
    orders = tb.table(spark, d, "orders")
    cut = F.lit(tb.CUT).cast("timestamp_ntz")
    early = orders.filter(F.col("o_orderdate") < cut).drop("o_orderpriority")
    late = orders.filter(F.col("o_orderdate") >= cut).drop("o_orderstatus")
    return union_with_drift([early, late])


def _write_csv(batch: DataFrame, folder: str) -> None:
    """One folder of files per snapshot date, with a header."""
    by_date = batch.hint("rebalance", "snapshot").write.mode("append").partitionBy("snapshot")
    by_date.option("header", True).csv(folder)


@query("schema_drift_widening")
def schema_drift_widening(spark: SparkSession, d: str) -> DataFrame:
    """Yearly snapshots in three loads: a quantity without values, of whole numbers, of fractions; a note of
    letters, then of digits."""
    database, folder = _database(spark, "widening")
    lines = _lines(spark, d).withColumn("snapshot", F.trunc("l_shipdate", "year"))
    year, name = F.year("snapshot"), f"{database}.history"
    quantity, dates = F.floor("l_quantity"), []
    flag, number = F.col("l_returnflag"), F.col("l_linenumber").cast("string")
    for years, qty, note in (
        (year < 1996, F.lit(None), flag),
        (year.between(1996, 1998), quantity, flag),
        (year > 1998, quantity + F.lit(0.5), number),
    ):
        part = lines.filter(years)
        _write_csv(part.select("snapshot", "id", "l_partkey", qty.cast("string").alias("qty"), note.alias("note")), f"{folder}/csv")
        dates = [r[0] for r in part.select("snapshot").distinct().collect()]
        load_new_dates(
            spark, f"{folder}/csv", name, dates, {"id": LongType(), "l_partkey": LongType()},
            date_from=FROM_FOLDER, heads=f"{database}.heads",
        )
    return read_table(spark, name)


@query("append_snapshots")
def append_snapshots(spark: SparkSession, d: str) -> DataFrame:
    """Two appends to one table; the second brings a column the first lacks."""
    folder = work_path(spark, "append")
    database = folder.rsplit("/", 1)[1].replace("-", "_")
    create_database(spark, database, folder)
    name = f"{database}.history"
    orders = tb.table(spark, d, "orders").withColumn("snapshot_date", F.trunc("o_orderdate", "year"))
    cut = F.lit(tb.CUT).cast("timestamp_ntz")
    early = orders.filter(F.col("o_orderdate") < cut).drop("o_orderpriority")
    append_table(early.hint("rebalance", "snapshot_date"), name, ["snapshot_date"])
    late = orders.filter(F.col("o_orderdate") >= cut)
    append_table(late.hint("rebalance", "snapshot_date"), name)
    return spark.table(name)


CSV_CONTRACT = {
    "l_orderkey": LongType(),
    "l_partkey": LongType(),
    "l_suppkey": LongType(),
    "l_linenumber": IntegerType(),
    "l_quantity": DoubleType(),
    "l_extendedprice": DoubleType(),
    "l_discount": DoubleType(),
    "l_returnflag": StringType(),
    "l_linestatus": StringType(),
    "l_shipdate": StringType(),
}


MASTER_CONTRACT = {
    "c_custkey": LongType(),
    "c_name": StringType(),
    "c_nationkey": IntegerType(),
    "c_acctbal": DoubleType(),
    "c_mktsegment": StringType(),
}


@query("ingest_snapshots")
def ingest_snapshots(spark: SparkSession, d: str) -> DataFrame:
    """Line items as yearly CSV snapshots, with one more column from 1999, and back."""
    database, folder = _database(spark, "ingest")
    lines = tb.table(spark, d, "lineitem").withColumn("snapshot", F.trunc("l_shipdate", "year"))
    texts = [F.col(c).cast("string").alias(c) for c in CSV_CONTRACT]
    cut = F.lit(tb.CUT).cast("timestamp_ntz")
    early = lines.filter(F.col("l_shipdate") < cut).select("snapshot", *texts)
    late = lines.filter(F.col("l_shipdate") >= cut).select("snapshot", *texts, "l_tax")
    for batch in (early, late):
        _write_csv(batch, f"{folder}/csv")
    name = f"{database}.history"
    rebuild_history(spark, f"{folder}/csv", name, CSV_CONTRACT, date_from=FROM_FOLDER)
    return spark.table(name)


@query("reload_master")
def reload_master(spark: SparkSession, d: str) -> DataFrame:
    """Customers as master files, loaded twice with other balances, with the rows the second load counted."""
    database, folder = _database(spark, "master")
    name = f"{database}.customers"
    customers = tb.table(spark, d, "customer")
    for k in range(2):
        sent = customers.withColumn("c_acctbal", F.col("c_acctbal") + k)
        sent.write.option("header", True).csv(f"{folder}/customers_{k}")
        rows = load_master(spark, f"{folder}/customers_{k}", name, MASTER_CONTRACT)
    return spark.table(name).withColumn("rows_loaded", F.lit(rows).cast("long"))


@query("ingest_metrics")
def ingest_metrics(spark: SparkSession, d: str) -> DataFrame:
    lines = tb.table(spark, d, "lineitem")
    return load_metrics(lines.select(F.col("l_shipdate").cast("date").alias("snapshot_date")))


@query("clean_strings")
def clean_strings(spark: SparkSession, d: str) -> DataFrame:
    """Names padded with blanks, tabs and wide spaces; some types are NULL tokens or blank."""
    name = F.concat(F.lit(" \t"), F.col("p_name"), F.lit("　\n"))
    kind = F.col("p_type")
    raw_kind = F.when(kind == "PROMO", "NA").when(kind == "LARGE", " \t ").otherwise(kind)
    return tb.table(spark, d, "part").select(
        "p_partkey",
        strip(null_tokens(name)).alias("p_name"),
        strip(null_tokens(raw_kind)).alias("p_type"),
    )


@query("snapshot_date_from_name")
def snapshot_date_from_name(spark: SparkSession, d: str) -> DataFrame:
    """File names with ISO and compact dates, next to numbers that are no date."""
    day = F.col("l_shipdate")
    iso = F.concat(F.lit("history_"), F.date_format(day, "yyyy-MM-dd"), F.lit("_v2.csv"))
    compact = F.concat(F.lit("batch123456789_"), F.date_format(day, "yyyyMMdd"), F.lit(".csv"))
    name = F.when(F.col("l_returnflag") == "R", iso).otherwise(compact)
    return _lines(spark, d).select(
        "id", name.alias("file_name"), date_from_name(name).alias("snapshot_date")
    )


# Keys.

KEY_PATTERNS = (r"key$", r"number$", r"^id$")


@query("profile_columns")
def profile_key_columns(spark: SparkSession, d: str) -> DataFrame:
    return profile_columns(tb.table(spark, d, "lineitem"), KEY_PATTERNS)


@query("detect_business_key")
def detect_key(spark: SparkSession, d: str) -> DataFrame:
    """One frame per branch: a single key, a composite key, and no good column at all."""
    users = tb.table(spark, d, "events").select(F.col("user_id").alias("user_key"))
    frames = {
        "orders": tb.table(spark, d, "orders"),
        "lineitem": tb.table(spark, d, "lineitem"),
        "events": users,
    }
    result = None
    for name, df in frames.items():
        keys = detect_business_key(df, KEY_PATTERNS)
        chosen = profile_columns(df, KEY_PATTERNS).filter(F.col("column").isin(keys))
        named = chosen.select(F.lit(name).alias("table_name"), F.col("column").alias("key_column"))
        result = named if result is None else result.unionByName(named)
    return result


@query("business_key_hash")
def business_key_hash(spark: SparkSession, d: str) -> DataFrame:
    part = F.when(F.col("l_returnflag") != "N", F.col("l_partkey"))
    return tb.table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        part.alias("l_partkey"),
        key_hash(F.col("l_orderkey"), part, F.col("l_linenumber")).alias("bk_hash"),
    )


# Checks.


def _served(spark: SparkSession, d: str) -> DataFrame:
    """Customers outside one segment; the others' orders have no parent."""
    return tb.table(spark, d, "customer").filter(F.col("c_mktsegment") != "FURNITURE")


@query("check_not_null")
def check_not_null(spark: SparkSession, d: str) -> DataFrame:
    orders, people = tb.table(spark, d, "orders"), _served(spark, d)
    joined = orders.join(people, orders["o_custkey"] == people["c_custkey"], "left")
    return checks.not_null(joined.select("o_orderkey", "o_custkey", "c_name"), "c_name")


@query("check_unique")
def check_unique(spark: SparkSession, d: str) -> DataFrame:
    return checks.unique(tb.table(spark, d, "lineitem"), "l_orderkey")


@query("check_unique_grain")
def check_unique_grain(spark: SparkSession, d: str) -> DataFrame:
    lines = tb.table(spark, d, "lineitem")
    return checks.unique_combination(lines, ["l_orderkey", "l_linenumber"])


@query("check_accepted_values")
def check_accepted_values(spark: SparkSession, d: str) -> DataFrame:
    accepted = ["ECONOMY", "LARGE", "MEDIUM", "SMALL", "STANDARD"]
    return checks.accepted_values(tb.table(spark, d, "part"), "p_type", accepted)


@query("check_relationships")
def check_relationships(spark: SparkSession, d: str) -> DataFrame:
    orders = tb.table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return checks.relationships(orders, "o_custkey", _served(spark, d), "c_custkey")


@query("check_no_future_dates")
def check_no_future_dates(spark: SparkSession, d: str) -> DataFrame:
    events = tb.table(spark, d, "events").select("event_id", "ts")
    as_of = F.lit("2024-01-20 06:00:00").cast("timestamp_ntz")
    return checks.no_future_dates(events, "ts", as_of, offset_hours=12)


@query("check_non_negative")
def check_non_negative(spark: SparkSession, d: str) -> DataFrame:
    return checks.non_negative(tb.table(spark, d, "customer"), "c_acctbal")


@query("check_allocation")
def check_allocation(spark: SparkSession, d: str) -> DataFrame:
    return checks.allocation_reconciles(_kpis(spark, d))


@query("check_core_reconciles")
def check_core_reconciles(spark: SparkSession, d: str) -> DataFrame:
    """The fact was built with a lower threshold than the recomputation uses."""
    kpis = _kpis(spark, d, threshold=90_000)
    return checks.core_counts_reconcile(core_customers(spark, d), kpis)


@query("check_core_reconciles_literal")
def check_core_reconciles_literal(spark: SparkSession, d: str) -> DataFrame:
    """Read literally, every month without core customers is reported."""
    return checks.core_counts_reconcile(core_customers(spark, d), _kpis(spark, d), missing=-1)


@query("check_positions_bound")
def check_positions_bound(spark: SparkSession, d: str) -> DataFrame:
    """With one product on offer, any customer with two positions breaks the bound."""
    return checks.positions_within_bounds(_kpis(spark, d), 1)


@query("check_no_future_month")
def check_no_future_month(spark: SparkSession, d: str) -> DataFrame:
    return checks.no_future_months(_kpis(spark, d), _date("2001-01-01"))


@query("dq_report")
def dq_report(spark: SparkSession, d: str) -> DataFrame:
    as_of = F.lit("2024-01-20 06:00:00").cast("timestamp_ntz")
    people, parts = tb.table(spark, d, "customer"), tb.table(spark, d, "part")
    lines, orders = tb.table(spark, d, "lineitem"), tb.table(spark, d, "orders")
    accepted = ["ECONOMY", "LARGE", "MEDIUM", "SMALL", "STANDARD"]
    entries = cut_lineage(_entries(spark, d), "entries")
    facts = kpi_plans.monthly_kpis(entries, _products(spark, d), tb.THRESHOLD)
    kpis = cut_lineage(facts, "kpis")
    expected = kpi_plans.core_customers(kpi_plans.month_end_entries(entries), tb.THRESHOLD)
    return checks.dq_report(
        [
            (
                people,
                [
                    checks.RowCheck("customer.c_custkey.not_null", checks.is_missing("c_custkey")),
                    checks.RowCheck(
                        "customer.c_acctbal.non_negative",
                        checks.is_negative("c_acctbal"),
                        checks.WARN,
                    ),
                ],
            ),
            (
                tb.table(spark, d, "events"),
                [checks.RowCheck("events.ts.no_future_dates", checks.is_future("ts", as_of, 12))],
            ),
            (
                parts,
                [
                    checks.RowCheck(
                        "part.p_type.accepted_values",
                        checks.is_unexpected("p_type", accepted),
                        checks.WARN,
                    )
                ],
            ),
        ],
        [
            checks.SetCheck("customer.c_custkey.unique", checks.unique(people, "c_custkey")),
            checks.SetCheck(
                "lineitem.grain.unique",
                checks.unique_combination(lines, ["l_orderkey", "l_linenumber"]),
            ),
            checks.SetCheck(
                "orders.o_custkey.relationships",
                checks.relationships(orders, "o_custkey", _served(spark, d), "c_custkey"),
            ),
            checks.SetCheck("kpis.allocation_reconciles", checks.allocation_reconciles(kpis)),
            checks.SetCheck(
                "kpis.core_counts_reconcile",
                checks.core_counts_reconcile(expected, kpis),
            ),
        ],
    )
