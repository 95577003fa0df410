"""Staging: typed, renamed, one row per id."""

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from advisorbook import fixed_values as fv
from advisorbook.contracts import INGESTED_AT
from advisorbook.functions.dates import business_date, business_timestamp, month_start
from advisorbook.functions.text import first_matching
from advisorbook.operators.latest import latest_per_key

# Settles two rows with one id in one snapshot. It names every column the KPIs read, so
# whatever is left open cannot change a KPI.
TIEBREAK = (
    "updated_at", "date", "ending_balance", "is_deleted", "agent_id", "unit_holder_id",
    "product_id",
)

# Raw columns the fact and the agent dimension read.
KPI_INPUTS = (
    "id", "agent_id", "product_id", "unit_holder_id", "date", "ending_balance", "is_deleted",
)


def latest_entries(
    raw: DataFrame,
    columns: Iterable[str] | None = None,
    tiebreak: Sequence[str] = TIEBREAK,
) -> DataFrame:
    """The newest version of each id, carrying only ``columns`` through the shuffle."""
    wanted = set(columns or raw.columns) | {"id", INGESTED_AT, *tiebreak}
    pruned = raw.select(*[c for c in raw.columns if c in wanted])
    return latest_per_key(pruned, ["id"], [INGESTED_AT, *tiebreak])


def stage_portfolio(
    raw: DataFrame,
    columns: Iterable[str] | None = None,
    tiebreak: Sequence[str] = TIEBREAK,
) -> DataFrame:
    """Portfolio entries on the business clock, one row per id.

    A deleted newest version removes that id only. A NULL flag is neither active nor
    deleted: ``is_active_entry`` is NULL then. Pass ``columns=KPI_INPUTS`` where only KPIs
    are wanted; the output then holds just what they need.
    """
    return stage_latest(latest_entries(raw, columns, tiebreak), columns or raw.columns)


def stage_latest(latest: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Entries that hold each id once already, on the business clock."""
    wanted = set(columns or latest.columns)
    day = business_date(F.col("date"))
    staged = [
        ("id", F.col("id").alias("portfolio_id")),
        ("agent_id", F.col("agent_id")),
        ("selling_agent_id", F.col("selling_agent_id")),
        ("product_id", F.col("product_id")),
        ("unit_holder_id", F.col("unit_holder_id").alias("customer_id")),
        ("date", day.alias("portfolio_date")),
        ("date", month_start(day).alias("portfolio_month")),
        ("snapshot_date", business_date(F.col("snapshot_date")).alias("snapshot_date")),
        ("created_at", business_timestamp(F.col("created_at")).alias("created_at")),
        ("updated_at", business_timestamp(F.col("updated_at")).alias("updated_at")),
        ("current_nav", F.col("current_nav")),
        ("run_nav_value", F.col("run_nav_value")),
        ("beginning_unit", F.col("beginning_unit")),
        ("subscription_unit", F.col("subscription_unit")),
        ("redeem_unit", F.col("redeem_unit")),
        ("dividend_unit", F.col("dividend_unit")),
        ("ending_unit", F.col("ending_unit")),
        ("capital", F.col("capital")),
        ("beginning_balance", F.col("beginning_balance")),
        ("ending_balance", F.col("ending_balance")),
        ("profit_or_loss", F.col("profit_or_loss")),
        ("profit_or_loss_in_percent", F.col("profit_or_loss_in_percent").alias("profit_or_loss_pct")),
        ("is_deleted", F.col("is_deleted")),
        ("is_deleted", is_active(F.col("is_deleted")).alias("is_active_entry")),
    ]
    return latest.select(*[expr for source, expr in staged if source in wanted])


def is_active(is_deleted: Column) -> Column:
    """True where not deleted; NULL stays NULL, which a filter drops."""
    return is_deleted == F.lit(False)


def stage_products(
    raw: DataFrame,
    rules: Iterable[tuple[str, Sequence[str]]] = fv.ASSET_CLASS_RULES,
    as_of: Column | None = None,
) -> DataFrame:
    """Product master with its asset class, read from keywords in the name.

    ``as_of`` stamps created_at and updated_at; the default is the time of the query.
    """
    stamp = F.current_timestamp() if as_of is None else as_of
    return raw.select(
        F.col("id").cast("bigint").alias("product_id"),
        F.col("hpfid").cast("string").alias("product_code"),
        F.col("name").cast("string").alias("product_name"),
        F.col("sid").cast("string").alias("isin"),
        F.lit(fv.CURRENCY).alias("currency"),
        first_matching(F.col("name"), rules, fv.UNKNOWN_CLASS).alias("asset_class"),
        stamp.alias("created_at"),
        stamp.alias("updated_at"),
    )


def stage_customers(raw: DataFrame) -> DataFrame:
    """Customer master with the KYC time on the business clock."""
    return raw.select(
        "customer_id",
        "customer_name",
        "unit_holder_id",
        "sid",
        "agent_id",
        "branch_name",
        business_timestamp(F.col("approved_kyc_at")).alias("approved_kyc_at"),
        "customer_type",
    )
