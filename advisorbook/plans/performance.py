"""The report over the monthly fact."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from advisorbook import fixed_values as fv
from advisorbook.functions.numbers import relative_change
from advisorbook.operators.ranking import (
    DEFAULT_SPLITS,
    rank_in_group,
    top_ranked,
    with_previous,
)


# Columns of the report but the agent's name.
PERFORMANCE = (
    "agent_id", "month_start_date", "total_aum", "aum_equity_campuran", "aum_fixed_income",
    "pct_equity_campuran", "pct_fixed_income", "core_customer_count", "total_customer_count",
    "distinct_products_held", "month_end_positions", "rank_aum_in_month", "aum_mom_change_idr",
    "aum_mom_change_pct", "core_customers_mom_change", "portfolio_profile",
)


def with_monthly_change(kpis: DataFrame) -> DataFrame:
    """Add the agent's previous present month and the changes against it."""
    known = with_previous(
        kpis,
        ["agent_id"],
        "month_start_date",
        {"prev_month_aum": "total_aum", "prev_month_core_customers": "core_customer_count"},
    )
    total, previous = F.col("total_aum"), F.col("prev_month_aum")
    return known.withColumns(
        {
            "aum_mom_change_idr": total - previous,
            "aum_mom_change_pct": relative_change(total, previous),
            "core_customers_mom_change": F.col("core_customer_count")
            - F.col("prev_month_core_customers"),
        }
    )


def monthly_performance(
    kpis: DataFrame, agents: DataFrame, splits: int = DEFAULT_SPLITS
) -> DataFrame:
    """KPIs with agent name, rank in the month, month-over-month changes and profile.

    ``kpis`` should be the stored fact: ranking reads it more than once.
    """
    return with_agent_names(performance_rows(kpis, splits), agents)


def with_agent_names(rows: DataFrame, agents: DataFrame) -> DataFrame:
    """The report from its rows: the name of each agent behind its id."""
    names = agents.select(F.col("agent_id").alias("_agent_id"), "agent_name")
    named = rows.join(names, rows["agent_id"] == names["_agent_id"], "left")
    return named.select("agent_id", "agent_name", *[c for c in PERFORMANCE if c != "agent_id"])


def performance_rows(kpis: DataFrame, splits: int = DEFAULT_SPLITS) -> DataFrame:
    """The report without names, which come from another table and change on their own."""
    ranked = rank_in_group(
        kpis, ["month_start_date"], "total_aum", "rank_aum_in_month", splits, few_groups=True
    )
    changed = with_monthly_change(ranked)

    total = F.col("total_aum")
    profile = (
        F.when(total.isNull() | (total == 0), fv.PROFILE_NONE)
        .when(F.col("pct_fixed_income") >= fv.HEAVY_SHARE, fv.PROFILE_FIXED_INCOME)
        .when(F.col("pct_equity_campuran") >= fv.HEAVY_SHARE, fv.PROFILE_EQUITY)
        .otherwise(fv.PROFILE_BALANCED)
    )
    # The profile reads the shares as they are, so they are rounded after it.
    shares = {c: F.round(c, 4) for c in ("pct_equity_campuran", "pct_fixed_income")}
    return changed.withColumn("portfolio_profile", profile).withColumns(shares).select(*PERFORMANCE)


def top_agents_latest_month(
    kpis: DataFrame, agents: DataFrame, k: int = fv.TOP_AGENTS
) -> DataFrame:
    """Agents ranked at most ``k`` by money in the newest month, best first.

    Only the newest month is ranked, and each map task keeps its own best rows.
    """
    newest = kpis.agg(F.max("month_start_date")).scalar()
    latest = kpis.filter(F.col("month_start_date") == newest)
    best = top_ranked(latest, ["month_start_date"], "total_aum", k, "rank")
    names = agents.select(F.col("agent_id").alias("_agent_id"), "agent_name")
    return (
        best.join(names, best["agent_id"] == names["_agent_id"], "left")
        .select(
            "rank",
            "agent_id",
            "agent_name",
            "month_start_date",
            "total_aum",
            "pct_equity_campuran",
            "pct_fixed_income",
            "core_customer_count",
            "total_customer_count",
        )
        .orderBy(F.desc_nulls_last("month_start_date"), F.asc_nulls_last("rank"))
    )
