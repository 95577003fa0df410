"""The standing set of checks over staging, dimensions and fact."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from advisorbook import fixed_values as fv
from advisorbook.contracts import KPI_KEYS, MONEY
from advisorbook.operators import checks as q
from advisorbook.plans.kpis import core_customers, month_end_entries

ASSET_CLASSES = [name for name, _ in fv.ASSET_CLASS_RULES] + [fv.UNKNOWN_CLASS]


def standard_report(
    history: DataFrame,
    staged: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    agents: DataFrame,
    kpis: DataFrame,
    as_of: Column,
    threshold: int = fv.CORE_CUSTOMER_THRESHOLD,
    money: DataType = MONEY,
) -> DataFrame:
    """One row per check. Conditions on single rows share one pass per table."""

    def missing(table: str, *columns: str) -> list[q.RowCheck]:
        return [q.RowCheck(f"{table}.{c}.not_null", q.is_missing(c)) for c in columns]

    money_columns = ("total_aum", "aum_equity_campuran", "aum_fixed_income")
    row_checks = [
        (history, missing("history", "id")),
        (
            staged,
            [
                *missing(
                    "staged", "portfolio_id", "agent_id", "product_id", "customer_id",
                    "portfolio_date",
                ),
                q.RowCheck(
                    "staged.portfolio_date.no_future_dates", q.is_future("portfolio_date", as_of)
                ),
            ],
        ),
        (
            products,
            [
                *missing("products", "product_id", "asset_class"),
                q.RowCheck(
                    "products.asset_class.accepted_values",
                    q.is_unexpected("asset_class", ASSET_CLASSES),
                    q.WARN,
                ),
                q.RowCheck(
                    "products.asset_class_bucket.accepted_values",
                    q.is_unexpected("asset_class_bucket", [fv.EQUITY, fv.FIXED_INCOME]),
                ),
            ],
        ),
        (customers, missing("customers", "customer_id")),
        (agents, missing("agents", "agent_id")),
        (
            kpis,
            [
                *missing("kpis", *KPI_KEYS),
                *[
                    q.RowCheck(f"kpis.{c}.non_negative", q.is_negative(c), q.WARN)
                    for c in money_columns
                ],
                q.RowCheck(
                    "kpis.month_start_date.no_future_months", F.col("month_start_date") > as_of
                ),
            ],
        ),
    ]
    expected = core_customers(month_end_entries(staged, money), threshold)
    size = products.agg(F.count(F.lit(1))).scalar()
    set_checks = [
        q.SetCheck("products.product_id.unique", q.unique(products, "product_id")),
        q.SetCheck("customers.customer_id.unique", q.unique(customers, "customer_id")),
        q.SetCheck("agents.agent_id.unique", q.unique(agents, "agent_id")),
        q.SetCheck(
            "staged.product_id.relationships",
            q.relationships(staged, "product_id", products, "product_id"),
        ),
        q.SetCheck(
            "staged.customer_id.relationships",
            q.relationships(staged, "customer_id", customers, "unit_holder_id"),
            q.WARN,
        ),
        q.SetCheck(
            "customers.agent_id.relationships",
            q.relationships(customers, "agent_id", agents, "agent_id"),
        ),
        q.SetCheck(
            "kpis.agent_id.relationships",
            q.relationships(kpis, "agent_id", agents, "agent_id"),
        ),
        q.SetCheck("kpis.grain.unique", q.unique_combination(kpis, KPI_KEYS)),
        q.SetCheck("kpis.allocation_reconciles", q.allocation_reconciles(kpis)),
        q.SetCheck("kpis.core_counts_reconcile", q.core_counts_reconcile(expected, kpis)),
        q.SetCheck("kpis.positions_within_bounds", q.positions_within_bounds(kpis, size)),
    ]
    return q.dq_report(row_checks, set_checks)
