"""Dimension tables."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from advisorbook import fixed_values as fv
from advisorbook.functions.dates import tenure_days
from advisorbook.functions.text import lookup


def dim_product(products: DataFrame) -> DataFrame:
    """Staged products with display label and bucket; what is not fixed income is equity."""
    asset_class = F.col("asset_class")
    fixed_income = asset_class.isin(*fv.FIXED_INCOME_CLASSES)
    return products.select(
        "product_id",
        "product_code",
        "product_name",
        "isin",
        "currency",
        "asset_class",
        lookup(asset_class, fv.ASSET_CLASS_LABELS, fv.UNKNOWN_CLASS).alias("asset_class_label"),
        F.when(fixed_income, fv.FIXED_INCOME).otherwise(fv.EQUITY).alias("asset_class_bucket"),
    )


def dim_customer(customers: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Staged customers with days since KYC approval, NULL where not approved."""
    today = F.current_date() if as_of is None else as_of
    return customers.select(
        "customer_id",
        "customer_name",
        "unit_holder_id",
        "sid",
        "agent_id",
        "branch_name",
        "approved_kyc_at",
        "customer_type",
        tenure_days(F.col("approved_kyc_at"), today).alias("kyc_tenure_days"),
    )


def agent_activity(staged: DataFrame) -> DataFrame:
    """First and last date, distinct customers and products per agent, deleted entries too.

    Both distinct counts share one scan: rows are reduced to distinct (agent, customer) and
    (agent, product) inside the map tasks, so one large agent is spread over its customers.
    """
    return staged.groupBy("agent_id").agg(
        F.min("portfolio_date").alias("first_seen_date"),
        F.max("portfolio_date").alias("last_seen_date"),
        F.count_distinct("customer_id").alias("distinct_customers_seen"),
        F.count_distinct("product_id").alias("distinct_products_seen"),
    )


def dim_agent(
    staged: DataFrame, customers: DataFrame, name_column: str = "branch_name"
) -> DataFrame:
    """One row per agent seen in the entries, named from the customer master.

    The name is the smallest ``name_column`` of the agent's customers, so it does not vary
    between runs. An agent is active when seen on the newest date of all entries.
    """
    names = customers.groupBy(F.col("agent_id").alias("_agent_id")).agg(
        F.min(name_column).alias("_name")
    )
    newest = staged.agg(F.max("portfolio_date")).scalar()
    agents = agent_activity(staged)
    named = agents.join(names, agents["agent_id"] == names["_agent_id"], "left")
    fallback = F.concat(F.lit(fv.AGENT_NAME_PREFIX), F.col("agent_id").cast("string"))
    return named.select(
        "agent_id",
        F.coalesce("_name", fallback).alias("agent_name"),
        "first_seen_date",
        "last_seen_date",
        "distinct_customers_seen",
        "distinct_products_seen",
        (F.col("last_seen_date") == newest).alias("is_currently_active"),
    )
