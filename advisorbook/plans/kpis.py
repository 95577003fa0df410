"""The monthly fact: one row per (agent, month)."""

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from advisorbook import fixed_values as fv
from advisorbook.contracts import MONEY
from advisorbook.functions.numbers import share
from advisorbook.operators.incremental import after
from advisorbook.operators.latest import latest_per_key


def as_money(value: Column, money: DataType = MONEY) -> Column:
    """The value as money; one that does not fit fails with a message instead of turning NULL."""
    fitted = value.try_cast(money)
    message = F.concat(F.lit(f"Balance does not fit {money.simpleString()}: "), value.cast("string"))
    return F.when(value.isNotNull() & fitted.isNull(), F.raise_error(message).cast(money)).otherwise(fitted)


def month_end_entries(staged: DataFrame, money: DataType = MONEY) -> DataFrame:
    """The last live entry per agent, customer, product and month.

    Deleted entries and entries without a balance are dropped first, so an earlier entry
    of the month may become its last.
    """
    live = staged.filter(F.col("is_active_entry") & F.col("ending_balance").isNotNull())
    entries = live.select(
        "agent_id",
        "customer_id",
        "product_id",
        F.col("portfolio_month").alias("month_start_date"),
        "portfolio_date",
        "portfolio_id",
        as_money(F.col("ending_balance"), money).alias("ending_balance"),
    )
    return latest_per_key(
        entries,
        ["agent_id", "customer_id", "product_id", "month_start_date"],
        ["portfolio_date", "portfolio_id"],
    )


def customer_totals(entries: DataFrame) -> DataFrame:
    """Month-end money per agent, month and customer."""
    return entries.groupBy("agent_id", "month_start_date", "customer_id").agg(
        F.sum("ending_balance").alias("customer_aum")
    )


def core_customers(
    entries: DataFrame, threshold: float = fv.CORE_CUSTOMER_THRESHOLD
) -> DataFrame:
    """Customers strictly above the threshold, per agent and month that has any."""
    core = customer_totals(entries).filter(F.col("customer_aum") > threshold)
    return core.groupBy("agent_id", "month_start_date").agg(
        F.count("customer_id").alias("expected_core_count")
    )


def monthly_kpis(
    staged: DataFrame,
    products: DataFrame,
    threshold: int = fv.CORE_CUSTOMER_THRESHOLD,
    since: dt.date | None = None,
    as_of: dt.date | None = None,
    money: DataType = MONEY,
    stamp: Column | None = None,
) -> DataFrame:
    """Money by bucket, customers, products and positions per agent and month.

    ``since`` keeps months strictly after it (incremental run), ``as_of`` drops later
    entries, ``stamp`` adds the load time as ``updated_at``.

    Month-end entries are totalled once per customer and once per product, in one pass and
    with partial sums before each shuffle; both totals then fold into the agent-month. So no
    window, distinct count or self-join runs over the entries, a large agent or customer is
    spread over its products, and the product lookup joins product totals, not entries.
    Spark broadcasts the product table if it is below its size limit.
    """
    if since is not None:
        staged = after(staged, "portfolio_month", since)
    if as_of is not None:
        staged = staged.filter(F.col("portfolio_date") <= F.lit(as_of))

    entries = month_end_entries(staged, money)
    totals = position_totals(entries, F.sum("ending_balance"), F.count(F.lit(1)))
    return kpis_of_totals(totals, products, threshold, stamp)


def position_totals(positions: DataFrame, aum: Column, count: Column, known: DataFrame | None = None) -> DataFrame:
    """Money and positions once per customer and once per product of each agent and month.

    ``known`` holds such totals, to which the positions' are added in the same shuffle.
    """
    if known is not None:
        whose = ("customer_id", "product_id")

        def side(flag: int) -> Column:
            kept = [F.when(F.lit(k == flag), F.col(c)).alias(c) for k, c in enumerate(whose)]
            return F.struct(*kept, F.lit(flag).cast("byte").alias("is_product_total"))

        rest = [c for c in positions.columns if c not in whose]
        each = positions.select(*rest, F.inline(F.array(side(0), side(1)))).unionByName(known)
        keys = ("agent_id", "month_start_date", *whose, "is_product_total")
        return each.groupBy(*keys).agg(aum.alias("aum"), count.alias("positions"))
    return positions.groupingSets(
        [
            ["agent_id", "month_start_date", "customer_id"],
            ["agent_id", "month_start_date", "product_id"],
        ],
        "agent_id",
        "month_start_date",
        "customer_id",
        "product_id",
    ).agg(
        aum.alias("aum"),
        count.alias("positions"),
        F.grouping("customer_id").alias("is_product_total"),
    )


def kpis_of_totals(
    totals: DataFrame,
    products: DataFrame,
    threshold: int = fv.CORE_CUSTOMER_THRESHOLD,
    stamp: Column | None = None,
    stored: bool = False,
) -> DataFrame:
    """The fact's rows from the totals per customer and per product.

    With ``stored`` totals, which are read twice then, only those per product travel to the lookup.
    """
    buckets = products.select(
        F.col("product_id").alias("_product_id"), F.col("asset_class_bucket").alias("bucket")
    )
    per_product = F.col("is_product_total") == 1
    # Customer totals have no product. Joined on NULL they would meet in one task, so they
    # take a spread key and the condition keeps them unmatched.
    if stored:
        found = totals.filter(per_product).join(buckets, F.col("product_id") == F.col("_product_id"), "left")
        classified = found.unionByName(totals.filter(~per_product), allowMissingColumns=True)
    else:
        anywhere = F.hash("customer_id").cast(totals.schema["product_id"].dataType)
        key = F.when(per_product, F.col("product_id")).otherwise(anywhere)
        classified = totals.join(buckets, (key == F.col("_product_id")) & per_product, "left")

    # An agent without id gets no customer counts: NULL never equals NULL.
    counted = ~per_product & F.col("agent_id").isNotNull()
    bucket, aum = F.col("bucket"), F.col("aum")
    unknown = bucket.isNull() | ~bucket.isin(fv.EQUITY, fv.FIXED_INCOME)

    def money_in(condition: Column) -> Column:
        return F.sum(F.when(per_product & condition, aum).otherwise(0)).cast("double")

    facts = classified.groupBy("agent_id", "month_start_date").agg(
        F.sum(F.when(per_product, aum)).cast("double").alias("total_aum"),
        money_in(bucket == fv.EQUITY).alias("aum_equity_campuran"),
        money_in(bucket == fv.FIXED_INCOME).alias("aum_fixed_income"),
        money_in(unknown).alias("aum_unknown_class"),
        F.count(F.when(counted & (aum > threshold), F.col("customer_id"))).alias("core_customer_count"),
        F.count(F.when(counted, F.col("customer_id"))).alias("total_customer_count"),
        F.count(F.when(per_product, F.col("product_id"))).alias("distinct_products_held"),
        F.sum(F.when(per_product, F.col("positions"))).alias("month_end_positions"),
    )
    total = F.col("total_aum")
    result = facts.select(
        "agent_id",
        "month_start_date",
        "total_aum",
        "aum_equity_campuran",
        "aum_fixed_income",
        "aum_unknown_class",
        share(F.col("aum_equity_campuran"), total).alias("pct_equity_campuran"),
        share(F.col("aum_fixed_income"), total).alias("pct_fixed_income"),
        "core_customer_count",
        "total_customer_count",
        "distinct_products_held",
        "month_end_positions",
        F.lit(threshold).cast("bigint").alias("core_customer_threshold_idr"),
    )
    return result if stamp is None else result.withColumn("updated_at", stamp)


def total_aum(staged: DataFrame, money: DataType = MONEY) -> DataFrame:
    """Month-end money per agent and month alone."""
    return month_end_entries(staged, money).groupBy("agent_id", "month_start_date").agg(
        F.sum("ending_balance").cast("double").alias("total_aum")
    )


def since_month(kpis: DataFrame, month: dt.date) -> DataFrame:
    """Months from ``month`` on; on the stored fact this reads only their partitions."""
    return kpis.filter(F.col("month_start_date") >= F.lit(month))
