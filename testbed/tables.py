"""The library's input frames, made from the test tables.

A line item is a portfolio entry: (order, line) identifies it and repeats, and the ship
date is the snapshot that carries it. The nation is the agent, the order's customer is the
customer, and the fund is the part's name with the lowest part key of that name as its id.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Keyword rules over part names ("adjective noun"); nouns come before adjectives.
RULES = (
    ("Saham", ("ring",)),
    ("Ekuitas", ("rod",)),
    ("Obligasi", ("bolt", "plate")),
    ("Campuran", ("gear",)),
    ("Penyertaan Terbatas", ("old anvil", "new anvil")),
    ("Syariah", ("cold",)),
    ("Terproteksi", ("hot",)),
    ("Money Market", ("red", "large")),
)
THRESHOLD = 100_000
CUT = "1999-01-01"
AS_OF = "2002-01-01"


# Given schemas spare a job per table that would read them from the files.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": (
        "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
    ),
    "part": (
        "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
        "p_retailprice DOUBLE"
    ),
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
        "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
        "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"
    ),
    "events": (
        "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, "
        "props STRING"
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def funds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw product master: one row per part name."""
    return table(spark, sf_dir, "part").groupBy(F.col("p_name").alias("name")).agg(
        F.min("p_partkey").alias("id"), F.min("p_brand").alias("hpfid"), F.min("p_type").alias("sid")
    )


def listed_funds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A master that does not list the new funds yet, so some entries find no product."""
    return funds(spark, sf_dir).filter(~F.col("name").startswith("new "))


def entry_id() -> Column:
    return F.col("l_orderkey") * 10 + F.col("l_linenumber")


def history(spark: SparkSession, sf_dir: str, entry_date: str = "l_shipdate") -> DataFrame:
    """Raw portfolio history. With ``entry_date="o_orderdate"`` entries arrive late."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer")
    parts = table(spark, sf_dir, "part")
    fund_ids = funds(spark, sf_dir).select("name", F.col("id").alias("product_id"))
    fund_of_part = parts.join(fund_ids, parts["p_name"] == fund_ids["name"]).select(
        "p_partkey", "p_retailprice", "product_id"
    )
    # Orders meet their customers first, so that the line items are shuffled for two joins only, and the
    # line items their parts, of which fewer columns travel on than of orders.
    served = orders.join(customers, orders["o_custkey"] == customers["c_custkey"])
    funded = lines.join(fund_of_part, lines["l_partkey"] == fund_of_part["p_partkey"])
    joined = funded.join(served, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        entry_id().alias("id"),
        F.col("c_nationkey").cast("bigint").alias("agent_id"),
        F.col("l_suppkey").alias("selling_agent_id"),
        "product_id",
        F.col("o_custkey").alias("unit_holder_id"),
        F.col(entry_date).alias("date"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderdate").alias("updated_at"),
        F.col("p_retailprice").alias("current_nav"),
        F.col("p_retailprice").alias("run_nav_value"),
        F.col("l_quantity").alias("beginning_unit"),
        F.col("l_quantity").alias("subscription_unit"),
        F.col("l_discount").alias("redeem_unit"),
        F.col("l_tax").alias("dividend_unit"),
        F.col("l_quantity").alias("ending_unit"),
        F.col("o_totalprice").alias("capital"),
        F.col("l_extendedprice").alias("beginning_balance"),
        F.col("l_extendedprice").alias("ending_balance"),
        F.col("c_acctbal").alias("profit_or_loss"),
        F.col("l_discount").alias("profit_or_loss_in_percent"),
        F.col("c_name").alias("full_name"),
        (F.col("l_returnflag") == "R").alias("is_deleted"),
        F.col("l_shipdate").cast("date").alias("snapshot_date"),
        F.col("l_shipdate").alias("ingested_at"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw customer master. European branches have no name; KYC is the first order's date."""
    people = table(spark, sf_dir, "customer")
    nations = table(spark, sf_dir, "nation")
    regions = table(spark, sf_dir, "region")
    first_order = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("approved_kyc_at")
    )
    return (
        people.join(nations, people["c_nationkey"] == nations["n_nationkey"])
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .join(first_order, F.col("c_custkey") == F.col("o_custkey"), "left")
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.col("c_custkey").alias("unit_holder_id"),
            F.col("c_mktsegment").alias("sid"),
            F.col("c_nationkey").cast("bigint").alias("agent_id"),
            F.when(F.col("r_name") != "EUROPE", F.col("n_name")).alias("branch_name"),
            "approved_kyc_at",
            F.col("c_mktsegment").alias("customer_type"),
        )
    )
