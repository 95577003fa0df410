"""Column contracts of the raw tables. Columns outside a contract arrive as drift."""

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    LongType,
    StringType,
    TimestampNTZType,
)

_LONG, _DOUBLE, _TEXT = LongType(), DoubleType(), StringType()

PORTFOLIO_HISTORY: dict[str, DataType] = {
    "id": _LONG,
    "agent_id": _LONG,
    "selling_agent_id": _LONG,
    "product_id": _LONG,
    "unit_holder_id": _LONG,
    "date": _TEXT,
    "created_at": _TEXT,
    "updated_at": _TEXT,
    "current_nav": _DOUBLE,
    "run_nav_value": _DOUBLE,
    "beginning_unit": _DOUBLE,
    "subscription_unit": _DOUBLE,
    "redeem_unit": _DOUBLE,
    "dividend_unit": _DOUBLE,
    "ending_unit": _DOUBLE,
    "capital": _DOUBLE,
    "beginning_balance": _DOUBLE,
    "ending_balance": _DOUBLE,
    "profit_or_loss": _DOUBLE,
    "profit_or_loss_in_percent": _DOUBLE,
    "full_name": _TEXT,
    "is_deleted": BooleanType(),
}

CUSTOMERS: dict[str, DataType] = {
    "customer_id": _LONG,
    "customer_name": _TEXT,
    "unit_holder_id": _LONG,
    "sid": _TEXT,
    "agent_id": _LONG,
    "agent_code": _TEXT,
    "agent_name": _TEXT,
    "agent_name_clean": _TEXT,
    "branch_name": _TEXT,
    "approved_kyc_at": _TEXT,
    "customer_type": _TEXT,
}

PRODUCTS: dict[str, DataType] = {
    "id": _LONG,
    "hpfid": _TEXT,
    "siar_code": _TEXT,
    "sinvest_code": _TEXT,
    "sid": _TEXT,
    "ifua": _TEXT,
    "ifca": _TEXT,
    "name": _TEXT,
    "logo": _TEXT,
    "description": _TEXT,
}

# Added to every snapshot row.
SNAPSHOT_DATE = "snapshot_date"
INGESTED_AT = "ingested_at"
METADATA: dict[str, DataType] = {SNAPSHOT_DATE: DateType(), INGESTED_AT: TimestampNTZType()}

# Money is summed as a decimal, so totals do not depend on the order of rows. Eight decimals
# keep what units times a net asset value carry; a balance beyond it stops the run.
MONEY = DecimalType(28, 8)

# Grain of the monthly fact.
KPI_KEYS = ("agent_id", "month_start_date")
