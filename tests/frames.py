"""Small frames in the shape of the raw and staged tables."""

import datetime as dt

from pyspark.sql.types import StructField, StructType

from advisorbook.contracts import CUSTOMERS, METADATA, PORTFOLIO_HISTORY, PRODUCTS
from advisorbook.plans.dimensions import dim_product
from advisorbook.plans.staging import KPI_INPUTS, stage_portfolio, stage_products


def _schema(contract):
    return StructType([StructField(name, dtype) for name, dtype in contract.items()])


def day(text):
    return dt.date.fromisoformat(text)


def raw(spark, *rows):
    """Raw history; unnamed columns take harmless values."""
    schema = _schema({**PORTFOLIO_HISTORY, **METADATA})
    values = []
    for i, row in enumerate(rows, 1):
        snapshot = day(row.get("snapshot", "2026-01-10"))
        full = {
            "id": i,
            "agent_id": 1,
            "product_id": 1,
            "unit_holder_id": 10,
            "date": "2026-01-05",
            "ending_balance": 100.0,
            "is_deleted": False,
            "snapshot_date": snapshot,
            "ingested_at": dt.datetime.combine(snapshot, dt.time()),
            **{k: v for k, v in row.items() if k != "snapshot"},
        }
        values.append(tuple(full.get(f.name) for f in schema))
    return spark.createDataFrame(values, schema)


def staged(spark, *rows):
    return stage_portfolio(raw(spark, *rows), KPI_INPUTS)


# One invented fund per rule, two that match two rules, one that matches none.
FUNDS = (
    (1, "Dana Saham Utama", "Saham", "equity_campuran"),
    (2, "Dana Ekuitas Satu", "Ekuitas", "equity_campuran"),
    (3, "Dana Government Bond", "Obligasi", "fixed_income"),
    (4, "Dana Obligasi Tetap", "Obligasi", "fixed_income"),
    (5, "Dana Campuran Seimbang", "Campuran", "equity_campuran"),
    (6, "Dana Pasar Uang", "Money Market", "fixed_income"),
    (7, "Dana Money Market Syariah", "Syariah", "equity_campuran"),
    (8, "Dana Terproteksi Lima", "Terproteksi", "fixed_income"),
    (9, "Dana Penyertaan Terbatas Alfa", "Penyertaan Terbatas", "fixed_income"),
    (10, "Dana Syariah SAHAM", "Saham", "equity_campuran"),
    (11, "Dana Lain", "Unknown", "equity_campuran"),
)


def raw_products(spark, ids=None):
    schema = _schema(PRODUCTS)
    rows = [
        tuple({"id": i, "hpfid": f"F{i}", "sid": f"S{i}", "name": name}.get(f.name) for f in schema)
        for i, name, _, _ in FUNDS
        if ids is None or i in ids
    ]
    return spark.createDataFrame(rows, schema)


def products(spark, ids=None):
    return dim_product(stage_products(raw_products(spark, ids)))


def raw_customers(spark, *rows):
    schema = _schema(CUSTOMERS)
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], schema)


def rows_of(df, *columns):
    """Sorted tuples, for comparison."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
