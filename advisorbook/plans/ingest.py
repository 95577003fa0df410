"""Load snapshots and master files into raw tables."""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from advisorbook.contracts import PORTFOLIO_HISTORY, SNAPSHOT_DATE
from advisorbook.operators.checks import require_rows
from advisorbook.sources.snapshots import FROM_FILE, list_snapshots, read_master, read_snapshots
from advisorbook.sources.tables import (
    add_new_columns,
    as_stored,
    column_types,
    replace_counted,
    replace_partitions,
    replace_table,
)


def rebuild_history(
    spark: SparkSession,
    folder: str,
    table: str,
    contract: Mapping[str, DataType] = PORTFOLIO_HISTORY,
    glob: str = "*.csv",
    date_from: str = FROM_FILE,
    heads: str | None = None,
) -> DataFrame:
    """Load every snapshot in the folder into a new history. Returns the load metrics.

    Each task writes straight into the partition of its file's date: no shuffle. Files without
    any row fail before the old history goes.
    """
    files = list_snapshots(spark, folder, glob, date_from)
    rows = read_snapshots(spark, files, contract, heads=heads)
    if rows is None:
        raise ValueError(f"No snapshot rows in {folder}")
    require_rows(rows, table)
    replace_table(rows, table, [SNAPSHOT_DATE])
    return load_metrics(spark.table(table), files)


def load_new_dates(
    spark: SparkSession,
    folder: str,
    table: str,
    dates: Sequence,
    contract: Mapping[str, DataType] = PORTFOLIO_HISTORY,
    glob: str = "*.csv",
    date_from: str = FROM_FILE,
    heads: str | None = None,
) -> None:
    """Load all files of the given snapshot dates, replacing what the table has for them.

    Loading a date twice gives the same table. A column whose type widens is read at the wider
    type by ``read_table``; no older file is rewritten.
    """
    files = list_snapshots(spark, folder, glob, date_from)
    chosen = files.filter(F.col(SNAPSHOT_DATE).isin(list(dates)))
    rows = read_snapshots(spark, chosen, contract, stored=column_types(spark, table), heads=heads)
    if rows is None:
        return
    if spark.catalog.tableExists(table):
        rows = as_stored(rows, table)
        add_new_columns(spark, table, rows.schema)
        replace_partitions(rows, table)
    else:
        replace_table(rows, table, [SNAPSHOT_DATE])


def load_master(
    spark: SparkSession, path: str, table: str, contract: Mapping[str, DataType]
) -> int | None:
    """Replace a master table; its rows, counted by the write, or None when the file is missing."""
    rows = read_master(spark, path, contract)
    if rows is None:
        return None
    return replace_counted(rows, table)


def load_metrics(history: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Rows per snapshot date; with ``files`` also their number and size, and 0 for empty dates.

    Counting a stored table by its partition column reads file footers, not data.
    """
    counts = history.groupBy(SNAPSHOT_DATE).agg(F.count(F.lit(1)).alias("rows_input"))
    if files is None:
        return counts
    per_date = files.groupBy(SNAPSHOT_DATE).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")
    )
    return per_date.join(counts, SNAPSHOT_DATE, "left").withColumn(
        "rows_input", F.coalesce("rows_input", F.lit(0))
    )


def load_summary(metrics: DataFrame, master_rows: Mapping[str, int | None]) -> dict[str, int]:
    """History rows, and all rows processed with the master tables included."""
    history = metrics.agg(F.coalesce(F.sum("rows_input"), F.lit(0))).first()[0]
    masters = sum(n for n in master_rows.values() if n is not None)
    return {"history_rows": history, "rows_processed": history + masters}
