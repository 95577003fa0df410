"""Replace partitions of several tables as one change that a failure cannot leave half done."""

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from advisorbook.session import shuffles_go, work_path
from advisorbook.sources.tables import replace_partitions

READY, DONE = "ready", "done"
_LOG = (
    "batch BIGINT, state STRING, step INT, name STRING, path STRING, fields STRING, "
    "partition STRING, touched ARRAY<STRING>, note STRING"
)


def _append(spark: SparkSession, log: str, rows: list[tuple]) -> None:
    """One file, so a state is written wholly or not at all."""
    spark.createDataFrame(rows, _LOG).coalesce(1).write.mode("append").format("parquet").saveAsTable(log)


def partition_is(column: str, values: Sequence) -> Column:
    """Rows of the given partitions; the values stand in the query, so other files are not read."""
    here = F.col(column).isin([v for v in values if v is not None])
    return here | F.col(column).isNull() if None in values else here


def _apply(spark: SparkSession, step) -> None:
    """Make the touched partitions equal to the staged rows; those without rows are dropped.

    The staged files may hold further columns, and rows of partitions that did not change.
    """
    rows = spark.read.schema(StructType.fromDDL(step["fields"])).parquet(step["path"])
    name, column = step["name"], step["partition"]
    held = [r[0] for r in rows.select(column).distinct().collect()]
    here = [v for v in held if (None if v is None else str(v)) in step["touched"]]
    present = {None if v is None else str(v) for v in here}
    if present:
        replace_partitions(rows if len(here) == len(held) else rows.filter(partition_is(column, here)), name)
    for value in step["touched"]:
        if value not in present:
            told = "null" if value is None else f"'{value}'"
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (`{column}` = {told})")


def _finish(spark: SparkSession, log: str, batch: int) -> None:
    found = spark.table(log).filter((F.col("batch") == batch) & (F.col("state") == READY))
    for step in found.orderBy("step").collect():  # one row per table
        if step["name"] is not None:
            _apply(spark, step)
    _append(spark, log, [(batch, DONE, -1, None, None, None, None, None, None)])


def recover(spark: SparkSession, log: str) -> int:
    """Finish changes that were staged wholly but not applied to the end. Returns how many.

    Applying one again gives the same tables, as it replaces whole partitions by staged rows.
    A change that failed earlier has no entry and left no trace in any table.
    """
    if not spark.catalog.tableExists(log):
        return 0
    states = spark.table(log).groupBy("batch").agg(F.max((F.col("state") == DONE).cast("int")).alias("done"))
    open_batches = sorted(r["batch"] for r in states.filter("done = 0").collect())
    for batch in open_batches:
        _finish(spark, log, batch)
    return len(open_batches)


def notes(spark: SparkSession, log: str) -> set[str]:
    """What the finished changes noted."""
    if not spark.catalog.tableExists(log):
        return set()
    noted = spark.table(log).filter(F.col("note").isNotNull()).select("note").distinct()
    return {r["note"] for r in noted.collect()}


class StagedChange:
    """New contents of partitions, written to the shared folder first and swapped in by ``commit``.

    One change at a time per log. Readers may see some tables swapped and others not yet.
    """

    def __init__(self, spark: SparkSession, log: str) -> None:
        self.spark, self.log, self.steps = spark, log, []

    def stage(self, rows: DataFrame, name: str, partition: str, touched: Sequence) -> DataFrame:
        """Write the new rows of the ``touched`` partitions of a table; returns them as written."""
        if not touched:
            return rows.limit(0)
        path, written = self.write(rows)
        self.stage_written(path, rows.schema, name, partition, touched)
        return written

    def write(self, rows: DataFrame, by: Sequence[str] = ()) -> tuple[str, DataFrame]:
        """Write rows that ``stage_written`` may stage later; returns their path, and the rows as written."""
        path = work_path(self.spark, "staged")
        with shuffles_go(self.spark):
            rows.write.partitionBy(*by).option("compression", "zstd").parquet(path)
        return path, self.spark.read.schema(rows.schema).parquet(path)

    def stage_written(self, path: str, schema: StructType, name: str, partition: str, touched: Sequence) -> None:
        """Stage the columns of ``schema`` and the ``touched`` partitions of rows that are written already."""
        if touched:
            told = [v.isoformat() if isinstance(v, dt.date) else None if v is None else str(v) for v in touched]
            self.steps.append((name, path, schema.toDDL(), partition, told))

    def commit(self, noted: Sequence[str] = ()) -> None:
        """From the log entry on the change counts, whatever fails; then the partitions are swapped."""
        last = 0
        if self.spark.catalog.tableExists(self.log):
            last = self.spark.table(self.log).agg(F.max("batch")).first()[0] or 0
        steps = [(last + 1, READY, k, *step, None) for k, step in enumerate(self.steps)]
        steps += [(last + 1, READY, len(steps), None, None, None, None, None, n) for n in noted]
        if steps:
            _append(self.spark, self.log, steps)
            _finish(self.spark, self.log, last + 1)
        self.steps = []
