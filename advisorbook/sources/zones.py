"""Least and greatest business month per snapshot partition, kept at load, to read only what a lookback needs."""

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from advisorbook.functions.dates import business_date, month_start
from advisorbook.sources.change_log import partition_is


class ZoneTable:
    """Zones of the partitions of a history that is partitioned by ``version``, the snapshot's date or month.

    A month is recomputed whole from the newest version of each id. Partitions older than the first one
    that holds a kept month cannot matter: they hold no row of such a month, and no version newer than
    one that does. Later partitions are all read, as they may move an id out of the month.
    """

    def __init__(self, spark: SparkSession, name: str, version: str) -> None:
        self.spark, self.name, self.version = spark, name, version

    def record(self, history: DataFrame, versions: Sequence | None = None) -> None:
        """Add the zones of the given partitions, or of all. Reads their business dates only."""
        if versions is not None:
            history = history.filter(partition_is(self.version, versions))
        month = month_start(business_date(F.col("date")))
        zones = history.groupBy(self.version).agg(F.min(month).alias("first_month"), F.max(month).alias("last_month"))
        zones.coalesce(1).write.mode("append").format("parquet").saveAsTable(self.name)

    def first_needed(self, since: dt.date) -> dt.date | None:
        """The oldest partition with a month after ``since``. A partition loaded again has several zones; any counts."""
        needed = self.spark.table(self.name).filter(F.col("last_month") > F.lit(since))
        return needed.agg(F.min(self.version)).first()[0]

    def rows_since(self, history: DataFrame, since: dt.date) -> DataFrame:
        """The rows that months after ``since`` depend on; a literal bound, so other partitions are not read."""
        first = self.first_needed(since)
        return history.filter(F.col(self.version) >= F.lit(first) if first is not None else F.lit(False))
