"""Load snapshot files as they arrive."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DataType

from advisorbook.contracts import PORTFOLIO_HISTORY, SNAPSHOT_DATE
from advisorbook.functions.dates import date_from_name
from advisorbook.plans.ingest import load_new_dates

# The columns of the binaryFile source; only the path is read.
_FILES = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def load_arrivals(
    spark: SparkSession,
    folder: str,
    table: str,
    checkpoint: str,
    contract: Mapping[str, DataType] = PORTFOLIO_HISTORY,
    glob: str = "*.csv",
) -> StreamingQuery:
    """Load the files that arrived since the last call, then stop.

    The stream carries file names only and keeps track of which were seen. Each batch
    reloads its snapshot dates whole, so a batch that is tried again changes nothing.
    """
    names = (
        spark.readStream.format("binaryFile")
        .schema(_FILES)
        .option("pathGlobFilter", glob)
        .load(folder)
        .select(F.element_at(F.split("path", "/"), -1).alias("name"))
    )
    dates = names.select(date_from_name(F.col("name")).alias(SNAPSHOT_DATE))

    def load(batch: DataFrame, _: int) -> None:
        found = [r[0] for r in batch.distinct().orderBy(SNAPSHOT_DATE).collect()]
        if found:
            # In the caller's session, so that its cached file list follows the swap.
            load_new_dates(spark, folder, table, found, contract, glob)

    return (
        dates.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(load)
        .start()
    )
