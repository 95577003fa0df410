"""Session settings and the shared work folder."""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Settings the plans are written for. All but the last two are Spark's defaults.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
    "spark.sql.session.timeZone": "UTC",
    # Call-site capture costs one JVM round trip per column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only a local session without the setting gets a temporary folder.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"Set {CHECKPOINT_DIR} to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="advisorbook-")
    spark.conf.set(CHECKPOINT_DIR, folder)
    return folder


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_folder(spark)}/advisorbook/{name}-{uuid.uuid4().hex}"


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for one write: ``insertInto`` takes no such option of its own."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def shuffles_go(spark: SparkSession):
    """Writes in this block leave no shuffle files: nothing reads them again once the rows are written.

    Else they stay on the executors' disks until the driver collects its garbage, which may be never in a
    long run of writes. A Spark without the setting (before 4.1) keeps them that long.
    """
    return setting(spark, SHUFFLE_CLEANUP, "true")


def cut_lineage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Use where one result feeds several branches: lost executors then cost a re-read,
    not a recomputation, and every branch sees the same rows.
    """
    path = work_path(df.sparkSession, name)
    with shuffles_go(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
