"""Every version of each key as a maintained table, partitioned by the version."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from advisorbook.operators.drift import align
from advisorbook.session import cut_lineage
from advisorbook.sources.change_log import StagedChange, partition_is
from advisorbook.sources.tables import add_new_columns, as_stored, create_partitioned, read_table, table_schema

INSERT, UPDATE, SAME = "insert", "update", "same"
_KIND = "_kind"


class HistoryTable:
    """One row per key and version (a snapshot date); loading a version again updates its rows in place.

    An increment reads the partitions of its versions only, classes each row as insert, update or same,
    and rewrites the partitions in which a row differs. Loading a date again writes nothing. Rows that a
    later file of the same date lacks stay. NULL keys and versions equal each other.
    """

    def __init__(self, spark: SparkSession, name: str, keys: Sequence[str], version: str, tiebreak: Sequence[str] = ()) -> None:
        self.spark, self.name, self.version = spark, name, version
        self.keys, self.tiebreak = [k for k in keys if k != version], list(tiebreak)

    def rows(self) -> DataFrame:
        return read_table(self.spark, self.name)

    def merge(self, source: DataFrame, change: StagedChange) -> DataFrame:
        """Stage the partitions that differ; returns version, ``kind`` and ``n`` (rows).

        Rows of one key and version in the source are settled by ``tiebreak``, then by the other columns.
        """
        spark, name, key = self.spark, self.name, [self.version, *self.keys]
        known = spark.catalog.tableExists(name)
        if not known:
            create_partitioned(spark, name, source.schema, self.version)
        source = as_stored(source, name)
        add_new_columns(spark, name, source.schema)
        schema: StructType = table_schema(spark, name)
        arrived, target = align(source, schema), spark.table(name)
        if known:
            arrived = cut_lineage(arrived, "history-source")
            met = [r[0] for r in arrived.select(self.version).distinct().collect()]  # one per date
            target = target.filter(partition_is(self.version, met))
        data = [c for c in schema.names if c not in key]
        leading = [c for c in self.tiebreak if c not in key]
        ordered = leading + [c for c in data if c not in leading]
        both = target.withColumn("_incoming", F.lit(0)).unionByName(arrived.withColumn("_incoming", F.lit(1)))

        def side(incoming: int, what: str):
            return F.max(F.when(F.col("_incoming") == incoming, F.struct(F.lit(1).alias("_"), *[F.col(f"`{c}`") for c in ordered]))).alias(what)

        merged = both.groupBy(*key).agg(side(0, "was"), side(1, "now"))
        kind = F.when(F.col("was").isNull(), INSERT).when(F.col("now").isNull() | F.col("was").eqNullSafe(F.col("now")), SAME)
        row = F.coalesce("now", "was")
        columns = [F.col(f"`{c}`") if c in key else row[c].alias(c) for c in schema.names]
        # Written once: the counts read their two columns of it, the commit the table's own ones.
        path, written = change.write(merged.select(*columns, kind.otherwise(UPDATE).alias(_KIND)))
        counts = written.groupBy(self.version, F.col(_KIND).alias("kind")).agg(F.count(F.lit(1)).alias("n"))
        counts = cut_lineage(counts, "history-counts")
        touched = [r[0] for r in counts.filter(F.col("kind") != SAME).select(self.version).distinct().collect()]
        stored = StructType([f for f in written.schema if f.name != _KIND])
        change.stage_written(path, stored, name, self.version, touched)
        return counts
