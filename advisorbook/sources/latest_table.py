"""The newest version of each id as a maintained table."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from advisorbook.operators.drift import align
from advisorbook.operators.incremental import version_changes
from advisorbook.session import cut_lineage
from advisorbook.sources.change_log import StagedChange, partition_is
from advisorbook.sources.tables import add_new_columns, as_stored, create_partitioned, read_table, table_schema

BUCKET = "_bucket"
BUCKETS = 64
_CHANGED, _BEFORE = "_changed", "_before"
_PROPERTY = "advisorbook.buckets"


class LatestTable:
    """One row per key, partitioned by a hash of the key into buckets.

    An increment reads the buckets its keys fall into and rewrites those in which a row changed;
    no other file is opened. A row gives way only to an equal or newer ``version``, so snapshots
    may be loaded in any order, and loading one again writes nothing. ``buckets`` counts when the
    table is created; take so many that one bucket is some hundred megabytes.
    """

    def __init__(
        self, spark: SparkSession, name: str, keys: Sequence[str], version: str,
        tiebreak: Sequence[str] = (), buckets: int = BUCKETS,
    ) -> None:
        self.spark, self.name, self.keys, self.version, self.tiebreak = spark, name, list(keys), version, list(tiebreak)
        self.buckets = buckets
        if spark.catalog.tableExists(name):
            found = spark.sql(f"SHOW TBLPROPERTIES {name}").filter(F.col("key") == _PROPERTY).first()
            if found is None:
                raise ValueError(f"{name} is not a table of latest rows")
            self.buckets = int(found["value"])

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def rows(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """The table, or some of its buckets."""
        table = read_table(self.spark, self.name)
        return (table if buckets is None else table.filter(partition_is(BUCKET, buckets))).drop(BUCKET)

    def _create(self, schema: StructType) -> None:
        fields = [*schema.fields, StructField(BUCKET, IntegerType())]
        create_partitioned(self.spark, self.name, StructType(fields), BUCKET)
        self.spark.sql(f"ALTER TABLE {self.name} SET TBLPROPERTIES ('{_PROPERTY}' = '{self.buckets}')")

    def merge(self, source: DataFrame, change: StagedChange) -> DataFrame:
        """Stage the merged buckets and return the rows that change: the keys, ``before`` and ``after``.

        ``before`` is NULL for a new key. New columns of the source are added to the table at once;
        columns it lacks are NULL in its rows. The table changes when ``change`` is committed.
        """
        spark, known = self.spark, self.spark.catalog.tableExists(self.name)
        if not known:
            self._create(source.schema)
        source = as_stored(source, self.name)
        add_new_columns(spark, self.name, source.schema)
        schema = StructType([f for f in table_schema(spark, self.name) if f.name != BUCKET])
        incoming, target = align(source, schema).withColumn(BUCKET, self._bucket()), spark.table(self.name)
        if known:
            incoming = cut_lineage(incoming, "latest-source")
            met = [r[0] for r in incoming.select(BUCKET).distinct().collect()]  # at most the buckets
            target = target.filter(partition_is(BUCKET, met))
        merged = version_changes(target, incoming, [BUCKET, *self.keys], self.version, self.tiebreak)
        data = [c for c in schema.names if c not in self.keys]
        flat = merged.select(
            *[F.col(f"`{c}`") if c in self.keys else F.col("after")[c].alias(c) for c in schema.names], BUCKET,
            (~F.col("before").eqNullSafe(F.col("after"))).alias(_CHANGED),
            F.when(~F.col("before").eqNullSafe(F.col("after")), F.col("before")).alias(_BEFORE),
        )
        # Written once: the changes read it, and the commit reads the table's own columns of it.
        path, written = change.write(flat)
        changes = written.filter(_CHANGED)
        touched = [r[0] for r in changes.select(BUCKET).distinct().collect()]
        stored = StructType([f for f in written.schema if f.name not in (_CHANGED, _BEFORE)])
        change.stage_written(path, stored, self.name, BUCKET, touched)
        after = F.struct(*[F.col(f"`{c}`") for c in data]).alias("after")
        return changes.select(*[F.col(f"`{c}`") for c in self.keys], F.col(_BEFORE).alias("before"), after)
