"""Catalog tables: create, replace, append with drift, keyed merge."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DoubleType, LongType, StringType, StructType

from advisorbook.operators.drift import align, check_types, new_columns
from advisorbook.operators.incremental import upsert
from advisorbook.session import cut_lineage, setting, shuffles_go


# Comment of a stored column that has had no value yet, so any type may still come.
UNTYPED = "no value yet"
# A column whose type widened stands in the table once per type, the later ones under these names; old files
# keep what they hold.
_WIDER = {f"__{t.simpleString()}": t for t in (LongType(), BooleanType(), DoubleType(), StringType())}


def _stored_types(schema: StructType) -> dict[str, dict[DataType, str]]:
    """Per column, its stored forms in the order in which they came; an untyped one has the type None."""
    names, forms = set(schema.names), {}
    for f in schema:
        base, mark, kind = f.name.rpartition("__")
        if mark and base in names and _WIDER.get(mark + kind) == f.dataType:
            forms.setdefault(base, {})[f.dataType] = f.name
        else:
            untyped = f.metadata.get("comment") == UNTYPED
            forms[f.name] = {None if untyped else f.dataType: f.name} | forms.get(f.name, {})
    return forms


def column_types(spark: SparkSession, table: str) -> dict[str, DataType | None]:
    """The type of each column as ``read_table`` gives it; None where no value has come yet."""
    forms = _stored_types(table_schema(spark, table))
    return {c: next((t for t in reversed(_WIDER.values()) if len(f) > 1 and t in f), next(iter(f))) for c, f in forms.items()}


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """The table with each column once, at its widest type. Filters still reach the files."""
    forms, types = _stored_types(table_schema(spark, table)), column_types(spark, table)
    if all(len(f) == 1 for f in forms.values()):
        return spark.table(table)

    def whole(column: str) -> Column:
        parts = [F.col(f"`{n}`").cast(types[column]) for n in forms[column].values()]
        return (F.coalesce(*parts) if len(parts) > 1 else F.col(f"`{column}`")).alias(column)

    return spark.table(table).select(*[whole(c) for c in forms])


def as_stored(df: DataFrame, table: str) -> DataFrame:
    """``df``, whose types hold those of the table, with each column under the name of its type there."""
    spark = df.sparkSession
    forms, names = _stored_types(table_schema(spark, table)), {}
    for f in df.schema:
        stored = forms.get(f.name)
        if stored is None or f.dataType in stored or f.metadata.get("comment") == UNTYPED:
            names[f.name] = f.name if stored is None else stored.get(f.dataType, f.name)
        elif None in stored and f.dataType == StringType():
            spark.sql(f"ALTER TABLE {table} ALTER COLUMN `{f.name}` COMMENT ''")
        elif f"__{f.dataType.simpleString()}" in _WIDER:
            names[f.name] = f"{f.name}__{f.dataType.simpleString()}"
    return df.withColumnsRenamed({old: new for old, new in names.items() if old != new})


def create_database(spark: SparkSession, name: str, location: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{location}'")


def table_schema(spark: SparkSession, table: str) -> StructType:
    """The table's columns; none for a missing table."""
    return spark.table(table).schema if spark.catalog.tableExists(table) else StructType()


def replace_table(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
    """Drop and rebuild, so a rerun gives the same table."""
    df.write.mode("overwrite").partitionBy(*partition_by).format("parquet").saveAsTable(table)


def replace_counted(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> int:
    """Like ``replace_table``; returns the number of rows, observed while they are written."""
    written = Observation()
    replace_table(df.observe(written, F.count(F.lit(1)).alias("rows")), table, partition_by)
    return written.get.get("rows", 0)


def create_partitioned(spark: SparkSession, table: str, schema: StructType, partition: str) -> None:
    """An empty table, so that later steps only replace partitions."""
    empty = spark.createDataFrame([], schema)
    empty.write.partitionBy(partition).format("parquet").saveAsTable(table)


def add_new_columns(spark: SparkSession, table: str, incoming: StructType) -> None:
    """Add the columns the table lacks; older rows read them as NULL, no file is rewritten."""
    existing = table_schema(spark, table)
    check_types(existing, incoming)
    added = new_columns(existing, incoming)
    if added:
        told = {f.name: f" COMMENT '{UNTYPED}'" for f in incoming if f.metadata.get("comment") == UNTYPED}
        columns = ", ".join(f"`{c}` {t.simpleString()}{told.get(c, '')}" for c, t in added.items())
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")


def append_table(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
    """Append with additive drift, creating the table if it is missing.

    A frame without rows is skipped and adds no columns.
    """
    spark = df.sparkSession
    existing = table_schema(spark, table)
    if not existing:
        if not df.isEmpty():
            replace_table(df, table, partition_by)
        return
    check_types(existing, df.schema)
    if new_columns(existing, df.schema) and df.isEmpty():
        return
    add_new_columns(spark, table, df.schema)
    align(df, table_schema(spark, table)).write.insertInto(table)


def replace_partitions(df: DataFrame, table: str) -> None:
    """Overwrite the partitions that occur in ``df`` and leave the others.

    ``df`` must not read ``table``. Rows are spread so that each partition gets few files
    and a large partition is still written by many tasks.
    """
    spark = df.sparkSession
    schema = table_schema(spark, table)
    by = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    aligned = align(df, schema).hint("rebalance", *by)
    with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"), shuffles_go(spark):
        aligned.write.insertInto(table, overwrite=True)


def require_unique(source: DataFrame, keys: Sequence[str], table: str) -> None:
    """Fail, naming one of them, where keys occur more than once; NULL equals NULL."""
    times = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("times"))
    repeated = times.filter("times > 1").first()
    if repeated:
        found = ", ".join(f"{k}={repeated[k]}" for k in keys)
        raise ValueError(f"Source of {table} holds a key {repeated['times']} times: {found}")


def merge_table(
    source: DataFrame, table: str, keys: Sequence[str], partition: str
) -> None:
    """Keyed upsert into a table partitioned by the key column ``partition``.

    The source is written once to the shared folder. Only the partitions it touches are
    read, merged and swapped; the merged rows are written before the swap, so losing
    executors or failing midway leaves the table readable and the merge can run again.
    A key that the source holds twice fails before the table changes.
    """
    spark = source.sparkSession
    staged = cut_lineage(source, "merge-source")
    require_unique(staged, keys, table)
    if not spark.catalog.tableExists(table):
        replace_table(staged, table, [partition])
        return
    add_new_columns(spark, table, staged.schema)
    touched = [r[0] for r in staged.select(partition).distinct().collect()]
    if not touched:
        return
    here = F.col(partition).isin([v for v in touched if v is not None])
    if None in touched:
        here = here | F.col(partition).isNull()
    merged = upsert(spark.table(table).filter(here), staged, keys)
    replace_partitions(cut_lineage(merged, "merge-result"), table)
