"""Dated CSV snapshots and master CSVs."""

import csv
import logging
from collections import defaultdict
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    StringType,
    StructField,
    StructType,
)

from advisorbook.contracts import INGESTED_AT, SNAPSHOT_DATE
from advisorbook.functions.dates import date_from_name
from advisorbook.functions.text import null_tokens, strip
from advisorbook.operators.drift import kinds_of, type_of_kinds, union_with_drift, widened
from advisorbook.session import cut_lineage, setting
from advisorbook.sources.tables import UNTYPED

log = logging.getLogger(__name__)

# Where the snapshot date stands: in the file's own name, or in the name of its folder
# (a snapshot written as many part files).
FROM_FILE, FROM_FOLDER = "file", "folder"
_PATH_STEP = {FROM_FILE: -1, FROM_FOLDER: -2}
# The low bits of a monotonically increasing id count the rows of a partition.
_ROW_OF_PARTITION = (1 << 33) - 1


def _snapshot_date(path: Column, date_from: str) -> Column:
    return date_from_name(F.element_at(F.split(path, "/"), _PATH_STEP[date_from]))


def list_snapshots(
    spark: SparkSession, folder: str, glob: str = "*.csv", date_from: str = FROM_FILE
) -> DataFrame:
    """Snapshot files with size and date. A missing folder or a name without date fails.

    Only file names are read. Files in sub-folders count only with ``date_from="folder"``.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    if date_from == FROM_FOLDER:
        reader = reader.option("recursiveFileLookup", True)
    files = reader.load(folder).select("path", "length", "modificationTime", F.col("_metadata.file_path").alias("uri"))
    return files.withColumns({SNAPSHOT_DATE: _snapshot_date(F.col("path"), date_from), "date_from": F.lit(date_from)})


def read_header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Column names of one CSV as they stand in its first line."""
    first = spark.read.text(path).first()
    return () if first is None else parse_header(first["value"])


def parse_header(line: str) -> tuple[str, ...]:
    return tuple(next(csv.reader([line.lstrip("﻿")])))


def first_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """uri and first line of each file, in one job; empty files have none.

    Each split is a partition of its own, so the first row of a partition whose split opens its file is the line.
    """
    if not paths:
        return spark.createDataFrame([], "uri STRING, line STRING")
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    with setting(spark, "spark.sql.files.openCostInBytes", split):
        rows = spark.read.text(list(paths)).select(
            F.col("_metadata.file_path").alias("uri"), F.col("value").alias("line"),
            F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("row"),
        )
        opening = (F.col("row").bitwiseAND(F.lit(_ROW_OF_PARTITION)) == 0) & (F.col("start") == 0)
        return cut_lineage(rows.filter(opening).select("uri", "line"), "first-lines")


def read_heads(spark: SparkSession, files: DataFrame, catalog: str | None = None) -> DataFrame:
    """The listed files with their first ``line``, NULL for an empty file.

    With a table ``catalog`` lines are kept there by path and modification time, and only files
    it does not know are opened.
    """
    listed = cut_lineage(files, "listed-files")
    at = ["path", "modificationTime"]
    unseen, seen = listed, None
    if catalog is not None and spark.catalog.tableExists(catalog):
        known = spark.table(catalog).select(*at, "line").dropDuplicates(at)
        unseen = listed.join(known, at, "left_anti")
        seen = cut_lineage(listed.join(known, at), "known-heads")
    # Spark's own listing of a folder holds the paths on the driver too.
    lines = first_lines(spark, [r["path"] for r in unseen.select("path").collect()])
    heads = cut_lineage(unseen.join(lines, "uri", "left"), "heads")
    if catalog is not None and not heads.isEmpty():
        heads.select(*at, "line").write.mode("append").format("parquet").saveAsTable(catalog)
    return heads if seen is None else heads.unionByName(seen)


def trimmed_names(header: Sequence[str], path: str) -> list[str]:
    """Column names without surrounding whitespace; a repeated name fails."""
    names = [c.strip() for c in header]
    repeated = sorted({c for c in names if names.count(c) > 1})
    if repeated:
        raise ValueError(f"Duplicate column names in {path}: {repeated}")
    return names


def read_text_columns(
    spark: SparkSession, paths: Sequence[str], names: Sequence[str], multi_line: bool
) -> DataFrame:
    """CSV files with one header, all columns as cleaned text.

    A malformed line fails the read. Without ``multi_line`` large files are split over
    tasks, but a quoted field must not hold a line break.
    """
    schema = StructType([StructField(c, StringType()) for c in names])
    raw = (
        spark.read.schema(schema)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .option("multiLine", multi_line)
        .csv(list(paths))
    )
    return raw.select(
        *[strip(null_tokens(F.col(f"`{c}`"))).alias(c) for c in names],
        F.col("_metadata.file_path").alias("_path"),
    )


def typed(column: str, dtype: DataType) -> Column:
    """Text to ``dtype``; text that does not fit fails, naming the column."""
    text = F.col(f"`{column}`")
    value = text.try_cast(dtype)
    problem = F.concat(
        F.lit(f"Column {column}: not {dtype.simpleString()}: "), F.coalesce(text, F.lit(""))
    )
    failed = text.isNotNull() & value.isNull()
    return F.when(failed, F.raise_error(problem).cast(dtype)).otherwise(value).alias(column)


def infer_types(df: DataFrame, columns: Sequence[str]) -> dict[str, DataType]:
    """BIGINT, DOUBLE or BOOLEAN where every value fits, else text. One pass, one row out."""
    if not columns:
        return {}
    found = df.agg(*[kinds_of(F.col(f"`{c}`")).alias(str(i)) for i, c in enumerate(columns)]).first()
    return {c: type_of_kinds(found[i]) or StringType() for i, c in enumerate(columns)}


def drifted_types(
    groups: Sequence[tuple[DataFrame, Sequence[str]]], stored: Mapping[str, DataType | None]
) -> tuple[dict[str, DataType | None], list[bool]]:
    """Types of columns outside the contract, over files of several headers and what is stored.

    ``groups``, in the order of their dates, are texts and their drifted columns. One aggregation over
    all of them; a row per group and column comes back. Also tells which groups have rows.
    """
    states = [
        df.agg(F.count(F.lit(1)).alias("n"), *[kinds_of(F.col(f"`{c}`")).cast("int").alias(f"k{i}") for i, c in enumerate(columns)])
        .select(
            F.lit(g).alias("group"), "n",
            F.posexplode(F.array(F.lit(None).cast("int"), *[F.col(f"k{i}") for i in range(len(columns))])).alias("at", "kinds"),
        )
        for g, (df, columns) in enumerate(groups)
    ]
    if not states:
        return {}, []
    rows = reduce(DataFrame.unionByName, states).collect()
    filled = [any(r["group"] == g and r["n"] for r in rows) for g in range(len(groups))]
    types: dict[str, DataType | None] = {}
    for r in sorted(rows, key=lambda r: (r["group"], r["at"])):
        if r["at"] and filled[r["group"]]:
            column = groups[r["group"]][1][r["at"] - 1]
            types[column] = widened(column, types.get(column, stored.get(column)), type_of_kinds(r["kinds"]))
    return types, filled


def _with_types(df: DataFrame, names: Sequence[str], contract: Mapping[str, DataType]) -> DataFrame:
    unknown = infer_types(df, [c for c in names if c not in contract])
    types = {**contract, **unknown}
    return df.select(*[typed(c, types[c]) for c in names], "_path")


def read_csv(
    spark: SparkSession,
    paths: Sequence[str],
    header: Sequence[str],
    contract: Mapping[str, DataType],
    multi_line: bool = False,
) -> DataFrame:
    """CSV files sharing ``header``: trimmed names, cleaned text, contract types."""
    names = trimmed_names(header, paths[0])
    return _with_types(read_text_columns(spark, paths, names, multi_line), names, contract)


def read_snapshots(
    spark: SparkSession,
    files: DataFrame,
    contract: Mapping[str, DataType],
    multi_line: bool = False,
    stored: Mapping[str, DataType | None] | None = None,
    heads: str | None = None,
) -> DataFrame | None:
    """All rows of the listed snapshot files, with snapshot date and ingestion time.

    Files are grouped by header and each group is one scan. A column some files lack is
    NULL for their rows. A group without rows is skipped, its new columns too. Returns None
    when no file has rows. Columns outside the contract take the type that holds their values in
    all files and in ``stored``, the types of the table they go to; one without any value is text
    and marked. The number of jobs does not depend on that of files or headers. The driver sees
    file names and distinct header lines, never rows. ``heads`` names a table of known first lines.
    """
    listed = read_heads(spark, files, heads).filter(F.col("line").isNotNull())
    found = listed.groupBy("line", "date_from").agg(F.min(SNAPSHOT_DATE).alias("first"), F.sort_array(F.collect_list("path")).alias("paths"))
    found = sorted(found.collect(), key=lambda r: (r["first"], r["paths"][0]))
    groups: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for row in found:
        if header := parse_header(row["line"]):
            groups[header] += row["paths"]
    read, texts = [], []
    for header, members in groups.items():
        names = trimmed_names(header, members[0])
        read.append(names)
        texts.append(read_text_columns(spark, members, names, multi_line))
    drifted = [[c for c in names if c not in contract] for names in read]
    some = [k for k, columns in enumerate(drifted) if columns]
    types, filled = drifted_types([(texts[k], drifted[k]) for k in some], stored or {})
    empty = {k for k, has_rows in zip(some, filled, strict=True) if not has_rows}
    # The listing knows the date of each file; finding it in the path of every row would cost more than the rest.
    dates = F.broadcast(listed.select(F.col("uri").alias("_uri"), F.col(SNAPSHOT_DATE).alias("_date")).dropDuplicates(["_uri"]))
    frames = []
    for k, (names, text) in enumerate(zip(read, texts, strict=True)):
        if k in empty:
            log.warning("No rows under the header %s; skipped", names)
            continue
        kinds = {**{c: t or StringType() for c, t in types.items()}, **contract}
        path = F.url_decode(F.replace(F.col("_path"), F.lit("+"), F.lit("%2B")))
        date = F.coalesce("_date", _snapshot_date(path, found[0]["date_from"])).alias(SNAPSHOT_DATE)
        rows = text.join(dates, text["_path"] == dates["_uri"], "left").select(*[typed(c, kinds[c]) for c in names], date)
        frames.append(rows.withColumn(INGESTED_AT, F.col(SNAPSHOT_DATE).cast("timestamp_ntz")))
    if not frames:
        return None
    untyped = {"comment": UNTYPED}
    whole = union_with_drift(frames)
    return whole.select(*[F.col(f"`{c}`").alias(c, metadata=untyped) if c in types and types[c] is None else F.col(f"`{c}`") for c in whole.columns])


def read_master(
    spark: SparkSession, path: str, contract: Mapping[str, DataType], multi_line: bool = True
) -> DataFrame | None:
    """A master CSV, or None with a warning when the file is missing."""
    try:
        header = read_header(spark, path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        log.warning("Master file not found, skipped: %s", path)
        return None
    return read_csv(spark, [path], header, contract, multi_line).drop("_path")
