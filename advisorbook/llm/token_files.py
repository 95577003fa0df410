"""Token ids in Parquet files: a list column and narrow columns to find one's way.

Layout of a folder: ``tokens/`` holds a row per document in ascending doc_id order, over
files in order of their ``part``: ``doc_id``, ``part``, ``offset`` (ids before it in its
part), ``n_tokens``, ``tokens``. Ids are dictionary-encoded (a page holds bit-packed indexes
into the ids of its row group), the counting columns are delta-encoded, row groups and pages
are kept small enough for the page index to skip the rest. ``parts/`` has for each part how
many ids come before it, so the place of a document in the whole is a sum of two numbers and
nothing is renumbered.

Documents with equal doc_id stand in order of a hash of their texts; a null doc_id comes
first; a null text is empty and has the end id alone. Further columns are left behind. An
empty table gives empty files.
"""

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from advisorbook.llm.common import column, text_key, whole_text
from advisorbook.llm.encoding import Encoder, batches_of_text

SCHEMA = "doc_id long, part int, offset long, n_tokens long, tokens array<int>"


def write_tokens(
    docs: DataFrame,
    path: str,
    vocabulary: str,
    end_id: int,
    byte_level: bool = False,
    row_group_bytes: int = 32 << 20,
    page_bytes: int = 256 << 10,
) -> None:
    """Encode every whole text and write the files."""

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, offset = Encoder.of(vocabulary, byte_level), TaskContext.get().partitionId(), 0
        for batch in batches_of_text(batches):
            found = [ids for ids, _ in encoder.documents(batch.column(1), end_id)]
            n = np.fromiter(map(len, found), np.int64, len(found))
            ends = np.cumsum(n)
            flat = pa.array(np.concatenate(found).view(np.int32))
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), flat)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.full(len(n), part, np.int32)), pa.array(offset + ends - n), pa.array(n), lists],
                ["doc_id", "part", "offset", "n_tokens", "tokens"],
            )
            offset += int(ends[-1])

    rows = docs.select(column("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"), text_key().alias("h"))
    ordered = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h")
    files = ordered.select("doc_id", "text").mapInArrow(encode, SCHEMA).write
    options = {
        "compression": "zstd",
        "parquet.writer.version": "PARQUET_2_0",
        "parquet.block.size": row_group_bytes,
        "parquet.page.size": page_bytes,
        "parquet.enable.dictionary": "true",
        "parquet.dictionary.page.size": 1 << 20,
        **{f"parquet.enable.dictionary#{c}": "false" for c in ("doc_id", "offset", "n_tokens")},
    }
    files.options(**options).parquet(f"{path}/tokens")
    totals = tokens_only(docs.sparkSession, path).groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    starts = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    starts.write.parquet(f"{path}/parts")


def tokens_only(spark: SparkSession, path: str) -> DataFrame:
    """The files' rows as they stand; columns that are not selected are not read."""
    return spark.read.schema(SCHEMA).parquet(f"{path}/tokens")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The rows with ``start``, the number of ids of all documents before each."""
    parts = spark.read.schema("part int, part_start long").parquet(f"{path}/parts")
    return tokens_only(spark, path).join(parts, "part").select(
        "doc_id", (F.col("part_start") + F.col("offset")).alias("start"), "n_tokens", "tokens"
    )


def list_crc32(lists: pa.ListArray) -> list[int]:
    """Unsigned CRC-32 of each list's ids as little-endian 32-bit integers."""
    flat = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), "<u4")).cast("B")
    at = lists.offsets.to_numpy()
    return [zlib.crc32(flat[4 * a : 4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """A row per document from the files: where its ids stand, how many they are, their CRC-32."""

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crc = pa.array(list_crc32(batch.column(4)), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], crc], [*batch.schema.names[:4], "ids_crc32"])

    schema = "doc_id long, part int, offset long, n_tokens long, ids_crc32 long"
    found = tokens_only(spark, path).mapInArrow(digest, schema)
    parts = spark.read.schema("part int, part_start long").parquet(f"{path}/parts")
    return found.join(parts, "part").select(
        "doc_id", (F.col("part_start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )
