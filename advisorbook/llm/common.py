"""Small helpers of the operators."""

import sys

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def column(name: str) -> Column:
    """A top-level column, whatever characters its name has."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole_text(name: str = "text") -> Column:
    """The text of a row; null counts as empty."""
    return F.coalesce(column(name), F.lit(""))


def text_key(name: str = "text") -> Column:
    """A hash that, next to the id, tells rows that share an id apart."""
    return F.xxhash64(whole_text(name))


def worker_cache(name: str) -> dict:
    """A dict that lives as long as the Python worker, across its tasks."""
    return sys.modules["__main__"].__dict__.setdefault("_advisorbook_caches", {}).setdefault(name, {})


def utf8_texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The texts of a batch as UTF-8; null counts as empty."""
    texts = batch.column(batch.schema.get_field_index(name)).cast(pa.large_binary())
    return [b or b"" for b in texts.to_pylist()]
