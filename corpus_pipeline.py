"""From raw documents to packed training sequences, stage by stage.

Each stage takes all rows its predecessor kept and is written as Parquet before the next one
reads it, so a lost executor costs a re-read. All but the last return the columns of
``documents``.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from advisorbook.llm import contamination, jaccard, packing, pii, quality
from advisorbook.llm.encoding import public_vocabulary
from advisorbook.session import cut_lineage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.keep_good(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8) the document of least id."""
    return jaccard.keep_first(docs, share=80, words=5)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return contamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked."""
    return pii.mask_private(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of training sequences."""
    return packing.pack(docs, public_vocabulary("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", good_documents),
    ("ngram_jaccard_join", one_of_each),
    ("benchmark_decontamination", without_benchmark),
    ("pii", without_private),
    ("packing", packed),
]

# Tokenization cannot be expressed in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, one after the other, over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
