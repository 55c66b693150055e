"""The corpus pipeline: documents to packed training sequences, in five stages.

Every stage works on all rows that the one before it kept, written as Parquet and read again. The first four return rows with the
columns of ``documents``; the last one returns the pieces of the packed sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm.common import stored, table
from marketlake.llm.mixing import mixed_rows
from marketlake.llm.neardup import drop_near_duplicates
from marketlake.llm.packing import pack_documents
from marketlake.llm.quality import keep_quality
from marketlake.llm.queries import vocabulary
from marketlake.llm.substrings import drop_repeated_strings

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are near enough to their language's histograms."""
    return keep_quality(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each class of exact and near copies."""
    return drop_near_duplicates(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the strings of 50 bytes that one with a smaller id has; ``n_chars`` follows the text."""
    cut = drop_repeated_strings(docs)
    if "n_chars" in cut.columns:
        cut = cut.withColumn("n_chars", F.coalesce(F.length("text"), F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return cut


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of the sources takes it."""
    return mixed_rows(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 4096 tokens."""
    return pack_documents(docs, vocabulary())


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_dedup),
    ("suffix-array dedup", suffix_dedup),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack),
]

#: SQL can't express the near-copy classes, the histogram distances or the packing; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
