"""The operators as queries over the given tables, with their production parameters, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marketlake.llm import ann, chat, html_text, license_table, licenses, mixing, neardup, packing, quality, sharding, spelling, substrings, token_matrix, whitening
from marketlake.llm.common import table


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op2_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeated_strings(table(spark, sf_dir, "documents"))


def op4_chat_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.collapse_snapshots(table(spark, sf_dir, "conversations"))


def op5_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op6_token_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    # id 50256 is this vocabulary's end of text
    return token_matrix.packed_rows(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"), end_id=50_256)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"), license_table.USUAL, spdx=True)


def op8_bounded_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary())


def op9_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op10_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(table(spark, sf_dir, "documents"))


def op11_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(table(spark, sf_dir, "documents"))


def op12_block_labeller(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_mix_sources, op2_quality_divergence, op3_suffix_dedup, op4_chat_snapshots, op5_dart_minhash,
        op6_token_matrix, op7_license_scan, op8_bounded_best_fit, op9_hnsw, op10_minimax_shards,
        op11_spelling_groups, op12_block_labeller, op13_whitening,
    )
}
ORACLE_SQL: dict[str, str] = {"op1_mix_sources": mixing.SQL, "op4_chat_snapshots": chat.SQL}
