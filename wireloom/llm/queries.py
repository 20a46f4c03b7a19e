"""Registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wireloom.llm import block_extract, bpe, markov_secrets, minmax_dedup, oracle, order_minhash, packing, prefix_trie, quality_mcd, skip_chain_crf, source_skyband, token_files, url_equivalence, warc_segments


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_warc_segments(spark: SparkSession, folder: str) -> DataFrame:
    return warc_segments.archive_round_trip(table(spark, folder, "pages"))


def op2_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"))


def op3_quality_mcd(spark: SparkSession, folder: str) -> DataFrame:
    return quality_mcd.quality_rules(table(spark, folder, "documents"))


def op4_markov_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return markov_secrets.secret_scan(table(spark, folder, "documents"))


def op5_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return order_minhash.order_minhash(table(spark, folder, "documents"))


def op6_url_equivalence(spark: SparkSession, folder: str) -> DataFrame:
    return url_equivalence.judge_urls(table(spark, folder, "pages"))


def op7_block_extract(spark: SparkSession, folder: str) -> DataFrame:
    return block_extract.extract_text(table(spark, folder, "pages"))


def op8_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.token_file_digests(table(spark, folder, "documents"), end_id=1)


def op9_segment_tree_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.bpe_digests(table(spark, folder, "documents"))


def op10_minmax_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minmax_dedup.near_duplicates(table(spark, folder, "documents"))


def op11_skip_chain_crf(spark: SparkSession, folder: str) -> DataFrame:
    return skip_chain_crf.personal_data_scan(table(spark, folder, "documents"))


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, folder, "conversations"))


def op13_source_skyband(spark: SparkSession, folder: str) -> DataFrame:
    return source_skyband.divergence(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    build.__name__: build for build in (
        op1_warc_segments,
        op2_best_fit_packing,
        op3_quality_mcd,
        op4_markov_secrets,
        op5_order_minhash,
        op6_url_equivalence,
        op7_block_extract,
        op8_token_files,
        op9_segment_tree_bpe,
        op10_minmax_dedup,
        op11_skip_chain_crf,
        op12_prefix_trie,
        op13_source_skyband,
    )
}

ORACLES: dict[str, str] = dict(oracle.ORACLES)
