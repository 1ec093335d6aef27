"""Registered queries of the subpackage: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import (bpe, conversations, dac, decontaminate, langnet, licenses, line_spread, quality, repeats, resample,
                          sharding, simhash, suffix_tree)
from basketry.llm.common import scratch, table


def op1_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.extendible_shards(table(spark, sf_dir, "documents"))


def op2_suffix_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score_texts(table(spark, sf_dir, "documents"))


def op3_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_spread.remove_boilerplate(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_removed",
                          F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op4_bpe_segment_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"))


def op5_quality_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents")).drop("t")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("matches", "near")


def op7_simhash_covering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).drop("t", "stays")


def op8_dac_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "dac")
    dac.write_tokens(table(spark, sf_dir, "documents"), folder)
    return dac.read_tokens(spark, folder)


def op9_bwt_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op10_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("t")


def op11_byte_conv_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langnet.identify(table(spark, sf_dir, "documents"))


def op12_crc_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_auction_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.damaged_repairs(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (
    op1_extendible_shards, op2_suffix_tree_scores, op3_line_spread, op4_bpe_segment_tree, op5_quality_bands,
    op6_license_scan, op7_simhash_covering, op8_dac_tokens, op9_bwt_repeats, op10_template_leaks,
    op11_byte_conv_language, op12_crc_resample, op13_auction_repair)}

SQL: dict[str, str] = {
    "op1_extendible_shards": sharding.shard_sql(),
    "op3_line_spread": line_spread.line_sql(),
    "op6_license_scan": licenses.license_sql(),
    "op12_crc_resample": resample.resample_sql(),
}
