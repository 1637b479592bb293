"""One query per operator over its whole table, and SQL where it can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tablesync.llm import (
    alignment,
    byte_bpe,
    embedding_dedup,
    kneser_ney,
    license_scan,
    merkle_manifest,
    minhash_icws,
    packing,
    preference_format,
    quality_ledger,
    sharding,
    substring_dedup,
    warc,
)
from tablesync.llm.words import table



def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.op1_substring_dedup(spark, table(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.op2_license_scan(spark, table(spark, sf_dir, "documents"))


def op3_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.op3_nn_descent(spark, table(spark, sf_dir, "embeddings"))


def op4_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preference_format.op4_preference_format(table(spark, sf_dir, "conversations"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.op5_best_fit_packing(spark, table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op7_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.op7_kneser_ney(spark, table(spark, sf_dir, "documents"))


def op8_shard_by_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.op8_shard_by_bytes(spark, table(spark, sf_dir, "documents"))


def op9_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_ledger.op9_quality_ledger(table(spark, sf_dir, "documents"))


def op10_minhash_icws(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_icws.op10_minhash_icws(spark, table(spark, sf_dir, "documents"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.op11_alignment(spark, table(spark, sf_dir, "documents"), *paths)


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.op12_warc(spark, table(spark, sf_dir, "pages"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.op13_merkle_manifest(spark, table(spark, sf_dir, "documents"))


#: Query name: the query and its SQL, None where SQL cannot say it.
QUERIES = {
    "op1_substring_dedup": (op1_substring_dedup, substring_dedup.SQL),
    "op2_license_scan": (op2_license_scan, license_scan.SQL),
    "op3_nn_descent": (op3_nn_descent, embedding_dedup.SQL),
    "op4_preference_format": (op4_preference_format, None),
    "op5_best_fit_packing": (op5_best_fit_packing, None),
    "op6_byte_bpe": (op6_byte_bpe, None),
    "op7_kneser_ney": (op7_kneser_ney, None),
    "op8_shard_by_bytes": (op8_shard_by_bytes, sharding.SQL),
    "op9_quality_ledger": (op9_quality_ledger, quality_ledger.SQL),
    "op10_minhash_icws": (op10_minhash_icws, None),
    "op11_alignment": (op11_alignment, None),
    "op12_warc": (op12_warc, warc.SQL),
    "op13_merkle_manifest": (op13_merkle_manifest, merkle_manifest.SQL),
}
