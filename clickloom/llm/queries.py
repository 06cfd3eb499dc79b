"""The registered queries of this subpackage, each over its whole table, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom.llm import decontaminate, langid, lines, lm, minhash, pieces, pii, quality, repair, simhash, suffix, tokens, whitening
from clickloom.llm.base import documents

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_lines(spark: SparkSession, folder: str) -> DataFrame:
    return lines.line_dedup(documents(spark, folder))


def op2_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.round_trip(documents(spark, folder), PIECES)


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, folder))


def op4_suffix(spark: SparkSession, folder: str) -> DataFrame:
    return suffix.repeated_bytes(documents(spark, folder))


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality(documents(spark, folder))


def op6_langid(spark: SparkSession, folder: str) -> DataFrame:
    return langid.identify(documents(spark, folder), PIECES)


def op7_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.token_index(documents(spark, folder), BYTE_BPE)


def op8_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


def op9_lm(spark: SparkSession, folder: str) -> DataFrame:
    return lm.language_model(documents(spark, folder))


def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.personal_data(documents(spark, folder))


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """The exact deviation as a long; null where it does not fit one (beyond some ten million vectors)."""
    rows = whitening.whitened(spark.read.parquet(f"{folder}/embeddings.parquet"))
    return rows.withColumn("deviation", F.col("deviation").try_cast("bigint"))


def op12_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair.structure(spark.read.parquet(f"{folder}/conversations.parquet"))


def op13_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, folder))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lines": op1_lines,
    "op2_pieces": op2_pieces,
    "op3_simhash": op3_simhash,
    "op4_suffix": op4_suffix,
    "op5_quality": op5_quality,
    "op6_langid": op6_langid,
    "op7_tokens": op7_tokens,
    "op8_decontaminate": op8_decontaminate,
    "op9_lm": op9_lm,
    "op10_pii": op10_pii,
    "op11_whitening": op11_whitening,
    "op12_repair": op12_repair,
    "op13_minhash": op13_minhash,
}
SQL: dict[str, str] = {
    "op5_quality": quality.SQL,
    "op8_decontaminate": decontaminate.SQL,
}
