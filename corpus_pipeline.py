"""A training-data pipeline over ``documents``: each stage reads what the one before it wrote.

A stage begins by deleting the intermediate tables of earlier stages, except any that its own input still reads.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from clickloom.llm import decontaminate, lines, pieces, quality, simhash
from clickloom.llm.base import documents
from clickloom.session import discard_unread, materialize, noted

PIECES = public_tokenizers.path("piece_bpe_32k.model")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_WRITTEN: list[str] = []


def tidy(stage: Stage) -> Stage:
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        discard_unread(_WRITTEN, docs)
        with noted(_WRITTEN):
            return stage(spark, docs, sf_dir)

    return run_stage


@tidy
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


@tidy
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lines.without_repeated_lines(docs)


@tidy
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


@tidy
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@tidy
def sentence_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.round_trip(docs, PIECES)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("SentencePiece encoding and decoding", sentence_pieces),
]

# Content-defined boundaries and fingerprints need 64-bit hashes that the SQL engine lacks.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; every result is written to the shared folder and read again."""
    docs = documents(spark, sf_dir)
    for number, (_, stage) in enumerate(STAGES):
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{number}")
    return docs
