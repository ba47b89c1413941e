"""The corpus pipeline: documents pass through the stages in order, each written before the next reads it.

Every stage takes ``(spark, docs, sf_dir)``. All but the last return the columns of documents; the last
returns a row per remaining document with counts and digests of its token ids and decoded text. Stages work on
all their predecessor kept, and on whole texts; empty tables pass through every stage.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from yearweave.llm.common import shared_folder, table
from yearweave.llm.decontaminate import decontaminated
from yearweave.llm.line_dedup import without_repeated_lines
from yearweave.llm.sentencepiece_codec import encode_decode, token_digest
from yearweave.llm.simhash_groups import simhash_dedup
from yearweave.llm.toxicity import without_toxic

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn from the labelled documents outside the held-out fold; documents that score 0.5 or more go."""
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines within the edit distance of an earlier line go, and documents that had no other lines with content."""
    return without_repeated_lines(docs)


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by fingerprints of four-word shingles at four bits or fewer, one stays."""
    return simhash_dedup(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode every remaining text and decode it again: counts and digests of ids and text."""
    import public_tokenizers

    return token_digest(encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model")))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("simhash", simhash),
    ("decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]

#: Several stages (a trained classifier, tokenisation) have no SQL form; tests hold run() against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
