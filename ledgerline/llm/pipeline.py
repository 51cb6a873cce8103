"""A training corpus from ``documents``, in five stages.

Each stage reads what its predecessor wrote: quality classifier, near-dedup by shingle similarity, benchmark
decontamination, mixing to target weights, token ids in training order. All but the last return the columns
of documents; the last returns one row for each sequence of the shards it writes.

Cases: those of the stages' operators; an empty table of documents gives no sequence, without labels nothing is
rejected for quality, and without benchmark items nothing is contaminated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import decontam, mixing, near_dedup, quality, tokens
from .common import read, stage


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_first(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.remove_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.take(docs)


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tokens.materialise(docs)[0]


STAGES = [("quality", good), ("near_dedup", distinct), ("decontaminate", decontaminated), ("mix", mixed), ("tokens", tokenised)]

#: A fitted classifier and a tokeniser are beyond SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage_of in STAGES[:-1]:
        docs = stage(stage_of(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
