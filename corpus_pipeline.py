"""A corpus pipeline: quality rules, language ID, near-dedup, mixing, BPE encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crestline.llm import bpe, langid, mixing, near_dedup, quality_rules
from crestline.llm.common import cut, read
from crestline.llm.queries import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that pass the quality rules."""
    return quality_rules.keep(docs, read(spark, sf_dir, "labels"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose language is determined."""
    return langid.keep(docs)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity 0.8."""
    return near_dedup.dedup(docs, width=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents, repeated or left out, so that sources meet their target weights."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the sha256 of the ids' decoding of each document; null text has no tokens."""
    return bpe.encoded(docs, tokenizer_path())


STAGES = [("quality", quality), ("language", language), ("dedup", dedup), ("mix", mix), ("encode", encode)]

#: SQL expresses neither the models nor the draws; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each stage's result is stored before the next reads it."""
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut(docs)
    return docs.withColumn("ids", F.base64("ids"))
