"""A corpus pipeline of four stages: language ID, near-duplicates, mixing, encoding.

Each stage takes all that its predecessor kept. Texts without a letter or in no learned language go; of a
group of near copies the document with the smallest doc_id stays; sources are then mixed to their target
weights, which repeats documents; what is left is encoded, and its ids are the result, with digests of them.

A null or empty text is rejected by the first stage, so the rest have none; rows without a doc_id are kept by the
second, as nothing names them; tables without rows go through all four and give none; columns that ``documents``
has beside its own stay until the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from linkloom.llm import bpe, langid, mixing, simhash
from linkloom.llm.common import drop, scratch, written
from linkloom.llm.queries import read, vocabulary


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.known_language(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encoded(docs, vocabulary("word_bpe_49k.json"))


STAGES = [("language_id", known_language), ("near_duplicates", near_duplicates), ("mixture", mixture), ("encoded", encoded)]

#: SQL can express neither the fitted language model nor the fingerprints nor the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage's table goes once the next one's is written."""
    docs, past = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with scratch(spark) as keep:
            docs = keep(written(stage(spark, docs, sf_dir), name))
        if past is not None:
            drop(past)
        past = docs
    return STAGES[-1][1](spark, docs, sf_dir)
