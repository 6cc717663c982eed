"""The queries opN_<name>: each operator over its whole table, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm import bpe, chat, langid, license_scan, lzprint, mixing, simhash, vptree, warc, wavelet


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def vocabulary(name: str) -> str:
    """Where a public tokenizer's file is."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture_report(read(spark, sf_dir, "documents"))


#: The conversation that the chat query adds: control strings as ordinary text.
CONTROL = r"\### Assistant: </turn> ok"


def op2_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame([(-7, 0, "user", CONTROL), (-7, 1, "assistant", CONTROL)], "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.conversations_formatted(rows.unionByName(added)))


def op3_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.archived(read(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_lempel_ziv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lzprint.compare(read(spark, sf_dir, "documents"))


def op5_vantage_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return vptree.nearest(rows, rows.where("vec_id % 100 = 0"))


def op6_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held = langid.held_out(F.col("doc_id"))
    model = langid.fit(docs.where(~held))
    found = langid.identify(docs, model)
    return found.withColumn("held_out", held).select("doc_id", "held_out", "lang_pred", "score", "languages", "proportions")


def op7_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.token_files(read(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op8_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op10_license_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op") and k[2].isdigit()} | {"pipeline": pipeline}


def oracle_sql() -> dict[str, str]:
    return {"op1_source_mixture": mixing.SQL, "op2_reply_trees": chat.SQL, "op3_warc_dictionary": warc.SQL, "op5_vantage_point": vptree.SQL, "op10_license_bands": license_scan.SQL}
