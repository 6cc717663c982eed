"""Linkage inputs from tables at hand: documents, customers and suppliers, embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """entity_id, source, business_name, business_address, country: documents dealt to three sources by doc_id.

    The name is a text's first segment, the address its length and second segment, the country its language.
    """
    d = read(spark, folder, "documents")
    source = F.col("doc_id") % 3 + 1
    return d.select(
        F.concat(F.lit("S"), source.cast("string"), F.lit("-"), F.col("doc_id").cast("string")).alias("entity_id"),
        source.cast("int").alias("source"),
        F.regexp_extract("text", "^[^.\n,]*", 0).alias("business_name"),
        F.concat(F.col("n_chars").cast("string"), F.lit(" "), F.regexp_extract("text", "^[^.\n,]*[.\n,][ ]*([^.\n,]*)", 1)).alias("business_address"),
        F.upper("lang").alias("country"),
    )


def document_truth(spark: SparkSession, folder: str) -> DataFrame:
    """source1_entity_id, source_id, source_tag: equal texts of the first and another source, within a language."""
    d = read(spark, folder, "documents").select("doc_id", "lang", F.md5("text").alias("digest"), (F.col("doc_id") % 3 + 1).alias("source"))
    name = lambda a: F.concat(F.lit("S"), F.col(f"{a}.source").cast("string"), F.lit("-"), F.col(f"{a}.doc_id").cast("string"))
    a, b = d.where("source = 1").alias("a"), d.where("source > 1").alias("b")
    both = a.join(b, (F.col("a.digest") == F.col("b.digest")) & (F.col("a.lang") == F.col("b.lang")))
    return both.select(name("a").alias("source1_entity_id"), name("b").alias("source_id"), F.concat(F.lit("source"), F.col("b.source").cast("string")).alias("source_tag"))


def traders(spark: SparkSession, folder: str) -> DataFrame:
    """The same columns from customers (source 1) and suppliers (source 2); the country is the nation's name."""
    nation = read(spark, folder, "nation").select("n_nationkey", "n_name")
    c = read(spark, folder, "customer").select(F.lit(1).alias("source"), F.col("c_custkey").alias("k"), F.col("c_name").alias("business_name"), F.col("c_nationkey").alias("n"), F.col("c_acctbal").alias("bal"))
    s = read(spark, folder, "supplier").select(F.lit(2).alias("source"), F.col("s_suppkey").alias("k"), F.col("s_name").alias("business_name"), F.col("s_nationkey").alias("n"), F.col("s_acctbal").alias("bal"))
    rows = c.unionByName(s).join(F.broadcast(nation), F.col("n") == F.col("n_nationkey"))  # 25 nations
    return rows.select(
        F.concat(F.lit("S"), F.col("source").cast("string"), F.lit("-"), F.col("k").cast("string")).alias("entity_id"),
        "source", "business_name",
        F.concat((F.col("k") % 1000).cast("string"), F.lit(" harbour road")).alias("business_address"),
        F.col("n_name").alias("country"),
    )
