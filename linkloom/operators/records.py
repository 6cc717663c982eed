"""Normalised records: what blocking and features work on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.functions import text


def normalized(records: DataFrame, other_scripts: bool = True) -> DataFrame:
    """``records`` with country_norm, norm_name, norm_address, street_number, is_landmark.

    One projection per step, so no expression is evaluated twice.
    """
    rows = records.withColumn("country_norm", text.normalize_country(F.col("country")))
    rows = rows.withColumns({"__name": text.clean(F.col("business_name"), other_scripts), "__address": text.clean(F.col("business_address"), other_scripts)})
    rows = rows.withColumns({"norm_name": text.suffixes(F.col("__name"), F.col("country_norm")), "__tokens": text.address_tokens(F.col("__address"), F.col("country_norm"))})
    rows = rows.withColumn("street_number", text.street_number(F.col("__tokens")))
    rows = rows.withColumn("norm_address", text.number_first(F.col("__tokens"), F.col("street_number")))
    rows = rows.withColumn("is_landmark", F.col("street_number").isNull().cast("int"))
    return rows.drop("__name", "__address", "__tokens")


def sides(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Source 1, and the others with their source_tag, of records that hold all sources (column source)."""
    tag = F.concat(F.lit("source"), F.col("source").cast("string"))
    return records.where("source = 1").drop("source"), records.where("source > 1").withColumn("source_tag", tag).drop("source")
