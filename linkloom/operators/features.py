"""The features of candidate pairs, in a fixed order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.functions import similarity as sim
from linkloom.functions.fuzzy import fuzzy_sides

FEATURES = [
    "name_exact_match", "name_token_jaccard", "name_token_sort_ratio", "name_token_set_ratio", "name_partial_ratio", "name_edit_sim",
    "name_common_prefix_len", "name_len_ratio", "address_exact_match", "address_token_overlap", "address_edit_sim", "address_partial_ratio",
    "street_number_match", "address_len_ratio", "is_landmark_s1", "is_landmark_other", "country_agree", "name_missing", "address_missing",
    "name_address_combined_sim",
]
#: What a block is split into by ``joined``; its other side is copied to each.
PARTS = 16
PLAIN = ["norm_name", "norm_address", "street_number", "country_norm"]


def with_records(pairs: DataFrame, s1: DataFrame, others: DataFrame) -> DataFrame:
    """``pairs`` with both sides' normalised columns (a_*, b_*); of an id without a record, empty ones."""

    def side(rows: DataFrame, p: str, *more: str) -> DataFrame:
        cols = [F.col(c).alias(f"{p}_{c}") for c in PLAIN]
        return rows.select(F.col("entity_id").alias(f"{p}_id"), *cols, F.col("is_landmark").cast("double").alias(f"{p}_landmark"), *[F.col(m).alias(f"{p}_{m}") for m in more])

    a, b = side(s1, "a"), side(others, "b", "source_tag")
    rows = pairs.join(a, F.col("source1_entity_id") == F.col("a_id"), "left")
    rows = rows.join(b, (F.col("other_entity_id") == F.col("b_id")) & (F.col("source_tag") == F.col("b_source_tag")), "left")
    empty = {f"{p}_{c}": F.coalesce(F.col(f"{p}_{c}"), F.lit("")) for p in "ab" for c in PLAIN}
    zero = {f"{p}_landmark": F.coalesce(F.col(f"{p}_landmark"), F.lit(0.0)) for p in "ab"}
    return rows.withColumns(empty | zero).drop("a_id", "b_id", "b_source_tag")


def joined(s1: DataFrame, others: DataFrame, key: Column) -> DataFrame:
    """The pairs of equal, not empty keys within a country, with both sides' columns as ``with_records`` gives them.

    No pair is shuffled. Blocks may be few and large: each is split by its first side in ``PARTS``, and tasks are as many
    as there are shuffle partitions or four a core, as what they make is much more than what they read.
    """
    spark = s1.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)

    def side(rows: DataFrame, p: str, id_name: str, part: Column, *more: str) -> DataFrame:
        rows = rows.withColumns({"__key": key, "__country": F.col("country_norm"), "__part": part}).where(F.length("__key") > 0)
        cols = [F.coalesce(F.col(c), F.lit("")).alias(f"{p}_{c}") for c in PLAIN]
        rows = rows.select("__country", "__key", "__part", F.col("entity_id").alias(id_name), *more, *cols, F.col("is_landmark").cast("double").alias(f"{p}_landmark"))
        return rows.repartition(tasks, "__country", "__key", "__part")

    a = side(s1, "a", "source1_entity_id", F.pmod(F.xxhash64("entity_id"), F.lit(PARTS)).cast("int"))
    b = side(others, "b", "other_entity_id", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))), "source_tag")
    return a.join(b, ["__country", "__key", "__part"]).drop("__country", "__key", "__part")


def catalyst_features(rows: DataFrame) -> DataFrame:
    """The features that need no Python, added to pairs with records."""
    na, nb, aa, ab = (F.col(c) for c in ("a_norm_name", "b_norm_name", "a_norm_address", "b_norm_address"))
    return rows.withColumns({
        "name_exact_match": sim.exact(na, nb),
        "name_token_jaccard": sim.token_jaccard(na, nb),
        "name_common_prefix_len": sim.common_prefix(na, nb),
        "name_len_ratio": sim.length_ratio(na, nb),
        "address_exact_match": sim.exact(aa, ab),
        "address_token_overlap": sim.token_jaccard(aa, ab),
        "street_number_match": sim.street_agreement(F.col("a_street_number"), F.col("b_street_number")),
        "address_len_ratio": sim.length_ratio(aa, ab),
        "is_landmark_s1": F.col("a_landmark"),
        "is_landmark_other": F.col("b_landmark"),
        "country_agree": sim.flag(F.col("a_country_norm") == F.col("b_country_norm")),
        "name_missing": sim.missing(na, nb),
        "address_missing": sim.missing(aa, ab),
    })


FUZZY = {
    "name_edit_sim": ("name", "indel"), "name_token_sort_ratio": ("name", "sorted"), "name_token_set_ratio": ("name", "set"), "name_partial_ratio": ("name", "partial"),
    "address_edit_sim": ("address", "indel"), "address_partial_ratio": ("address", "partial"),
}


def fuzzy_features(rows: DataFrame, *names: str) -> DataFrame:
    """The fuzzy ratios, or those named, from one Arrow function, which computes no others."""
    combined = "name_address_combined_sim"
    wanted = {n for n in (names or [*FUZZY, combined]) if n != combined} | ({"name_edit_sim", "address_edit_sim"} if not names or combined in names else set())
    kinds = {side: [kind for n, (of, kind) in FUZZY.items() if of == side and n in wanted] for side in ("name", "address")}
    rows = rows.withColumn("__f", fuzzy_sides({side: (f"a_norm_{side}", f"b_norm_{side}", some) for side, some in kinds.items() if some}))
    rows = rows.withColumns({n: F.col(f"__f.{side}.{kind}") for n, (side, kind) in FUZZY.items() if n in wanted})
    if not names or combined in names:
        rows = rows.withColumn(combined, (F.col("name_edit_sim") + F.col("address_edit_sim")) / 2)
    return rows.drop("__f")


def features(pairs: DataFrame, s1: DataFrame, others: DataFrame) -> DataFrame:
    """``pairs`` with all features, in order."""
    rows = fuzzy_features(catalyst_features(with_records(pairs, s1, others)))
    return rows.select(*pairs.columns, *FEATURES)
