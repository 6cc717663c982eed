"""Evaluation, thresholds and the assembly of results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def f_half(tp: Column, n_pred: Column, n_true: Column) -> Column:
    """F0.5 of one entity: 1 if nothing is predicted and nothing true, 0 if only one of them or nothing is right."""
    p, r = tp / F.greatest(n_pred, F.lit(1)), tp / F.greatest(n_true, F.lit(1))
    return F.when((n_pred == 0) & (n_true == 0), 1.0).when(tp == 0, 0.0).otherwise(1.25 * p * r / F.when(tp == 0, 1.0).otherwise(0.25 * p + r))


def entity_counts(entities: DataFrame, predicted: DataFrame, truth: DataFrame, *keys: str) -> DataFrame:
    """keys, source1_entity_id, tp, n_pred, n_true of each entity.

    ``entities``: keys and source1_entity_id; ``predicted``: keys, source1_entity_id, other_entity_id.
    """
    on = [*keys, "source1_entity_id"]
    t = truth.select("source1_entity_id", F.col("source_id").alias("other_entity_id")).distinct().withColumn("hit", F.lit(1))
    p = predicted.select(*on, "other_entity_id").distinct().join(t, ["source1_entity_id", "other_entity_id"], "left")
    p = p.groupBy(*on).agg(F.count("*").alias("n_pred"), F.count("hit").alias("tp"))
    n = t.groupBy("source1_entity_id").agg(F.count("*").alias("n_true"))
    rows = entities.select(*on).distinct().join(p, on, "left").join(n, "source1_entity_id", "left")
    return rows.na.fill(0, ["tp", "n_pred", "n_true"])


def summarise(counts: DataFrame, *keys: str) -> DataFrame:
    """Macro F0.5, precision, recall, singleton accuracy and counts; without entities 0, without singletons accuracy 1."""
    tp, n_pred, n_true = F.col("tp"), F.col("n_pred"), F.col("n_true")
    both_empty = (n_pred == 0) & (n_true == 0)
    single = F.sum(F.when(n_true == 0, 1).otherwise(0))
    found = counts.groupBy(*keys).agg(
        F.avg(f_half(tp, n_pred, n_true)).alias("macro_f05"),
        F.avg(F.when(both_empty, 1.0).otherwise(tp / F.greatest(n_pred, F.lit(1)))).alias("macro_precision"),
        F.avg(F.when(both_empty, 1.0).otherwise(tp / F.greatest(n_true, F.lit(1)))).alias("macro_recall"),
        F.sum(F.when(both_empty, 1).otherwise(0)).alias("right"),
        F.count("*").alias("n_entities"),
        single.alias("n_singletons"),
    )
    found = found.withColumn("singleton_accuracy", F.when(F.col("n_singletons") > 0, F.col("right") / F.greatest("n_singletons", F.lit(1))).otherwise(1.0))
    found = found.na.fill(0.0, ["macro_f05", "macro_precision", "macro_recall"]).na.fill(0, ["n_singletons"])
    return found.select(
        *keys, "macro_f05", "macro_precision", "macro_recall", "singleton_accuracy", "n_entities", "n_singletons", (F.col("n_entities") - F.col("n_singletons")).alias("n_non_singletons")
    )


def evaluate(entities: DataFrame, predicted: DataFrame, truth: DataFrame) -> DataFrame:
    """One row of metrics over the entities; truth of other entities is left out."""
    return summarise(entity_counts(entities, predicted, truth))


def threshold_scores(entities: DataFrame, scored: DataFrame, truth: DataFrame, grid: list[float], *keys: str) -> DataFrame:
    """keys, grid_index, threshold, macro_f05, n_entities of every threshold, all in one job.

    Each pair counts for the thresholds up to its score, so pairs are multiplied by the short grid only.
    """
    points = F.array(*[F.struct(F.lit(i).alias("grid_index"), F.lit(float(t)).alias("threshold")) for i, t in enumerate(grid)])
    at = lambda rows: rows.withColumn("g", F.explode(points)).select(*rows.columns, "g.*")
    predicted = at(scored.select("source1_entity_id", "other_entity_id", "score")).where("score >= threshold")
    on = ["grid_index", "threshold"]
    t = truth.select("source1_entity_id", F.col("source_id").alias("other_entity_id")).distinct().withColumn("hit", F.lit(1))
    p = predicted.groupBy(*on, "source1_entity_id", "other_entity_id").agg(F.max("score").alias("score")).join(t, ["source1_entity_id", "other_entity_id"], "left")
    p = p.groupBy("grid_index", "source1_entity_id").agg(F.count("*").alias("n_pred"), F.count("hit").alias("tp"))
    n = t.groupBy("source1_entity_id").agg(F.count("*").alias("n_true"))
    everyone = at(entities.select(*keys, "source1_entity_id").distinct())
    rows = everyone.join(p, ["grid_index", "source1_entity_id"], "left").join(n, "source1_entity_id", "left").na.fill(0, ["tp", "n_pred", "n_true"])
    score = F.avg(f_half(F.col("tp"), F.col("n_pred"), F.col("n_true"))).alias("macro_f05")
    return rows.groupBy(*keys, *on).agg(score, F.count("*").alias("n_entities"))


def best_threshold(scores: DataFrame, digits: int = 12) -> tuple[float, float] | None:
    """The first threshold of the highest macro F0.5, and that; None without scores."""
    row = scores.orderBy(F.round("macro_f05", digits).desc(), "grid_index").select("threshold", "macro_f05").first()
    return (row["threshold"], row["macro_f05"]) if row else None


def tune(entities: DataFrame, scored: DataFrame, truth: DataFrame, grid: list[float], default: float) -> float:
    found = best_threshold(threshold_scores(entities, scored, truth, grid)) if grid and scored.head(1) else None
    return found[0] if found else default


def tune_by_country(entities: DataFrame, scored: DataFrame, truth: DataFrame, grid: list[float], default: float, least: int) -> DataFrame:
    """country_norm, threshold: the best of each country, the global one where it has under ``least`` entities or no pairs.

    ``entities``: source1_entity_id, country_norm. The row of country ``_default`` holds the global threshold.
    """
    overall = tune(entities, scored, truth, grid, default)
    scores = threshold_scores(entities, scored, truth, grid, "country_norm")
    rank = F.row_number().over(Window.partitionBy("country_norm").orderBy(F.round("macro_f05", 12).desc(), "grid_index"))
    best = scores.withColumn("n", rank).where("n = 1").select("country_norm", "threshold", "n_entities")
    paired = entities.join(scored.select("source1_entity_id").distinct(), "source1_entity_id", "left_semi").select("country_norm").distinct().withColumn("paired", F.lit(True))
    best = best.join(paired, "country_norm", "left")
    own = F.when((F.col("n_entities") >= least) & F.col("paired").isNotNull(), F.col("threshold")).otherwise(F.lit(overall))
    spark = entities.sparkSession
    return best.select("country_norm", own.alias("threshold")).unionByName(spark.createDataFrame([("_default", overall)], "country_norm string, threshold double"))


def assemble(entities: DataFrame, scored: DataFrame, thresholds: DataFrame | None, overall: float) -> DataFrame:
    """source1_entity_id, matched_entity_ids, candidate_entity_ids: one row per entity, ids sorted and joined by commas.

    A pair matches at or above the threshold of the entity's country, else that of ``_default``, else ``overall``.
    ``entities``: source1_entity_id, country_norm.
    """
    rows = entities.select("source1_entity_id", "country_norm").dropDuplicates(["source1_entity_id"])
    if thresholds is None:
        rows = rows.withColumn("threshold", F.lit(float(overall)))
    else:
        fallback = thresholds.where("country_norm = '_default'").agg(F.max("threshold")).first()[0]
        fallback = float(overall) if fallback is None else fallback
        rows = rows.join(thresholds.where("country_norm <> '_default'"), "country_norm", "left").withColumn("threshold", F.coalesce("threshold", F.lit(fallback)))
    pairs = scored.select("source1_entity_id", "other_entity_id", "score")
    rows = rows.join(pairs, "source1_entity_id", "left").groupBy("source1_entity_id").agg(
        F.collect_set(F.when(F.col("score") >= F.col("threshold"), F.col("other_entity_id"))).alias("m"), F.collect_set("other_entity_id").alias("c")
    )
    joined = lambda c: F.array_join(F.array_sort(c), ",")
    return rows.select("source1_entity_id", joined("m").alias("matched_entity_ids"), joined("c").alias("candidate_entity_ids"))


def exploded(results: DataFrame, column: str = "matched_entity_ids") -> DataFrame:
    """source1_entity_id, other_entity_id of comma-joined lists; blanks are dropped."""
    parts = F.filter(F.transform(F.split(column, ","), lambda x: F.trim(x)), lambda x: x != "")
    return results.select("source1_entity_id", F.explode(parts).alias("other_entity_id")).distinct()


def summary(results: DataFrame) -> DataFrame:
    """n_entities, n_with_match, n_matches, n_singletons of assembled results."""
    n = F.size(F.filter(F.split("matched_entity_ids", ","), lambda x: x != ""))
    return results.select(n.alias("n")).agg(
        F.count("*").alias("n_entities"),
        F.coalesce(F.sum((F.col("n") > 0).cast("long")), F.lit(0)).alias("n_with_match"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_matches"),
        F.coalesce(F.sum((F.col("n") == 0).cast("long")), F.lit(0)).alias("n_singletons"),
    )
