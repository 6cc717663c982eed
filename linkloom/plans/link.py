"""Training and prediction over files, with reports of what each step found."""

from __future__ import annotations

import logging
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.config import Config
from linkloom.operators import blocking, decide, nearest, training
from linkloom.operators.features import features
from linkloom.operators.records import normalized
from linkloom.sources import tsv
from linkloom.sources.texts import read_text, write_text

log = logging.getLogger("linkloom")
#: The reports' names, beside the model and the results.
TRAIN_REPORT, PREDICT_REPORT = "train_report.yaml", "predict_report.yaml"


@dataclass
class Sources:
    """Normalised Source-1 records and all others with their tag."""

    s1: DataFrame
    others: DataFrame


def with_vectors(records: DataFrame, vectors: DataFrame, least: int) -> DataFrame:
    """``records`` with the embedding of their id; a record long enough to be searched must have one."""
    rows = records.join(vectors, "entity_id", "left").cache()
    if missing := [r["entity_id"] for r in rows.where(F.col("embedding").isNull() & nearest.long_enough(least)).select("entity_id").limit(5).collect()]:
        raise ValueError(f"records without an embedding: {', '.join(missing)}")
    return rows.withColumn("embedding", F.coalesce("embedding", F.array().cast("array<double>")))


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """entity_id, embedding of a Parquet table; ids must be unique."""
    vectors = spark.read.parquet(path).select("entity_id", F.col("embedding").cast("array<double>").alias("embedding"))
    if twice := [r["entity_id"] for r in vectors.groupBy("entity_id").count().where("count > 1").limit(5).collect()]:
        raise ValueError(f"ids with several embeddings: {', '.join(map(str, twice))}")
    return vectors


def read_sources(spark: SparkSession, cfg: Config, folder: str) -> Sources:
    p, how = cfg.paths, {"encoding": cfg.files.encoding, "delimiter": cfg.files.delimiter, "multiline": cfg.files.multiline}
    s1 = tsv.read_tsv(spark, f"{folder}/{p.source1_file}", tsv.SOURCE, may_be_empty=False, **how)
    s2 = tsv.read_source(spark, f"{folder}/{p.source2_file}", "source2", **how)
    s3 = tsv.read_source(spark, f"{folder}/{p.source3_file}", "source3", **how)
    columns = [*tsv.SOURCE.columns, "source_tag"]
    # every strategy and the features read them: normalised once
    sources = Sources(normalized(s1).cache(), normalized(s2.select(columns).unionByName(s3.select(columns))).cache())
    if not cfg.blocking.use_dense_embedding:
        return sources
    vectors, least = read_vectors(spark, f"{folder}/{p.embeddings_file}"), cfg.blocking.min_key_length
    return Sources(with_vectors(sources.s1, vectors, least), with_vectors(sources.others, vectors, least))


def blocking_report(cfg: Config, sources: Sources, pairs: DataFrame, truth: DataFrame | None = None) -> dict:
    """Pairs by strategy and tag, pairs after the cap, large blocks, and with ``truth`` each strategy's recall, the ceiling of all and that after the cap."""
    found, s1, others = blocking.strategies(cfg.blocking), sources.s1, sources.others
    out: dict = {"strategies": [r.asDict() for r in blocking.diagnostics(found, s1, others, truth).orderBy("source_tag", "strategy_name").collect()]}
    out["pairs_after_cap"] = {r["source_tag"]: r["count"] for r in pairs.groupBy("source_tag").count().collect()}
    keyed = [f for f in found if isinstance(f, blocking.KeyBlocking)] if cfg.blocking.skip_large_blocks else []
    out["large_blocks_skipped"] = sum(r["skipped"] for f in keyed for r in blocking.without_large_blocks(f, s1, others, cfg.blocking.max_block_size)[1].collect())
    if truth is not None:
        by_tag = lambda rows: {r["source_tag"]: r["recall"] for r in blocking.recall(rows, truth).collect()}
        out |= {"recall_ceiling": by_tag(blocking.covered(found, s1, others, truth)), "recall_after_cap": by_tag(pairs)}
    return out


def finished(spark: SparkSession, path: str, title: str, found: dict, began: float) -> dict:
    """The report of a run: saved, logged, given back."""
    import yaml

    found = found | {"elapsed_seconds": round(time.time() - began, 1)}
    text = yaml.safe_dump(found, sort_keys=False)
    write_text(spark, path, text)
    log.info("%s\n%s", title, text)
    return found


def scored_candidates(cfg: Config, sources: Sources, model: training.Ensemble) -> DataFrame:
    pairs = blocking.capped_union(cfg.blocking, sources.s1, sources.others)
    return model.score(features(pairs, sources.s1, sources.others))


def train(spark: SparkSession, cfg: Config) -> dict:
    """Fit on one part of the entities, tune thresholds on the other, save both; returns what was measured."""
    import yaml

    began, folder = time.time(), f"{cfg.paths.data_dir}/{cfg.paths.train_subdir}"
    sources = read_sources(spark, cfg, folder)
    how = {"encoding": cfg.files.encoding, "delimiter": cfg.files.delimiter}
    truth = tsv.read_tsv(spark, f"{folder}/{cfg.paths.ground_truth_file}", tsv.GROUND_TRUTH, **how)
    parts = training.split_entities(sources.s1, cfg.training.validation_fraction, cfg.random_seed).cache()
    side = lambda part: sources.s1.join(parts.where(F.col("part") == part), "entity_id", "left_semi")
    of = lambda ids: truth.join(ids.select(F.col("entity_id").alias("source1_entity_id")), "source1_entity_id", "left_semi")

    learn, hold = side("train"), side("validation")
    pairs = blocking.capped_union(cfg.blocking, learn, sources.others)
    rows = training.labelled(features(pairs, learn, sources.others), of(learn)).cache()
    sample = training.sample_negatives(rows, cfg.training.negative_positive_ratio, cfg.random_seed).cache()
    rate = training.positive_rate(sample)
    log.info("training on %d pairs, %.4f of them true", sample.count(), rate)
    model = training.build_model(cfg.models, cfg.random_seed).fit(sample)

    held = Sources(hold, sources.others)
    scored = scored_candidates(cfg, held, model).cache()
    entities = hold.select(F.col("entity_id").alias("source1_entity_id"), "country_norm")
    held_truth = of(hold)
    grid, default = cfg.decision.threshold_grid, cfg.decision.default_threshold
    if cfg.decision.per_country:
        by = decide.tune_by_country(entities, scored, held_truth, grid, default, cfg.decision.min_country_val_size)
        thresholds = {r["country_norm"]: r["threshold"] for r in by.collect()}  # a row per country
    else:
        thresholds = {"_default": decide.tune(entities, scored, held_truth, grid, default)}
    best = thresholds["_default"]
    table = spark.createDataFrame(list(thresholds.items()), "country_norm string, threshold double")
    results = decide.assemble(entities, scored, table, best)
    metrics = decide.evaluate(entities, decide.exploded(results), held_truth).first().asDict()
    found = blocking.recall(scored, held_truth).agg(F.sum("n_true").alias("t"), F.sum("n_found").alias("f")).first()
    metrics["recall_after_cap"] = found["f"] / found["t"] if found["t"] else 1.0
    model.save(f"{cfg.paths.model_dir}/{cfg.paths.model_artifact}")
    tuned = {"best_threshold": best, "thresholds": thresholds, "per_country": cfg.decision.per_country, **{f"val_{k}": v for k, v in metrics.items()}}
    write_text(spark, f"{cfg.paths.model_dir}/{cfg.paths.config_artifact_file}", yaml.safe_dump(tuned))
    report = {"threshold": best, **metrics, "positive_rate": rate, "importances": model.importances(), "blocking": blocking_report(cfg, held, scored, held_truth)}
    finished(spark, f"{cfg.paths.model_dir}/{TRAIN_REPORT}", "training complete", report, began)
    for frame in (parts, rows, sample, scored):
        frame.unpersist()
    return metrics | {"thresholds": thresholds, "report": report}


def predict(spark: SparkSession, cfg: Config) -> dict:
    """Link the test sources with the saved model and thresholds, and write both result files."""
    import yaml

    began = time.time()
    saved = yaml.safe_load(read_text(spark, f"{cfg.paths.model_dir}/{cfg.paths.config_artifact_file}") or "") or {}
    best = saved.get("best_threshold", cfg.decision.default_threshold)
    model = training.build_model(cfg.models, cfg.random_seed).load(f"{cfg.paths.model_dir}/{cfg.paths.model_artifact}")
    sources = read_sources(spark, cfg, f"{cfg.paths.data_dir}/{cfg.paths.test_subdir}")
    entities = sources.s1.select(F.col("entity_id").alias("source1_entity_id"), "country_norm")
    table = spark.createDataFrame(list((saved.get("thresholds") or {"_default": best}).items()), "country_norm string, threshold double")
    results = decide.assemble(entities, scored_candidates(cfg, sources, model), table, best).cache()
    out = results.orderBy("source1_entity_id")
    tsv.write_tsv(out.select("source1_entity_id", "matched_entity_ids"), f"{cfg.paths.output_dir}/{cfg.paths.matching_results_file}", cfg.files.delimiter)
    tsv.write_tsv(out.select("source1_entity_id", "candidate_entity_ids"), f"{cfg.paths.output_dir}/{cfg.paths.candidate_pairs_file}", cfg.files.delimiter)
    counts = decide.summary(results).first().asDict()
    counts["n_candidates"] = decide.exploded(results, "candidate_entity_ids").count()
    results.unpersist()
    return finished(spark, f"{cfg.paths.output_dir}/{PREDICT_REPORT}", "prediction complete", counts, began)
