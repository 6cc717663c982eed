"""Blocking, features, decisions and checks over small tables."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from linkloom.config import Blocking, Models, load_config
from linkloom.operators import blocking, check, decide, features, nearest, training
from linkloom.operators.records import normalized
from linkloom.plans import queries
from linkloom.sources import tsv
from linkloom.streaming.arrivals import link_arrivals

RECORD = "entity_id string, business_name string, business_address string, country string"
KEYED = ["name_prefix", "name_suffix", "address_number", "address_prefix", "rare_numeric_token"]


@pytest.fixture(scope="module")
def records(spark):
    rng = random.Random(1)
    names = ["Acme Robotics Inc", "Acme Foods", "Delta Foods Corp", "Bright Cafe LLC", "Zen Traders", "Le Bistro", ""]
    roads = ["123 Innovation Drive", "45 Market Street", "Oak Avenue 789", "MG Road", "5 Void Lane", ""]
    make = lambda p, i: (f"{p}-{i:03}", rng.choice(names), rng.choice(roads), rng.choice(["US", "IN", "France"]))
    s1 = normalized(spark.createDataFrame([make("S1", i) for i in range(40)], RECORD))
    s2 = spark.createDataFrame([make("S2", i) for i in range(60)], RECORD).withColumn("source_tag", F.lit("source2"))
    s3 = spark.createDataFrame([make("S3", i) for i in range(50)], RECORD).withColumn("source_tag", F.lit("source3"))
    return s1.cache(), normalized(s2.unionByName(s3)).cache()


def plain_pairs(s1, others):
    """Candidates by loops: strategy by strategy, each pair once, in order."""
    import re

    numbers = lambda r: {t for t in re.findall(r"\b\d+\b", f"{r['norm_name']} {r['norm_address']}") if len(t) >= 2}
    keys = [lambda r: r["norm_name"][:5], lambda r: r["norm_name"][-5:], lambda r: r["street_number"] or "", lambda r: r["norm_address"][:6]]
    out = {}
    for rank, key in enumerate([*keys, None]):
        for a, b in itertools.product(s1, others):
            if a["country_norm"] != b["country_norm"]:
                continue
            hit = len(key(a)) >= 2 and key(a) == key(b) if key else bool(numbers(a) & numbers(b))
            if hit:
                out.setdefault((a["entity_id"], b["entity_id"], b["source_tag"]), rank)
    return out


@pytest.mark.parametrize("cap", [0, 1, 3, 30])
def test_capped_union(records, cap):
    s1, others = records
    expected = plain_pairs(s1.collect(), others.collect())
    if cap:
        kept = {}
        for (a, b, t), rank in sorted(expected.items(), key=lambda p: (p[1], p[0][1])):
            kept.setdefault((a, t), []).append((a, b, t))
        expected = {p: expected[p] for group in kept.values() for p in group[:cap]}
    found = blocking.capped_union(Blocking(active_strategies=KEYED, candidate_cap=cap), s1, others)
    assert {tuple(r[:3]): r["strategy_rank"] for r in found.collect()} == expected


def test_strategies_count_without_pairing(records):
    s1, others = records
    for strategy in blocking.strategies(Blocking(active_strategies=KEYED[:4])):
        counted = {r["source_tag"]: r["n_pairs"] for r in strategy.counts(s1, others).collect()}
        listed = {r["source_tag"]: r["count"] for r in strategy(s1, others).groupBy("source_tag").count().collect()}
        assert counted == listed


def test_rare_numbers(spark):
    s1 = normalized(spark.createDataFrame([(f"S1-{i}", f"x {n}", "", "US") for i, n in enumerate([99, 100, 100, 100])], RECORD))
    others = normalized(spark.createDataFrame([("S2-1", "y 99", "", "US"), ("S2-2", "y 100", "", "US")], RECORD)).withColumn("source_tag", F.lit("source2"))
    assert [tuple(r[:2]) for r in blocking.RareTokens(2, 2)(s1, others).collect()] == [("S1-0", "S2-1")]


def test_unknown_strategy():
    with pytest.raises(ValueError):
        blocking.strategies(Blocking(active_strategies=["nope"]))


def test_empty_sides(records):
    s1, others = records
    for a, b in ((s1.limit(0), others), (s1, others.limit(0))):
        assert blocking.capped_union(Blocking(), a, b).collect() == []


def test_nearest_blocks_agree(records):
    s1, others = records
    one = {tuple(r) for r in nearest.tfidf(s1, others).collect()}
    was, nearest.best_of_blocks.__defaults__ = nearest.best_of_blocks.__defaults__, (7, 5, None)
    try:
        assert {tuple(r) for r in nearest.tfidf(s1, others).collect()} == one
    finally:
        nearest.best_of_blocks.__defaults__ = was
    w = nearest.tfidf_weights(s1, others)
    a, b = w.where("side = 1"), w.where("side = 2").select(F.col("entity_id").alias("o"), "source_tag", "country_norm", "term", F.col("weight").alias("v"))
    sims = a.join(b, ["country_norm", "source_tag", "term"]).groupBy("entity_id", "o").agg(F.sum(F.col("weight") * F.col("v")).alias("s"))
    exact = {(r["entity_id"], r["o"]): r["s"] for r in sims.collect()}
    assert one and all(abs(exact[a, b] - s) < 2e-6 for a, b, _, s, _ in one)


def test_similarity_of_odd_characters(spark):
    """Control characters are n-grams like any other, not those of another letter."""
    make = lambda p: [(f"{p}-{i}", "US", name, "1 st") for i, name in enumerate(["a\x01b", "ab", "zz", "a\x01c", "é中"])]
    schema = "entity_id string, country_norm string, norm_name string, norm_address string"
    s1, others = spark.createDataFrame(make("S1"), schema), spark.createDataFrame(make("S2"), schema).withColumn("source_tag", F.lit("source2"))
    found = {(r["source1_entity_id"], r["other_entity_id"]): r["sim"] for r in nearest.tfidf(s1, others, 20, 0.0).collect()}
    w = nearest.tfidf_weights(s1, others).collect()
    vector = lambda side, i: {r["term"]: r["weight"] for r in w if r["side"] == side and r["entity_id"] == i}
    for (a, b), sim in found.items():
        x, y = vector(1, a), vector(2, b)
        assert sim == pytest.approx(sum(x[t] * y.get(t, 0.0) for t in x), abs=2e-6)
    assert len(found) == 25 and all(found[f"S1-{i}", f"S2-{i}"] == 1 for i in range(5))


def plain_features(a, b):
    """All features of two records, by the definitions."""
    from test_functions import plain_indel, plain_partial, plain_set, plain_sort

    (na, aa, sa, ca, la), (nb, ab, sb, cb, lb) = a, b
    jaccard = lambda x, y: len(set(x.split()) & set(y.split())) / len(set(x.split()) | set(y.split())) if x.split() or y.split() else 1.0
    length = lambda x, y: min(len(x), len(y)) / max(len(x), len(y)) if x or y else 1.0
    prefix = next((i for i in range(min(len(na), len(nb))) if na[i] != nb[i]), min(len(na), len(nb)))
    missing = lambda x, y: float(not x.strip() or not y.strip())
    return {
        "name_exact_match": float(na == nb), "name_token_jaccard": jaccard(na, nb), "name_token_sort_ratio": plain_sort(na, nb), "name_token_set_ratio": plain_set(na, nb),
        "name_partial_ratio": plain_partial(na, nb), "name_edit_sim": plain_indel(na, nb), "name_common_prefix_len": prefix / max(len(na), len(nb)) if na or nb else 1.0,
        "name_len_ratio": length(na, nb), "address_exact_match": float(aa == ab), "address_token_overlap": jaccard(aa, ab), "address_edit_sim": plain_indel(aa, ab),
        "address_partial_ratio": plain_partial(aa, ab), "street_number_match": 0.5 if not sa or not sb else float(sa == sb), "address_len_ratio": length(aa, ab),
        "is_landmark_s1": float(la), "is_landmark_other": float(lb), "country_agree": float(ca == cb), "name_missing": missing(na, nb), "address_missing": missing(aa, ab),
        "name_address_combined_sim": (plain_indel(na, nb) + plain_indel(aa, ab)) / 2,
    }


def test_features(records):
    """Every value of every feature, of pairs that block and of others, and of an id without a record."""
    s1, others = records
    pairs = blocking.capped_union(Blocking(active_strategies=KEYED), s1, others).select(*blocking.PAIR).limit(150)
    lost = pairs.limit(1).withColumn("other_entity_id", F.lit("S2-lost"))
    two = others.select("entity_id", "source_tag").limit(4).collect()
    odd = [(r["entity_id"], *other) for r in s1.collect() for other in two]
    rows = features.features(pairs.unionByName(lost).unionByName(pairs.sparkSession.createDataFrame(odd, pairs.schema)), s1, others)
    assert rows.columns == [*blocking.PAIR, *features.FEATURES] and len(features.FEATURES) == 20
    record = lambda r: (r["norm_name"], r["norm_address"], r["street_number"] or "", r["country_norm"], r["is_landmark"])
    at = {r["entity_id"]: record(r) for side in (s1, others) for r in side.collect()}
    found = rows.collect()
    assert len(found) > 200
    for r in found:
        expected = plain_features(at[r["source1_entity_id"]], at.get(r["other_entity_id"], ("", "", "", "", 0)))
        assert {f: r[f] for f in features.FEATURES} == pytest.approx(expected)


def by_entity(spark, pred, true):
    ids = sorted({*pred, *true})
    entities = spark.createDataFrame([(i,) for i in ids], "source1_entity_id string")
    p = spark.createDataFrame([(i, x) for i, xs in pred.items() for x in xs], "source1_entity_id string, other_entity_id string")
    t = spark.createDataFrame([(i, x) for i, xs in true.items() for x in xs], "source1_entity_id string, source_id string")
    return decide.evaluate(entities, p, t).first()


def test_f_half(spark):
    assert by_entity(spark, {"1": "ABC"}, {"1": "AB"})["macro_f05"] == pytest.approx(5 / 7)
    assert by_entity(spark, {"1": "A"}, {"1": "AB"})["macro_f05"] == pytest.approx(5 / 6)
    mixed = by_entity(spark, {"1": "A", "2": "", "3": "B", "4": "X"}, {"1": "A", "2": "", "3": "", "4": "Y"})
    assert (mixed["macro_f05"], mixed["singleton_accuracy"], mixed["n_singletons"]) == (0.5, 0.5, 2)
    none = decide.evaluate(*[spark.createDataFrame([], s) for s in ("source1_entity_id string", "source1_entity_id string, other_entity_id string", "source1_entity_id string, source_id string")]).collect()
    assert [(r["macro_f05"], r["singleton_accuracy"], r["n_entities"]) for r in none] == [(0.0, 1.0, 0)]


SCORED = "source1_entity_id string, other_entity_id string, source_tag string, score double"


def test_thresholds(spark):
    entities = spark.createDataFrame([("a", "US"), ("b", "US"), ("c", "IN")], "source1_entity_id string, country_norm string")
    scored = spark.createDataFrame([("a", "x", "source2", 0.7), ("b", "y", "source2", 0.6), ("c", "z", "source2", 0.35)], SCORED)
    truth = spark.createDataFrame([("a", "x", "source2"), ("c", "z", "source2")], "source1_entity_id string, source_id string, source_tag string")
    assert decide.tune(entities, scored, truth, [0.3, 0.65, 0.7], 0.5) == 0.3  # the first of the best
    assert decide.tune(entities, scored.limit(0), truth, [0.3], 0.5) == 0.5
    found = {r["country_norm"]: r["threshold"] for r in decide.tune_by_country(entities, scored, truth, [0.3, 0.65, 0.7], 0.5, 2).collect()}
    assert found == {"US": 0.65, "IN": 0.3, "_default": 0.3}


def test_assemble(spark):
    entities = spark.createDataFrame([("1", "US"), ("2", "IN"), ("3", "FR")], "source1_entity_id string, country_norm string")
    scored = spark.createDataFrame([("1", "S2-9", "source2", 0.7), ("1", "S2-10", "source2", 0.9), ("2", "S3-1", "source3", 0.4), ("1", "S2-10", "source2", 0.9)], SCORED)
    thresholds = spark.createDataFrame([("US", 0.8), ("IN", 0.3)], "country_norm string, threshold double")
    rows = decide.assemble(entities, scored, thresholds, 0.5)
    assert sorted(map(tuple, rows.collect())) == [("1", "S2-10", "S2-10,S2-9"), ("2", "S3-1", "S3-1"), ("3", "", "")]
    assert tuple(decide.summary(rows).first()) == (3, 2, 2, 1)
    assert sorted(map(tuple, decide.exploded(rows, "candidate_entity_ids").collect())) == [("1", "S2-10"), ("1", "S2-9"), ("2", "S3-1")]


def test_sampling(spark):
    pairs = spark.createDataFrame([("a", str(i), "source2", int(i < 3)) for i in range(50)], "source1_entity_id string, other_entity_id string, source_tag string, label int")
    kept = training.sample_negatives(pairs, 5, 42)
    assert {(r["label"], r["count"]) for r in kept.groupBy("label").count().collect()} == {(1, 3), (0, 15)}
    assert kept.exceptAll(training.sample_negatives(pairs.repartition(3), 5, 42)).count() == 0
    assert training.sample_negatives(pairs.where("label = 0"), 5, 42).count() == 0
    ids = spark.range(10).select(F.col("id").cast("string").alias("entity_id"))
    assert training.split_entities(ids, 0.25, 1).where("part = 'validation'").count() == 2
    assert training.split_entities(ids, 0.01, 1).where("part = 'validation'").count() == 1


def test_ensemble(spark):
    class Fixed:
        def __init__(self, p):
            self.p = p

        def probability(self, rows, name):
            return rows.withColumn(name, F.lit(self.p))

    rows = spark.range(1)
    assert training.Ensemble([Fixed(1.0), Fixed(0.0)], [3, 1]).score(rows).first()["score"] == 0.75
    for learners, weights in (([], []), ([Fixed(1.0)], [1, 2]), ([Fixed(1.0)], [0])):
        with pytest.raises(ValueError):
            training.Ensemble(learners, weights)


def test_recall_and_countries(spark, records):
    s1, others = records
    pairs = spark.createDataFrame([("a", "x", "source2")], "source1_entity_id string, other_entity_id string, source_tag string")
    truth = spark.createDataFrame([("a", "x", "source2"), ("a", "y", "source2"), ("a", "x", "source3")], "source1_entity_id string, source_id string, source_tag string")
    assert sorted(map(tuple, blocking.recall(pairs, truth).collect())) == [("source2", 2, 1, 0.5), ("source3", 1, 0, 0.0)]
    assert [tuple(r) for r in blocking.unseen_countries(s1.where("country_norm = 'US'"), others.where("country_norm = 'IN'")).collect()] == [("IN", "source1"), ("US", "others")]


def test_tsv(spark, tmp_path):
    path = tmp_path / "t.tsv"
    path.write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\textra\nS1-1\t Acme \t"a ""b"""\tUS\t1\nS1-2\t\t\\N\tNULL\t\nS1-3\t NULL \tx\tFR\t2\n')
    rows = [tuple(r) for r in tsv.read_tsv(spark, str(path)).collect()]
    assert rows == [("S1-1", "Acme", 'a "b"', "US", "1"), ("S1-2", "", None, None, ""), ("S1-3", "NULL", "x", "FR", "2")]
    with pytest.raises(tsv.SchemaError, match="business_address .1.*country .1"):
        tsv.read_source(spark, str(path), "source1")
    with pytest.raises(tsv.SchemaError, match="source_id"):
        tsv.read_tsv(spark, str(path), tsv.GROUND_TRUTH)
    assert sorted(r[0] for r in tsv.read_ids(spark, str(path)).collect()) == ["S1-1", "S1-2", "S1-3"]
    tsv.write_tsv(spark.createDataFrame([("a", ""), ("b", "x,y")], "k string, v string").coalesce(1), f"{tmp_path}/out.tsv")
    assert (tmp_path / "out.tsv").read_text() == "k\tv\na\t\nb\tx,y\n"


def test_tsv_empty_and_multiline(spark, tmp_path):
    path = tmp_path / "e.tsv"
    path.write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\n")
    with pytest.raises(tsv.SchemaError, match="no rows"):
        tsv.read_source(spark, str(path), "source2")
    assert tsv.read_tsv(spark, str(path), tsv.SOURCE).count() == 0
    path.write_text('a\tb\n1\t"two\nlines"\n2\tx\n')
    assert sorted(map(tuple, tsv.read_tsv(spark, str(path), multiline=True).collect())) == [("1", "two\nlines"), ("2", "x")]
    path.write_text("a\tb\n" + "".join(f"{i}\tv{i}\n" for i in range(50_000)))
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        rows = tsv.read_tsv(spark, str(path))
        assert rows.rdd.getNumPartitions() > 3 and rows.count() == 50_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)


def test_exact_counts_in_hash_order(spark):
    """Splits and samples of any size are the first in md5 order, without a sort of all rows."""
    import hashlib

    ids = spark.createDataFrame([(f"e{i}",) for i in range(500)], "entity_id string")
    order = sorted((hashlib.md5(f"3|e{i}".encode()).hexdigest(), f"e{i}") for i in range(500))
    for fraction in (0.0, 0.13, 0.999, 1.0):
        n = max(1, int(500 * fraction))
        held = {r["entity_id"] for r in training.split_entities(ids, fraction, 3).where("part = 'validation'").collect()}
        assert held == {e for _, e in order[:n]}
    rows = spark.createDataFrame([("a", str(i), "t", int(i < 4)) for i in range(60)], "source1_entity_id string, other_entity_id string, source_tag string, label int")
    for ratio in (0, 1, 7, 50):
        found = {r["other_entity_id"] for r in training.sample_negatives(rows, ratio, 1).collect()}
        negatives = sorted((hashlib.md5(f"1|a|{i}|t".encode()).hexdigest(), str(i)) for i in range(4, 60))
        assert found == {"0", "1", "2", "3"} | {i for _, i in negatives[: 4 * ratio]}
    assert training.positive_rate(rows) == pytest.approx(4 / 60) and training.positive_rate(rows.limit(0)) == 0
    assert training.split_entities(ids.limit(0), 0.5, 1).collect() == []


def test_report_keeps_a_few_of_very_many(spark):
    found = spark.createDataFrame([("r", f"o{i % 300:03}") for i in range(900)] + [("s", "x")], "rule string, offender string")
    assert sorted(map(tuple, check.report(found).collect())) == [("r", 300, "o000, o001, o002, o003, o004"), ("s", 1, "x")]


def test_checks(spark, tmp_path):
    ids = tmp_path / "s1.tsv"
    ids.write_text("entity_id\tn\nS1-1\ta\nS1-2\tb\nS1-3\tc\n")

    def found(matches, candidates="source1_entity_id\tcandidate_entity_ids\nS1-1\tS2-1\nS1-2\t\nS1-3\tS2-1\n", valid=None):
        (tmp_path / "m.tsv").write_text(matches)
        (tmp_path / "c.tsv").write_text(candidates)
        return check.validate(spark, f"{tmp_path}/m.tsv", f"{tmp_path}/c.tsv", str(ids), valid)

    head = "source1_entity_id\tmatched_entity_ids\n"
    good = found(head + "S1-1\tS2-1\nS1-2\t\nS1-3\t\n")
    assert good.errors == [] and len(good.warnings) == 1
    bad = found(head + "S1-1\tS2-1,S2-1\nS1-1\tS1-2\nS1-2\tX1,S2-9\nS1-9\t\nno tab\n", valid=spark.createDataFrame([("S2-1",)], "entity_id string"))
    text = "\n".join(bad.errors)
    for rule in ("duplicate_row", "duplicate_id", "self_match", "wrong_prefix", "unknown_id", "missing_entity", "extra_entity", "without tab"):
        assert rule in text
    assert any("outside their candidates" in w for w in bad.warnings)
    assert "commas" in found("source1_entity_id,matched_entity_ids\n").errors[0]
    assert "header" in found("a\tb\n").errors[0]
    assert "not found" in check.validate(spark, f"{tmp_path}/none.tsv", None, str(ids)).errors[0]


def test_settings(tmp_path, monkeypatch):
    path = tmp_path / "c.yaml"
    path.write_text("random_seed: 7\nblocking:\n  candidate_cap: 5\npaths:\n  data_dir: here\ntraining:\n")
    monkeypatch.setenv("LINKLOOM_DATA_DIR", "there")
    monkeypatch.setenv("LINKLOOM_USE_DENSE", "1")
    cfg = load_config(path)
    assert (cfg.random_seed, cfg.blocking.candidate_cap, cfg.paths.data_dir, cfg.blocking.use_dense_embedding) == (7, 5, "there", True)
    monkeypatch.setenv("LINKLOOM_FAST_MODE", "true")
    assert load_config(path).blocking.use_dense_embedding is False
    monkeypatch.chdir(tmp_path)
    assert load_config().decision.default_threshold == 0.5
    with pytest.raises(FileNotFoundError):
        load_config(tmp_path / "none.yaml")


NESTED = """
blocking:
  active_strategies: [name_prefix, address_prefix]
  name_prefix: {prefix_len: 3}
  name_suffix: {suffix_len: 4}
  address_number: {min_token_len: 2}
  address_prefix: {prefix_len: 9}
  rare_numeric_token: {max_frequency: 7}
  tfidf_nn: {top_k: 3, min_similarity: 0.4, max_features: 200000, ngram_range: [1, 2], analyzer: char_wb}
  dense_embedding_nn: {top_k: 2, min_similarity: 0.9, model_name: any, batch_size: 1}
io: {chunk_size: 10, source_encoding: latin-1, delimiter: ";"}
models:
  lightgbm: {n_estimators: 11, num_leaves: 63}
  xgboost: {n_estimators: 12, max_depth: 4}
  ensemble: {weights: [1, 2]}
  active_model: lightgbm
features: {name_edit_low_threshold: 0.5}
normalization: {name_max_tokens: 8}
logging: {level: DEBUG, format: x}
"""


def test_nested_settings_steer(tmp_path, records):
    (tmp_path / "n.yaml").write_text(NESTED)
    cfg = load_config(tmp_path / "n.yaml")
    b, m = cfg.blocking, cfg.models
    assert (b.name_prefix_len, b.name_suffix_len, b.address_number_len, b.address_prefix_len, b.rare_max_frequency) == (3, 4, 2, 9, 7)
    assert (b.tfidf_top_k, b.tfidf_min_similarity, b.dense_top_k, b.dense_min_similarity) == (3, 0.4, 2, 0.9)
    assert (cfg.files.encoding, cfg.files.delimiter, cfg.log_level) == ("latin-1", ";", "DEBUG")
    assert (m.active_model, m.gbt_trees, m.forest_trees, m.forest_depth, m.weights) == ("boosted", 11, 12, 4, [1, 2])
    s1, others = records
    keys = {(r["a"], r["b"]) for r in blocking.strategies(b)[0](s1, others).select(F.col("source1_entity_id").alias("a"), F.col("other_entity_id").alias("b")).collect()}
    one = {(r["entity_id"], r["norm_name"][:3], r["country_norm"]) for r in s1.collect()}
    two = {(r["entity_id"], r["norm_name"][:3], r["country_norm"]) for r in others.collect()}
    assert keys == {(x[0], y[0]) for x in one for y in two if x[1:] == y[1:] and len(x[1]) >= 2}


@pytest.mark.parametrize("text", ["blocking: {candidat_cap: 5}", "nothing: 1", "blocking: {name_prefix: {len: 2}}", "blocking: {tfidf_nn: {ngram_range: [1, 3]}}", "models: {catboost: {depth: 3}}"])
def test_unknown_settings_are_refused(tmp_path, text):
    (tmp_path / "c.yaml").write_text(text)
    with pytest.raises(ValueError, match="unknown setting|only"):
        load_config(tmp_path / "c.yaml")


def test_large_blocks_are_skipped_on_request(records):
    s1, others = records
    cfg = Blocking(active_strategies=["name_prefix"], candidate_cap=0, max_block_size=3, skip_large_blocks=True)
    found = {(r["source1_entity_id"], r["other_entity_id"]) for r in blocking.capped_union(cfg, s1, others).collect()}
    a, b = s1.collect(), others.collect()
    key = lambda r: (r["country_norm"], r["norm_name"][:5])
    size = {}
    for r in b:
        size[*key(r), r["source_tag"]] = size.get((*key(r), r["source_tag"]), 0) + 1
    assert found == {(x["entity_id"], y["entity_id"]) for x in a for y in b if key(x) == key(y) and len(key(x)[1]) >= 2 and size[*key(y), y["source_tag"]] <= 3}
    skipped = blocking.without_large_blocks(blocking.strategies(cfg)[0], s1, others, 3)[1].agg(F.sum("skipped")).first()[0] or 0
    assert skipped == sum(n > 3 and len(k[1]) >= 2 and any(key(x) == k[:2] for x in a) for k, n in size.items())


def test_diagnostics_and_coverage(spark, records):
    """Counts from blocks' sizes, and recall from the true pairs' own keys, against the pairs themselves."""
    s1, others = records
    found = blocking.strategies(Blocking(active_strategies=KEYED))
    ids = [r["entity_id"] for r in s1.orderBy("entity_id").collect()]
    truth = spark.createDataFrame([(a, r["entity_id"], r["source_tag"]) for i, r in enumerate(others.orderBy("entity_id").collect()) for a in (ids[i % len(ids)], ids[(3 * i + 1) % len(ids)])], "source1_entity_id string, source_id string, source_tag string").distinct()
    by = {(r["source_tag"], r["strategy_name"]): (r["pairs"], r["recall"]) for r in blocking.diagnostics(found, s1, others, truth).collect()}
    everything = set()
    for f in found:
        pairs = {(r["source_tag"], r["source1_entity_id"], r["other_entity_id"]) for r in f(s1, others).collect()}
        everything |= pairs
        for tag in ("source2", "source3"):
            own, true = {p for p in pairs if p[0] == tag}, {(t, a, b) for a, b, t in map(tuple, truth.collect()) if t == tag}
            n, share = by.get((tag, f.name), (None, None))
            assert (n or 0) == len(own) and share == pytest.approx(len(own & true) / len(true))
    met = {(r["source_tag"], r["source1_entity_id"], r["other_entity_id"]) for r in blocking.covered(found, s1, others, truth).collect()}
    assert met == everything & {(t, a, b) for a, b, t in map(tuple, truth.collect())}


def test_models_are_saved_and_loaded(spark, tmp_path):
    """Also a learner that saw one label only, and one that replaces it at the same place."""
    make = lambda label: spark.createDataFrame([[float(i % 2 if f == "name_edit_sim" else 0.5) for f in features.FEATURES] + [label(i)] for i in range(20)], [*features.FEATURES, "label"])
    cfg = Models(active_model="forest", forest_trees=3, forest_depth=2)
    for label, expected in ((lambda i: 1, {1.0}), (lambda i: i % 2, None), (lambda i: 0, {0.0})):
        rows = make(label)
        scores = lambda model: sorted(r["score"] for r in model.score(rows).collect())
        made = training.build_model(cfg, 1).fit(rows)
        made.save(f"{tmp_path}/m")
        again = scores(training.build_model(cfg, 1).load(f"{tmp_path}/m"))
        assert again == scores(made) and (expected is None or set(again) == expected)
    assert made.importances() == {}


def test_first_pairs_are_the_union_without_a_shuffle_of_pairs(spark, monkeypatch):
    """block_union_dedup: also of ids with several records, in several countries, and of blocks split among tasks."""
    monkeypatch.setattr(blocking, "BLOCK_PAIRS", 3)
    def rows(side, n, *tag):
        made = []
        for i in range(n):
            own = f"{side}{i % (n - 6)}"  # six ids have two records
            number = None if i % 5 == 0 else str(10 + i % 4)
            made.append((own, "DE" if i % 3 else "FR", f"name{i % 3}{'xyz' * (i % 2)} {i % 4 + 20} {i % 7 + 30}", f"{number or ''} road {i % 4} {i % 5 + 40}", number, *[f"source{2 + i % 2}" for _ in tag]))
        return spark.createDataFrame(made, "entity_id string, country_norm string, norm_name string, norm_address string, street_number string" + "".join(f", {t} string" for t in tag))

    s1, others = rows("a", 40), rows("b", 60, "source_tag")
    found = blocking.strategies(Blocking(active_strategies=KEYED))
    made, expected = blocking.first_pairs(found, s1, others), blocking.first_strategy(blocking.union(found, s1, others))
    assert made.columns == expected.columns and made.dtypes == expected.dtypes
    got = sorted(map(tuple, made.collect()))
    assert got == sorted(map(tuple, expected.collect())) and {r[5] for r in got} == set(KEYED)
    plan = made._jdf.queryExecution().sparkPlan().toString()
    assert "Aggregate" not in plan.split("SortMergeJoin")[0].split("ShuffledHashJoin")[0].split("BroadcastHashJoin")[0]


def test_learners_get_all_rows_in_as_few_tasks_as_they_fill(spark, monkeypatch):
    """gbt_score: every row once, whatever the partitions that the rows come in."""
    seen = []

    class Seen(training.Learner):
        def fit(self, rows):
            seen.append((rows.rdd.getNumPartitions(), sorted(map(tuple, rows.collect()))))
            return self

    monkeypatch.setattr(training, "TASK_ROWS", 40)
    rows = spark.createDataFrame([[float(i)] * len(features.FEATURES) + [i % 2, str(i)] for i in range(100)], [*features.FEATURES, "label", "id"])
    training.Ensemble([Seen(None), Seen(None)], [1.0, 1.0]).fit(rows.repartition(12))
    expected = sorted(map(tuple, rows.drop("id").collect()))
    assert seen == [(3, expected)] * 2


def test_settled_rows_are_the_same_under_a_plan_of_one_step(spark):
    """gbt_score: jobs over the labelled pairs don't carry the plan that made them."""
    rows = spark.range(100).selectExpr("id % 7 AS k").groupBy("k").count().join(spark.range(7).withColumnRenamed("id", "k"), "k")
    kept = training.settled(rows)
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, rows.collect())) and len(kept.collect()) == 7
    assert "Join" not in kept._jdf.queryExecution().executedPlan().toString()


def test_gbt_score_learns_from_every_feature_with_the_default_models(spark, monkeypatch):
    seen = {}

    class Seen:
        def fit(self, rows):
            return self

        def score(self, rows):
            seen["rows"] = rows
            return rows.withColumn("score", F.lit(0.5))

    def build(cfg, seed):
        seen["models"] = cfg
        return Seen()

    monkeypatch.setattr(training, "build_model", build)
    d = "/root/testdata/sf0.001"
    n = queries.gbt_score(spark, d).count()
    rows = seen["rows"].select(*blocking.PAIR, *features.FEATURES)
    whole = queries.feature_matrix(spark, d).select(*rows.columns)
    assert seen["models"] == Models()
    assert n == whole.count() > 0 and rows.exceptAll(whole).count() == 0
    assert rows.where("name_edit_sim > 0 AND name_partial_ratio > 0 AND name_address_combined_sim > 0").count() > 0


def test_trader_pairs_are_joined_once_and_only_wanted_ratios_are_computed(spark, monkeypatch):
    """feat_indel_ratio, feat_partial: after the join of the two sides no pair is shuffled."""
    from linkloom.functions import fuzzy

    seen = []
    monkeypatch.setattr(features, "fuzzy_sides", lambda sides: seen.append(sides) or fuzzy.fuzzy_sides(sides))
    d = "/root/testdata/sf0.001"
    for name, kind in (("feat_indel_ratio", "indel"), ("feat_partial", "partial")):
        rows = queries.QUERIES[name](spark, d)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert plan.split("InMemoryTableScan")[0].count("Join") == 1
        assert {k for _, _, kinds in seen.pop().values() for k in kinds} == {kind}
        pairs = rows.select("source1_entity_id", "other_entity_id")
        a, b = (x.select("entity_id", "country_norm", F.right("norm_name", F.lit(1)).alias("end")).toDF(f"{p}id", "country", "end") for x, p in zip(queries.traders(spark, d), "ab"))
        expected = a.join(b, ["country", "end"]).select("aid", "bid")
        assert pairs.count() == expected.count() > 0 and pairs.exceptAll(expected).count() == 0


def test_stream_of_arrivals(spark, tmp_path, records):
    s1, _ = records
    schema = f"{RECORD}, source_tag string"
    rows = [("S2-a", "Acme Robotics Inc", "123 Innovation Drive", "US", "source2"), ("S3-b", "Nobody", "", "US", "source3")]
    spark.createDataFrame(rows, schema).write.json(f"{tmp_path}/in")
    stream = spark.readStream.schema(schema).json(f"{tmp_path}/in")
    done = link_arrivals(stream, s1, Blocking(active_strategies=KEYED), f"{tmp_path}/out", f"{tmp_path}/state")
    done.awaitTermination(120)
    found = spark.read.parquet(f"{tmp_path}/out")
    assert {r["other_entity_id"] for r in found.collect()} == {"S2-a"}
