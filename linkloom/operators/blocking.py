"""Candidate generation: blocking strategies, their union by priority, the cap per entity.

A strategy takes the normalised Source-1 records and the others (with source_tag) and gives candidate pairs:
source1_entity_id, other_entity_id, source_tag, in_rank (its own order, 0 if it has none). Countries and tags
are join keys, never loops. Joins are plain equi-joins, which the engine splits where keys are skewed.

``capped_union`` needs, of each key's block and tag, only the first ``cap`` others in id order: an entity
keeps at most ``cap`` pairs, in order of strategy and id, and what a strategy skips because an earlier one had
it has taken a place there as well. So blocks are cut to ``cap`` before the join, the result is the same as
without the cut, and no block is multiplied out.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.config import Blocking
from linkloom.functions import text
from linkloom.operators import nearest

Strategy = Callable[[DataFrame, DataFrame], DataFrame]
PAIR = ["source1_entity_id", "other_entity_id", "source_tag"]
#: Pairs of a block that one task makes in ``first_pairs``; larger blocks are split by their first side.
BLOCK_PAIRS = 1 << 22


def _keyed(records: DataFrame, key: Column, least: int, id_name: str, *more: str) -> DataFrame:
    return records.select(F.col("entity_id").alias(id_name), "country_norm", *more, key.alias("key")).where(F.length("key") >= least)


def _cut(others: DataFrame, most: int | None) -> DataFrame:
    if not most:
        return others
    order = Window.partitionBy("country_norm", "source_tag", "key").orderBy("other_entity_id")
    return others.withColumn("n", F.dense_rank().over(order)).where(F.col("n") <= most).drop("n")


class KeyBlocking:
    """Pairs of equal keys within a country. ``most`` cuts a block's others to the first in id order."""

    def __init__(self, name: str, key: Callable[[], Column], least: int):
        self.name, self.key, self.least = name, key, least

    def sides(self, s1: DataFrame, others: DataFrame) -> tuple[DataFrame, DataFrame]:
        return _keyed(s1, self.key(), self.least, "source1_entity_id"), _keyed(others, self.key(), self.least, "other_entity_id", "source_tag")

    def pairs(self, s1: DataFrame, others: DataFrame, most: int | None = None) -> DataFrame:
        """The pairs of every block; a pair may occur more than once."""
        a, b = self.sides(s1, others)
        return a.join(_cut(b, most), ["country_norm", "key"]).select(*PAIR, F.lit(0).alias("in_rank"))

    def __call__(self, s1: DataFrame, others: DataFrame) -> DataFrame:
        """Each pair once: a record has one key, so it is enough that records are distinct."""
        a, b = (x.distinct() for x in self.sides(s1, others))
        return a.join(b, ["country_norm", "key"]).select(*PAIR, F.lit(0).alias("in_rank"))

    def counts(self, s1: DataFrame, others: DataFrame) -> DataFrame:
        """source_tag, n_pairs: how many pairs there are, from the blocks' sizes alone."""
        a, b = (x.distinct() for x in self.sides(s1, others))
        a = a.groupBy("country_norm", "key").agg(F.count("*").alias("n1"))
        b = b.groupBy("country_norm", "key", "source_tag").agg(F.count("*").alias("n2"))
        return a.join(b, ["country_norm", "key"]).groupBy("source_tag").agg(F.sum(F.col("n1") * F.col("n2")).alias("n_pairs"))

    def covered(self, s1: DataFrame, others: DataFrame, truth: DataFrame) -> DataFrame:
        """The true pairs that share a block, from their own keys: no block is multiplied out."""
        a, b = self.sides(s1, others)
        a = a.select("source1_entity_id", "country_norm", "key")
        t = truth.select("source1_entity_id", F.col("source_id").alias("other_entity_id"), "source_tag").distinct()
        return t.join(a, "source1_entity_id").join(b, ["other_entity_id", "source_tag", "country_norm", "key"]).select(*PAIR).distinct()


class RareTokens(KeyBlocking):
    """Pairs that share a number which at most ``max_frequency`` Source-1 records of the country hold."""

    def __init__(self, max_frequency: int, least: int):
        super().__init__("rare_numeric_token", None, least)
        self.max_frequency = max_frequency

    def sides(self, s1: DataFrame, others: DataFrame) -> tuple[DataFrame, DataFrame]:
        def tokens(rows: DataFrame, id_name: str, *more: str) -> DataFrame:
            both = F.concat_ws(" ", "norm_name", "norm_address")
            rows = rows.select(F.col("entity_id").alias(id_name), "country_norm", *more, F.explode(F.array_distinct(text.numeric_tokens(both))).alias("key"))
            return rows.where(F.length("key") >= self.least)

        a, b = tokens(s1, "source1_entity_id"), tokens(others, "other_entity_id", "source_tag")
        rare = token_frequency(a).where(F.col("n") <= self.max_frequency).drop("n")
        return a.join(rare, ["country_norm", "key"], "left_semi"), b

    def __call__(self, s1: DataFrame, others: DataFrame) -> DataFrame:
        """Each pair once; records have several numbers and may share more than one."""
        return self.pairs(s1, others).distinct()

    def counts(self, s1: DataFrame, others: DataFrame) -> DataFrame:
        return self(s1, others).groupBy("source_tag").agg(F.count("*").alias("n_pairs"))


def token_frequency(tokens: DataFrame) -> DataFrame:
    """country_norm, key, n: how many records hold each token."""
    return tokens.groupBy("country_norm", "key").agg(F.countDistinct("source1_entity_id").alias("n"))


class Nearest:
    """Pairs of the nearest others by a similarity, best first."""

    def __init__(self, name: str, join: Callable[[DataFrame, DataFrame], DataFrame]):
        self.name, self.join = name, join

    def pairs(self, s1: DataFrame, others: DataFrame, most: int | None = None) -> DataFrame:
        return self.join(s1, others).select(*PAIR, F.col("rank").alias("in_rank"))

    def __call__(self, s1: DataFrame, others: DataFrame) -> DataFrame:
        return self.pairs(s1, others)

    def counts(self, s1: DataFrame, others: DataFrame) -> DataFrame:
        return self(s1, others).groupBy("source_tag").agg(F.count("*").alias("n_pairs"))

    def covered(self, s1: DataFrame, others: DataFrame, truth: DataFrame) -> DataFrame:
        t = truth.select("source1_entity_id", F.col("source_id").alias("other_entity_id"), "source_tag").distinct()
        return t.join(self(s1, others), PAIR, "left_semi").select(*PAIR)


def strategies(cfg: Blocking) -> list:
    """The configured strategies in priority order; unknown names are refused."""
    known = {
        "name_prefix": lambda: KeyBlocking("name_prefix", lambda: F.left("norm_name", F.lit(cfg.name_prefix_len)), cfg.min_key_length),
        "name_suffix": lambda: KeyBlocking("name_suffix", lambda: F.right("norm_name", F.lit(cfg.name_suffix_len)), cfg.min_key_length),
        "address_number": lambda: KeyBlocking("address_number", lambda: F.col("street_number"), max(cfg.min_key_length, cfg.address_number_len, 1)),
        "address_prefix": lambda: KeyBlocking("address_prefix", lambda: F.left("norm_address", F.lit(cfg.address_prefix_len)), cfg.min_key_length),
        "rare_numeric_token": lambda: RareTokens(cfg.rare_max_frequency, cfg.min_key_length),
        "tfidf_nn": lambda: Nearest("tfidf_nn", lambda a, b: nearest.tfidf(a, b, cfg.tfidf_top_k, cfg.tfidf_min_similarity, cfg.min_key_length)),
    }
    if unknown := [n for n in cfg.active_strategies if n not in known]:
        raise ValueError(f"unknown blocking strategies: {', '.join(unknown)}")
    found = [known[n]() for n in cfg.active_strategies]
    if cfg.use_dense_embedding:
        found.append(Nearest("dense_embedding_nn", lambda a, b: nearest.dense(a, b, cfg.dense_top_k, cfg.dense_min_similarity, cfg.min_key_length)))
    return found


def union(found: list, s1: DataFrame, others: DataFrame, cut: bool = False, most: int | None = None) -> DataFrame:
    """All strategies' pairs with strategy_name and strategy_rank; ``cut``: of cut blocks, repeated pairs left in."""
    parts = [(f.pairs(s1, others, most) if cut else f(s1, others)).withColumns({"strategy_name": F.lit(f.name), "strategy_rank": F.lit(i)}) for i, f in enumerate(found)]
    return reduce(DataFrame.unionByName, parts)


def first_strategy(pairs: DataFrame) -> DataFrame:
    """Each pair once, under the first strategy that found it."""
    best = F.min(F.struct("strategy_rank", "in_rank", "strategy_name")).alias("best")
    return pairs.groupBy(*PAIR).agg(best).select(*PAIR, "best.*")


def first_pairs(found: list, s1: DataFrame, others: DataFrame) -> DataFrame:
    """What ``first_strategy(union(found, ...))`` gives; of key strategies without a shuffle of pairs.

    An id carries its keys of all strategies, so a block's pair tells by itself whether an earlier strategy, or a smaller
    key of the same one, has it too, and each is made once. All blocks meet in one join, large ones in several tasks.
    """
    if not all(isinstance(f, KeyBlocking) for f in found):
        return first_strategy(union(found, s1, others))
    spark, ranks = s1.sparkSession, range(len(found))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    both = [f.sides(s1, others) for f in found]

    def side(which: int, p: str, *ids: str) -> DataFrame:
        """A row per id, strategy s and key (with its country); of each strategy the only key {p}k, or else all of them {p}m."""
        key = F.concat(F.length("country_norm").cast("string"), F.lit(" "), "country_norm", "key").alias("key")
        rows = reduce(DataFrame.unionByName, [x[which].select(*ids, F.lit(i).alias("s"), key) for i, x in enumerate(both)]).where("key IS NOT NULL")
        sets = [F.collect_set(F.when(F.col("s") == i, F.col("key"))).alias(f"{p}{i}") for i in ranks]
        rows = rows.groupBy(*ids).agg(F.collect_set(F.struct("s", "key")).alias("__all"), *sets)
        one = [F.when(F.size(f"{p}{i}") == 1, F.col(f"{p}{i}")[0]).alias(f"{p}k{i}") for i in ranks]
        more = [F.when(F.size(f"{p}{i}") > 1, F.col(f"{p}{i}")).alias(f"{p}m{i}") for i in ranks]
        return rows.select(*ids, *one, *more, F.explode("__all").alias("__own")).select("__own.*", "*").drop("__own")

    a, b = side(0, "a", "source1_entity_id"), side(1, "b", "other_entity_id", "source_tag")
    sizes = [x.groupBy("s", "key").agg(F.count("*").alias(n)) for x, n in ((a, "na"), (b, "nb"))]
    parts = F.ceil(F.col("na") * F.col("nb") / BLOCK_PAIRS).cast("int")
    blocks = sizes[0].join(sizes[1], ["s", "key"]).select("s", "key", F.least(parts, F.col("na").cast("int"), F.lit(tasks)).alias("parts"))
    a = a.join(blocks, ["s", "key"]).withColumn("part", F.pmod(F.xxhash64("source1_entity_id"), "parts").cast("int")).drop("parts")
    b = b.join(blocks, ["s", "key"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")

    def whole(p: str, i: int) -> Column:
        return F.coalesce(F.col(f"{p}m{i}"), F.array(f"{p}k{i}"))

    def single(i: int) -> Column:
        return F.col(f"am{i}").isNull() & F.col(f"bm{i}").isNull()

    earlier = F.lit(False)
    for i in ranks:
        met = F.when(single(i), F.col(f"ak{i}") == F.col(f"bk{i}")).otherwise(F.arrays_overlap(whole("a", i), whole("b", i)))
        least = single(i) | (F.array_min(F.array_intersect(whole("a", i), whole("b", i))) == F.col("key"))
        earlier = earlier | F.when(F.col("s") > i, F.coalesce(met, F.lit(False))).when(F.col("s") == i, ~least).otherwise(False)
    on = ["s", "key", "part"]
    rows = a.repartition(tasks, *on).join(b.repartition(tasks, *on), on).where(~earlier)
    names = F.element_at(F.array(*[F.lit(f.name) for f in found]), F.col("s") + 1)
    return rows.select(*PAIR, F.col("s").alias("strategy_rank"), F.lit(0).alias("in_rank"), names.alias("strategy_name"))


def cap(pairs: DataFrame, most: int) -> DataFrame:
    """At most ``most`` pairs of each entity and tag, in order of strategy, its own rank and id; 0 or less keeps all."""
    if most <= 0:
        return pairs
    order = Window.partitionBy("source_tag", "source1_entity_id").orderBy("strategy_rank", "in_rank", "other_entity_id")
    return pairs.withColumn("n", F.row_number().over(order)).where(F.col("n") <= most).drop("n")


def drop_large_blocks(others: DataFrame, key: Column, most: int) -> DataFrame:
    """Others whose block holds at most ``most`` of them."""
    size = others.groupBy("country_norm", key.alias("key")).count().where(F.col("count") > most)
    return others.withColumn("key", key).join(size.drop("count"), ["country_norm", "key"], "left_anti").drop("key")


def without_large_blocks(strategy: KeyBlocking, s1: DataFrame, others: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """A strategy's pairs (a pair may occur more than once) of blocks of up to ``most`` others, and the number of larger ones by tag."""
    a, b = strategy.sides(s1, others)
    large = b.groupBy("country_norm", "source_tag", "key").count().where(F.col("count") > most).drop("count")
    kept = b.join(large, ["country_norm", "source_tag", "key"], "left_anti")
    met = large.join(a.select("country_norm", "key").distinct(), ["country_norm", "key"], "left_semi")
    return a.join(kept, ["country_norm", "key"]).select(*PAIR, F.lit(0).alias("in_rank")), met.groupBy("source_tag").agg(F.count("*").alias("skipped"))


def capped_union(cfg: Blocking, s1: DataFrame, others: DataFrame) -> DataFrame:
    """The candidates: union, one row per pair, capped. With ``skip_large_blocks``, without the pairs of large blocks."""
    most = cfg.candidate_cap if cfg.candidate_cap > 0 else None
    found = strategies(cfg)
    if not cfg.skip_large_blocks:
        return cap(first_strategy(union(found, s1, others, True, most)), cfg.candidate_cap)
    parts = [without_large_blocks(f, s1, others, cfg.max_block_size)[0] if isinstance(f, KeyBlocking) else f.pairs(s1, others) for f in found]
    named = [p.withColumns({"strategy_name": F.lit(f.name), "strategy_rank": F.lit(i)}) for i, (f, p) in enumerate(zip(found, parts))]
    return cap(first_strategy(reduce(DataFrame.unionByName, named)), cfg.candidate_cap)


def covered(found: list, s1: DataFrame, others: DataFrame, truth: DataFrame) -> DataFrame:
    """The true pairs that any strategy has in a block."""
    return reduce(DataFrame.unionByName, [f.covered(s1, others, truth) for f in found]).distinct()


def diagnostics(found: list, s1: DataFrame, others: DataFrame, truth: DataFrame | None = None) -> DataFrame:
    """source_tag, strategy_name, pairs, and with ``truth`` recall: what each strategy finds by itself, from the blocks' sizes."""
    rows = reduce(DataFrame.unionByName, [f.counts(s1, others).select("source_tag", F.lit(f.name).alias("strategy_name"), F.col("n_pairs").cast("long").alias("pairs")) for f in found])
    if truth is None:
        return rows
    own = [recall(f.covered(s1, others, truth), truth).select("source_tag", F.lit(f.name).alias("strategy_name"), "recall") for f in found]
    return rows.join(reduce(DataFrame.unionByName, own), ["source_tag", "strategy_name"], "full")


def unseen_countries(s1: DataFrame, others: DataFrame) -> DataFrame:
    """country_norm, missing_in: countries that only one side has."""
    a, b = s1.select("country_norm").distinct(), others.select("country_norm").distinct()
    return b.join(a, "country_norm", "left_anti").withColumn("missing_in", F.lit("source1")).unionByName(
        a.join(b, "country_norm", "left_anti").withColumn("missing_in", F.lit("others"))
    )


def recall(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """source_tag, n_true, n_found, recall of the true pairs of every tag; 1 for a tag without any."""
    found = pairs.select(F.col("source1_entity_id").alias("a"), F.col("other_entity_id").alias("b"), F.col("source_tag").alias("t"), F.lit(1).alias("hit")).distinct()
    rows = truth.join(found, (F.col("source1_entity_id") == F.col("a")) & (F.col("source_id") == F.col("b")) & (F.col("source_tag") == F.col("t")), "left")
    rows = rows.groupBy("source_tag").agg(F.count("*").alias("n_true"), F.count("hit").alias("n_found"))
    return rows.withColumn("recall", F.when(F.col("n_true") == 0, 1.0).otherwise(F.col("n_found") / F.col("n_true")))
