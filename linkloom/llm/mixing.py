"""Mixing sources to target weights: words per source, repetition rates, hash-seeded copies.

Sources, ordered by code point with null last, weigh ``weights`` in turn. They share all words by weight;
a target stops at ``most`` times its source's size and what it leaves is shared again among the others. There may be
as many sources as documents: they are ranked by ranges and shared out by aggregates, never sorted in one task. A
document is taken floor(rate) times, and once more if a hash of its id falls below the rate's fraction, so
a rerun takes the same copies.

Edge cases: null text has size 0, which takes no words; a null source is a source of its own; a source
without words has target 0 and none of its documents is emitted; rows without an id draw by their text; equal
doc_ids, and equal texts without one, draw alike, so a source whose words are mostly such rows may miss its target
by the rate's fraction of them; extra columns are kept, and those of the plan are named ``__mix_*`` until the end
so that none clashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.llm.common import WORD, scratch, written

WEIGHTS = (1, 2, 3)
MOST = 3
SEED = "mix-1"
#: The plan has a row per source; up to this many it is broadcast, beyond it the join is shuffled.
BROADCAST_SOURCES = 100_000


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def name(doc_id: Column, text: Column) -> Column:
    """What a row draws by: its id, or its text where it has none."""
    return F.coalesce(doc_id.cast("string"), F.concat(F.lit("text:"), F.coalesce(text.cast("string"), F.lit(""))))


def draw(name: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from a hash of a row's name: 52 bits of md5."""
    digest = F.md5(F.concat(F.lit(seed + ":"), name))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def ranked(one: DataFrame) -> DataFrame:
    """``one`` (source, ..) with rank, its place among the sources in order of code point, null last.

    Ranges of sources are numbered by themselves; what the driver sees is a count a range.
    """
    last = F.col("source").asc_nulls_last()
    ranges = written(one.repartitionByRange(last).withColumn("part", F.spark_partition_id()), "ranges")
    counts, before, total = dict(ranges.groupBy("part").count().collect()), [], 0
    for part in range(max(counts, default=-1) + 1):
        before.append(total)
        total += counts.get(part, 0)
    own = F.row_number().over(Window.partitionBy("part").orderBy(last)) - 1
    start = F.element_at(F.array(*[F.lit(n).cast("long") for n in before or [0]]), F.col("part") + 1)
    return ranges.withColumn("rank", own + start).drop("part")


def plan(sizes: DataFrame, weights: tuple = WEIGHTS, most: int = MOST) -> DataFrame:
    """__mix_source, __mix_source_size, __mix_target, __mix_rate from rows of (source, size), as a written table.

    What capped sources leave is shared again by weight until none is above its cap. A round is one aggregate
    over the sources, and only adds to the capped ones; sums of words are whole numbers, so no order of adding matters.
    """
    with scratch(sizes.sparkSession) as keep:
        turn = F.array(*[F.lit(float(w)) for w in weights])
        one = ranked(sizes.groupBy("source").agg(F.sum("size").alias("size")))
        one = one.withColumn("w", F.element_at(turn, (F.col("rank") % len(weights) + 1).cast("int")))
        one = written(one.withColumn("cap", F.col("size").cast("double") * most), "sources")
        whole = one.agg(F.sum("size").cast("double").alias("size"), F.sum("w").alias("w")).first()
        total, all_w = whole["size"] or 0.0, whole["w"] or 0.0
        capped, spent, free_w, n = F.lit(False), 0.0, all_w, -1
        while True:
            capped = F.col("cap") * free_w <= F.col("w") * (total - spent)
            row = one.where(capped).agg(F.count("*").alias("n"), F.sum("cap").alias("cap"), F.sum("w").alias("w")).first()
            if row["n"] == n or not row["n"]:
                break
            n, spent, free_w = row["n"], row["cap"], all_w - row["w"]
        share = F.col("w") * (total - spent) / (free_w or 1.0)
        target = F.when(capped, F.col("cap")).otherwise(share)
        rate = F.when(F.col("size") > 0, target / F.col("size")).otherwise(0.0)
        found = one.select(F.col("source").alias("__mix_source"), F.col("size").alias("__mix_source_size"), target.alias("__mix_target"), rate.alias("__mix_rate"))
        return keep(written(found, "mixture"))


def with_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` (source, __mix_draw, ...) with their source's plan, a written table, and __mix_copies, the times that a row is taken."""
    if plan.count() <= BROADCAST_SOURCES:
        plan = F.broadcast(plan)
    rows = rows.join(plan, rows["source"].eqNullSafe(F.col("__mix_source")), "left")
    whole = F.floor("__mix_rate")
    extra = (F.col("__mix_draw") < F.col("__mix_rate") - whole).cast("long")
    return rows.withColumn("__mix_copies", whole + extra)


def sized(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", words(F.col("text")).alias("size"), draw(name(F.col("doc_id"), F.col("text"))).alias("__mix_draw"))


def mix(docs: DataFrame, weights: tuple = WEIGHTS, most: int = MOST) -> DataFrame:
    """The mixture: each row of ``docs`` as often as it is taken, with the columns of ``docs``."""
    rows = with_plan(docs.withColumn("__mix_draw", draw(name(F.col("doc_id"), F.col("text")))), plan(sized(docs), weights, most))
    rows = rows.where("__mix_copies > 0").withColumn("__mix_copy", F.explode(F.expr("sequence(1L, __mix_copies)")))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])


def mixture_report(docs: DataFrame, weights: tuple = WEIGHTS, most: int = MOST) -> DataFrame:
    """doc_id, size, source_size, target, taken (words that the mix takes, repeats counted), source, copies."""
    sizes = written(sized(docs), "sizes")  # ids, sources and numbers: texts are read once
    rows = with_plan(sizes, plan(sizes, weights, most))
    return rows.select(
        "doc_id", "size",
        F.col("__mix_source_size").alias("source_size"),
        F.col("__mix_target").alias("target"),
        (F.col("size") * F.col("__mix_copies")).alias("taken"),
        F.col("__mix_copies").alias("copies"),
    )


#: The same in DuckDB: sizes, shares up to the caps, and the draw from md5.
SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(doc_id::VARCHAR, 'text:' || coalesce(text, '')) AS name, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS size, row_number() OVER (ORDER BY encode(source) ASC NULLS LAST) - 1 AS rank FROM d GROUP BY source),
w AS (SELECT *, (rank % 3 + 1)::DOUBLE AS w, size::DOUBLE * 3 AS cap FROM s),
f AS (SELECT *, (sum(size) OVER ())::DOUBLE AS total,
        sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY cap / w, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS w_left,
        coalesce(sum(cap) OVER (ORDER BY cap / w, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cap_before FROM w),
c AS (SELECT *, cap * w_left <= w * (total - cap_before) AS capped FROM f),
g AS (SELECT *, sum(CASE WHEN capped THEN 0.0::DOUBLE ELSE w END) OVER () AS free_w, sum(CASE WHEN capped THEN cap ELSE 0.0::DOUBLE END) OVER () AS spent FROM c),
t AS (SELECT source, size AS source_size, CASE WHEN capped THEN cap ELSE w * (total - spent) / free_w END AS target FROM g),
r AS (SELECT d.doc_id, d.name, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS rate
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
k AS (SELECT *, floor(rate)::BIGINT + (('0x' || substr(md5('mix-1:' || name), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0::DOUBLE < rate - floor(rate))::BIGINT AS copies FROM r)
SELECT doc_id, size, source_size, target, size * copies AS taken, copies FROM k
"""
