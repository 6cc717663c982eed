"""Checks of result files: rules, offenders, and a report."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from linkloom.sources.tsv import CANDIDATES, MATCHES, read_ids

EXAMPLES = 5


def violations(rows: DataFrame, required: DataFrame, valid: DataFrame | None = None) -> DataFrame:
    """rule, offender: every breach of ``rows`` (source1_entity_id, ids: the raw comma-joined list).

    ``required``: entity_id of all entities that need a row; ``valid``: entity_id of all that may be listed.
    """
    rule = lambda df, name, column: df.select(F.lit(name).alias("rule"), F.col(column).alias("offender"))
    key = "source1_entity_id"
    listed = rows.where(F.trim("ids") != "").select(key, F.split("ids", ",").alias("list"))
    each = listed.select(key, F.explode("list").alias("id"))
    ids = each.select("id").distinct()
    known = F.col("id").startswith("S2-") | F.col("id").startswith("S3-")
    found = rule(rows.groupBy(key).count().where("count > 1"), "duplicate_row", key)
    found = found.unionByName(rule(listed.where(F.size("list") > F.size(F.array_distinct("list"))).select(key).distinct(), "duplicate_id", key))
    found = found.unionByName(rule(ids.where(F.col("id").startswith("S1-")), "self_match", "id"))
    found = found.unionByName(rule(ids.where(~known & ~F.col("id").startswith("S1-")), "wrong_prefix", "id"))
    if valid is not None:
        found = found.unionByName(rule(ids.where(known).join(valid, F.col("id") == F.col("entity_id"), "left_anti"), "unknown_id", "id"))
    seen = rows.select(key).distinct()
    found = found.unionByName(rule(required.distinct().join(seen, F.col("entity_id") == F.col(key), "left_anti"), "missing_entity", "entity_id"))
    return found.unionByName(rule(seen.join(required, F.col(key) == F.col("entity_id"), "left_anti"), "extra_entity", key))


def report(found: DataFrame) -> DataFrame:
    """rule, n, examples: how many offenders, and the first few in order; no rule's offenders are gathered."""
    each = found.distinct()
    rank = F.row_number().over(Window.partitionBy("rule").orderBy("offender"))
    few = each.withColumn("at", rank).where(F.col("at") <= EXAMPLES).groupBy("rule").agg(F.array_join(F.array_sort(F.collect_list("offender")), ", ").alias("examples"))
    return each.groupBy("rule").agg(F.count("*").alias("n")).join(few, "rule")


def outside_candidates(matched: DataFrame, candidates: DataFrame) -> DataFrame:
    """source1_entity_id of entities with a match that is no candidate of theirs (both: source1_entity_id, other_entity_id)."""
    return matched.join(candidates, ["source1_entity_id", "other_entity_id"], "left_anti").select("source1_entity_id").distinct()


@dataclass
class Findings:
    errors: list[str] = field(default_factory=list)
    warnings: list[str] = field(default_factory=list)


def read_list_file(spark: SparkSession, path: str, header: tuple[str, ...], findings: Findings) -> DataFrame | None:
    """source1_entity_id, ids of a result file, or None if it is absent, empty or has another header."""
    try:
        lines = spark.read.text(path)
        head = lines.first()
    except AnalysisException:
        findings.errors.append(f"{path}: not found")
        return None
    if head is None:
        findings.errors.append(f"{path}: empty")
        return None
    first = head["value"]
    if "\t" not in first and "," in first:
        findings.errors.append(f"{path}: separated by commas, not tabs")
        return None
    if [c.strip().lower() for c in first.split("\t")] != list(header):
        findings.errors.append(f"{path}: header {first!r}, not {' '.join(header)}")
        return None
    body = lines.where(F.col("value") != F.lit(first))
    for row in body.where(~F.col("value").contains("\t") & (F.trim("value") != "")).limit(EXAMPLES).collect():
        findings.errors.append(f"{path}: row without tab: {row['value']!r}")
    return body.where(F.col("value").contains("\t")).select(F.split("value", "\t", 2)[0].alias("source1_entity_id"), F.split("value", "\t", 2)[1].alias("ids"))


def validate(spark: SparkSession, matches: str, candidates: str | None, source1: str, valid: DataFrame | None = None) -> Findings:
    """All checks of the result files; a missing candidate file only warns, as do matches outside the candidates."""
    findings, pairs = Findings(), {}
    required = read_ids(spark, source1)
    if valid is None:
        findings.warnings.append("listed ids are not checked against the sources")
    for path, spec in ((matches, MATCHES), (candidates, CANDIDATES)):
        if path is None:
            continue
        own = Findings()
        rows = read_list_file(spark, path, spec.columns, own)
        if spec is CANDIDATES and own.errors and own.errors[0].endswith("not found"):
            findings.warnings += own.errors
            continue
        findings.errors += own.errors
        if rows is None:
            continue
        for r in report(violations(rows, required, valid)).orderBy("rule").collect():
            findings.errors.append(f"{path}: {r['rule']}: {r['n']}, such as {r['examples']}")
        pairs[spec] = rows.where(F.trim("ids") != "").select("source1_entity_id", F.explode(F.split("ids", ",")).alias("other_entity_id"))
    if len(pairs) == 2:
        if n := outside_candidates(pairs[MATCHES], pairs[CANDIDATES]).count():
            findings.warnings.append(f"{n} entities have matches outside their candidates")
    return findings
