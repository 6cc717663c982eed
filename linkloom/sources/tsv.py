"""Tab-separated tables: reading with null markers and checks, writing one file per table."""

from __future__ import annotations

from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What stands for null in a file. An empty field is an empty string.
NULLS = ("\\N", "NULL")


class SchemaError(ValueError):
    """A table lacks columns, or required values."""


@dataclass(frozen=True)
class TableSpec:
    """Column names, all strings; the required ones may not be null."""

    columns: tuple[str, ...]
    required: tuple[str, ...] = ()


SOURCE = TableSpec(("entity_id", "business_name", "business_address", "country"), ("entity_id", "business_name", "business_address", "country"))
GROUND_TRUTH = TableSpec(("source1_entity_id", "source_id", "source_tag"), ("source1_entity_id", "source_id", "source_tag"))
MATCHES = TableSpec(("source1_entity_id", "matched_entity_ids"), ("source1_entity_id",))
CANDIDATES = TableSpec(("source1_entity_id", "candidate_entity_ids"), ("source1_entity_id",))


def null_counts(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """column, n_null of each column, in one pass."""
    one = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c), F.lit(0).cast("long")).alias("n_null")) for c in columns])
    return one.select(F.explode(pairs).alias("p")).select("p.*")


def check(df: DataFrame, spec: TableSpec, name: str = "table", may_be_empty: bool = True) -> None:
    """Raise SchemaError if a column is absent, a required one holds nulls, or rows are needed and there are none; extra columns are fine."""
    if absent := [c for c in spec.columns if c not in df.columns]:
        raise SchemaError(f"{name}: no column {', '.join(absent)}")
    if not may_be_empty and not df.head(1):
        raise SchemaError(f"{name}: no rows")
    if bad := [f"{r['column']} ({r['n_null']})" for r in null_counts(df, spec.required).collect() if r["n_null"]]:
        raise SchemaError(f"{name}: nulls in {', '.join(bad)}")


def read_tsv(spark: SparkSession, path: str, spec: TableSpec | None = None, encoding: str = "utf-8", delimiter: str = "\t", multiline: bool = False, may_be_empty: bool = True) -> DataFrame:
    """All columns as trimmed strings; the null markers are null before the trim, an empty field is empty.

    A large file is split among tasks, unless ``multiline`` (quoted fields that hold line ends).
    """
    options = {"sep": delimiter, "header": True, "quote": '"', "escape": '"', "encoding": encoding, "multiLine": multiline}
    raw = spark.read.options(**options).csv(path)
    raw = spark.read.options(**options).schema(T.StructType([T.StructField(c.strip(), T.StringType()) for c in raw.columns])).csv(path)
    cells = [F.when(F.col(f"`{c}`").isin(*NULLS), None).otherwise(F.trim(F.coalesce(F.col(f"`{c}`"), F.lit("")))).alias(c) for c in raw.columns]
    out = raw.select(*cells)
    if spec:
        check(out, spec, path, may_be_empty)
    return out


def read_source(spark: SparkSession, path: str, tag: str, **kw) -> DataFrame:
    """A source's records with its tag; one without records is an error."""
    return read_tsv(spark, path, SOURCE, may_be_empty=False, **kw).withColumn("source_tag", F.lit(tag))


def read_results(spark: SparkSession, path: str, spec: TableSpec = MATCHES, **kw) -> DataFrame:
    """A result file as pairs, source1_entity_id and other_entity_id; entities without any have no row."""
    rows = read_tsv(spark, path, spec, **kw)
    ids = F.filter(F.transform(F.split(spec.columns[1], ","), lambda x: F.trim(x)), lambda x: x != "")
    return rows.select("source1_entity_id", F.explode(ids).alias("other_entity_id")).distinct()


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """entity_id: distinct first fields of a file's lines after the header, blank lines left out."""
    lines = spark.read.text(path).where("trim(value) <> ''")
    head = spark.read.text(path).limit(1).first()
    ids = lines.select(F.trim(F.split("value", "\t")[0]).alias("entity_id"))
    if head:
        ids = ids.where(F.col("entity_id") != F.lit(head["value"].split("\t")[0].strip()))
    return ids.distinct()


def write_tsv(df: DataFrame, path: str, delimiter: str = "\t") -> None:
    """One file at ``path``, with header; an empty string is an empty field. The rows stream through one task."""
    spark = df.sparkSession
    part = f"{path}.parts"
    df.coalesce(1).write.mode("overwrite").options(sep=delimiter, header=True, emptyValue="", quote='"', escape='"').csv(part)
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(part)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found = next(f.getPath() for f in store.listStatus(folder) if f.getPath().getName().startswith("part-"))
    target = jvm.org.apache.hadoop.fs.Path(path)
    store.delete(target, False)
    store.rename(found, target)
    store.delete(folder, True)
    if store.getScheme() == "file":  # else the checksum would forbid later edits of the file
        plain = Path(target.toUri().getPath())
        (plain.parent / f".{plain.name}.crc").unlink(missing_ok=True)
