"""Nearest-neighbour joins: character n-gram TF-IDF and dense vectors, exact, block by block.

Within a country (and tag) both sides are dealt into blocks of bounded size, each packed into one row, and every
pair of blocks is multiplied as matrices by one task, which keeps the best ``k`` of each row; a final rank merges
the blocks' winners. A block of the others moves once, to the task that all blocks of the first side come to; what
is copied is packed blocks of the first side, one for each block of the others, never single rows. Nothing is
broadcast, no side is gathered, and the rows between the stages are k per row and block.
Similarities are rounded before ranks and thresholds so that the order does not depend on summation order.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.functions import text
from linkloom.functions.similarity import cosine

#: Rows of a block of the first side, and of the others.
BLOCK_ROWS = 2000
OTHER_ROWS = 4000
DIGITS = 6


def name_and_address() -> Column:
    return F.concat(F.coalesce("norm_name", F.lit("")), F.lit(" "), F.coalesce("norm_address", F.lit("")))


def long_enough(least: int) -> Column:
    return F.length(F.trim(name_and_address())) >= least


def texts(records: DataFrame, least: int) -> DataFrame:
    """entity_id, country_norm, .., text: name and address as one string, if long enough."""
    keep = [c for c in ("entity_id", "country_norm", "source_tag") if c in records.columns]
    return records.select(*keep, name_and_address().alias("text")).where(F.length(F.trim("text")) >= least)


def tfidf_weights(s1: DataFrame, others: DataFrame, least: int = 2) -> DataFrame:
    """side, entity_id, country_norm, source_tag, term, weight: sublinear tf times smoothed idf, normalised.

    The corpus of a country and tag is its Source-1 and other texts together.
    """
    a, b = texts(s1, least), texts(others, least)
    tags = b.select("country_norm", "source_tag").distinct()
    rows = a.join(tags, "country_norm").withColumn("side", F.lit(1)).unionByName(b.withColumn("side", F.lit(2)))
    group = ["country_norm", "source_tag"]
    docs = rows.groupBy(*group).agg(F.count("*").alias("n_docs"))
    terms = rows.select("side", "entity_id", *group, F.explode(text.char_ngrams(F.col("text"))).alias("term"))
    tf = terms.groupBy("side", "entity_id", *group, "term").agg(F.count("*").alias("tf"))
    df = tf.groupBy(*group, "term").agg(F.count("*").alias("df"))
    idf = df.join(docs, group).select(*group, "term", (F.log((1 + F.col("n_docs")) / (1 + F.col("df"))) + 1).alias("idf"))
    w = tf.join(idf, [*group, "term"]).withColumn("w", (1 + F.log(F.col("tf").cast("double"))) * F.col("idf"))
    norm = w.groupBy("side", "entity_id", *group).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return w.join(norm, ["side", "entity_id", *group]).select("side", "entity_id", *group, "term", (F.col("w") / F.col("norm")).alias("weight"))


def term_codes(strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Row and n-gram code of every character n-gram (1 and 2, padded words) of the strings, whatever their characters."""
    padded = [f" {w} " for s in strings for w in s.split()]
    owner = np.repeat(np.arange(len(strings)), [len(s.split()) for s in strings])
    sizes = np.fromiter(map(len, padded), np.int64, len(padded))
    points = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    rows, inner = np.repeat(owner, sizes), np.ones(len(points), bool)
    inner[np.cumsum(sizes) - 1] = False  # no n-gram runs over a word's end
    inner = np.flatnonzero(inner)
    return np.concatenate([rows, rows[inner]]), np.concatenate([points, points[inner] + 1 << 21 | points[inner + 1]] if len(inner) else [points])


def term_code(term: str) -> int:
    return ord(term) if len(term) == 1 else ord(term[0]) + 1 << 21 | ord(term[1])


class Weights:
    """The inverse document frequencies of a country and tag, by n-gram code."""

    def __init__(self, table: str):
        found = sorted((term_code(t), w) for t, w in json.loads(table).items())
        self.codes, self.idf = np.array([c for c, _ in found], np.int64), np.array([w for _, w in found])

    def rows(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, place of the n-gram and weight of the entries of the normalised TF-IDF rows."""
        rows, codes = term_codes(strings)
        at, tf = np.unique(rows * len(self.codes) + np.searchsorted(self.codes, codes), return_counts=True)
        row, place = at // max(1, len(self.codes)), at % max(1, len(self.codes))
        w = (1 + np.log(tf)) * self.idf[place]
        norm = np.sqrt(np.bincount(row, w * w, minlength=len(strings)))
        return row, place, w / norm[row]

    def matrix(self, strings: list[str], columns: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Rows as a dense matrix over ``columns`` (places of n-grams; those that occur, if None), and these."""
        row, place, w = self.rows(strings)
        columns = np.unique(place) if columns is None else columns
        at = np.minimum(np.searchsorted(columns, place), max(0, len(columns) - 1))
        use = columns[at] == place if len(columns) else np.zeros(len(place), bool)
        out = np.zeros((len(strings), len(columns)))
        out[row[use], at[use]] = w[use]
        return out, columns


def packed_rows(rows: pd.DataFrame) -> bytes:
    """A table as one value."""
    table = pa.Table.from_pandas(rows, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def unpacked(data: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(data).read_all().to_pandas()


def best_of_blocks(a: DataFrame, b: DataFrame, prepare: Callable, k: int, least: float, column: str, block_rows: int = BLOCK_ROWS, other_rows: int = OTHER_ROWS, extra: DataFrame | None = None) -> DataFrame:
    """source1_entity_id, other_entity_id, source_tag, sim, rank of the k most similar others of every row of ``a``.

    ``a``: entity_id, country_norm, source_tag and ``column``; ``b`` the same. ``prepare`` takes the ``column`` of a
    block of the others, and gives the function that makes a block of the first side's into the matrix of
    similarities. ``extra``: a value ``more`` per country and tag that ``prepare`` gets as well.
    """
    group = ["country_norm", "source_tag"]

    def blocks(rows: DataFrame, side: str, size: int) -> tuple[DataFrame, DataFrame]:
        """Packed blocks of a side, and how many each country and tag has."""
        sizes = rows.groupBy(*group).agg(F.ceil(F.count("*") / size).cast("int").alias("n"))
        dealt = rows.join(sizes, group).withColumn("block", F.pmod(F.xxhash64("entity_id"), F.col("n")).cast("int"))

        def pack(x: pd.DataFrame) -> pd.DataFrame:
            own = x[["entity_id", column]].sort_values("entity_id", kind="stable")
            return pd.DataFrame([(*x[["country_norm", "source_tag", "block"]].iloc[0], packed_rows(own))], columns=["c", "t", "block", "data"])

        packs = dealt.select(*group, "block", "entity_id", column).groupBy(*group, "block").applyInPandas(pack, "c string, t string, block int, data binary")
        return packs.toDF(f"c_{side}", f"t_{side}", f"block_{side}", f"data_{side}"), sizes

    (first, _), (others, many) = blocks(a, "a", block_rows), blocks(b, "b", other_rows)
    more = many if extra is None else many.join(extra, group)
    more = more.withColumn("block_m", F.explode(F.sequence(F.lit(0), F.col("n") - 1))).withColumnsRenamed({"country_norm": "c_m", "source_tag": "t_m"})
    more = more if extra is not None else more.withColumn("more", F.lit(None).cast("string"))
    others = others.join(more, (F.col("c_b") == F.col("c_m")) & (F.col("t_b") == F.col("t_m")) & (F.col("block_b") == F.col("block_m")))
    copies = first.join(many, (F.col("c_a") == F.col("country_norm")) & (F.col("t_a") == F.col("source_tag"))).withColumn("to", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    met = copies.select("c_a", "t_a", "to", "data_a").join(others, (F.col("c_a") == F.col("c_b")) & (F.col("t_a") == F.col("t_b")) & (F.col("to") == F.col("block_b")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, y, similarity = None, None, None
        for batch in batches:
            for i in range(batch.num_rows):
                tag, one, other, with_more = (c[i].as_py() for c in batch.columns)
                if other != held:
                    held, y = other, unpacked(other)
                    similarity = prepare(y[column], with_more)
                x = unpacked(one)
                sim = np.round(similarity(x[column]), DIGITS)
                order = np.argsort(-sim, axis=1, kind="stable")[:, :k]
                top = np.take_along_axis(sim, order, axis=1)
                keep = top >= least
                row, _ = np.nonzero(keep)
                out = [x["entity_id"].to_numpy()[row], y["entity_id"].to_numpy()[order[keep]], np.full(len(row), tag, object)]
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.string()) for c in out), pa.array(top[keep])], ["source1_entity_id", "other_entity_id", "source_tag", "sim"])

    found = met.select("t_a", "data_a", "data_b", "more").mapInArrow(run, "source1_entity_id string, other_entity_id string, source_tag string, sim double")
    order = Window.partitionBy("source_tag", "source1_entity_id").orderBy(F.desc("sim"), "other_entity_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def tfidf(s1: DataFrame, others: DataFrame, k: int = 20, least_sim: float = 0.10, least: int = 2) -> DataFrame:
    """The k most similar others by TF-IDF cosine of character n-grams, within country and tag."""
    group = ["country_norm", "source_tag"]
    a, b = texts(s1, least), texts(others, least)
    a = a.join(b.select(*group).distinct(), "country_norm")
    rows = a.unionByName(b)
    docs = rows.groupBy(*group).agg(F.count("*").alias("n_docs"))
    terms = rows.select(*group, F.explode(F.array_distinct(text.char_ngrams(F.col("text")))).alias("term"))
    df = terms.groupBy(*group, "term").agg(F.count("*").alias("df")).join(docs, group)
    idf = F.log((1 + F.col("n_docs")) / (1 + F.col("df"))) + 1
    # a table a group: normalised text is ASCII, which bounds its n-grams
    tables = df.groupBy(*group).agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("term", idf.alias("idf"))))).alias("more"))

    def prepare(y: pd.Series, table: str) -> Callable[[pd.Series], np.ndarray]:
        weights = Weights(table)
        own, columns = weights.matrix(y.tolist())
        return lambda x: weights.matrix(x.tolist(), columns)[0] @ own.T

    return best_of_blocks(a, b, prepare, k, least_sim, "text", extra=tables)


def dense(s1: DataFrame, others: DataFrame, k: int = 20, least_sim: float = 0.60, least: int = 0) -> DataFrame:
    """The k most similar others by cosine of the column embedding, within country and tag.

    With ``least`` above 0, only of records whose name and address are long enough.
    """
    if least > 0:
        s1, others = s1.where(long_enough(least)), others.where(long_enough(least))
    group = ["country_norm", "source_tag"]
    b = others.select("entity_id", *group, F.col("embedding").cast("array<double>").alias("v"))
    a = s1.select("entity_id", "country_norm", F.col("embedding").cast("array<double>").alias("v"))
    a = a.join(b.select(*group).distinct(), "country_norm")

    def unit(rows: pd.Series) -> np.ndarray:
        m = np.stack(rows.to_numpy())
        n = np.sqrt((m * m).sum(axis=1, keepdims=True))
        return m / np.where(n == 0, 1, n)

    def prepare(y: pd.Series, _: None) -> Callable[[pd.Series], np.ndarray]:
        own = unit(y)
        return lambda x: unit(x) @ own.T

    return best_of_blocks(a, b, prepare, k, least_sim, "v")


__all__ = ["best_of_blocks", "cosine", "dense", "tfidf", "tfidf_weights"]
