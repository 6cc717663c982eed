"""Lempel-Ziv phrase fingerprints: texts that share much of their dictionary of phrases are alike.

A text is parsed into phrases, each the shortest string that is not yet in the text's dictionary; a last
phrase that is already known adds nothing. The hashes of the phrase set are reduced to its ``SIZE`` smallest,
and the likeness of two fingerprints is the share of the smallest hashes of their union that both have: an
estimate of the Jaccard similarity of the phrase sets, exact for sets of up to ``SIZE`` phrases.

Neighbours in doc_id order meet by range: bounds from quantiles of the ids cut them into buckets, and the
first document of each bucket is sent to the one before it as well. Rows that share an id, or have none, stand in
the order of a hash of their texts, and those of a very frequent id are cut into buckets by it. Texts are shuffled once.

Edge cases: null text is empty; an empty text has the empty fingerprint, alike only to itself (1.0); null
doc_ids come last, equal doc_ids are ordered by the text's hash and text; a single document is its own next one; an
empty table gives no rows; extra columns are not read. A text and its phrases have to fit a task.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import slices

SIZE = 128
#: Buckets of the doc_id order for each shuffle partition.
BUCKETS = 6
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers = {True: np.ones(1, np.uint64), False: np.ones(1, np.uint64)}


def powers(n: int, up: bool) -> np.ndarray:
    """The first n powers of BASE (or of its inverse) modulo 2**64, kept up to a bounded length."""
    have = _powers[up]
    if len(have) < n:
        by = BASE if up else INVERSE
        have = np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(n, 1 << 15) - 1, by)]), dtype=np.uint64)
        if n <= 1 << 22:
            _powers[up] = have
    return have[:n]


def parse(codes: list[int], start: int, to: int, known: dict[int, int], node: int = 0) -> tuple[list[int], int]:
    """Where the phrases of codes[start:to] end, and the node reached; ``known`` is the trie so far, node << 21 | code."""
    ends, find, size, i = [], known.get, len(known), start
    for c in codes[start:to]:
        i += 1
        key = node << 21 | c
        node = find(key, 0)
        if not node:
            size += 1
            known[key] = size
            ends.append(i)
    return ends, node


def signature(points: np.ndarray, ends: list[int], size: int = SIZE) -> np.ndarray:
    """The smallest 32-bit hashes, in order, of the phrases of a text that end at ``ends``."""
    if not ends:
        return np.zeros(0, np.uint32)
    to = np.array(ends)
    at = np.concatenate([[0], to[:-1]])
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((points + np.uint64(1)) * powers(len(points), True), dtype=np.uint64)])
    h = (sums[to] - sums[at]) * powers(int(at[-1]) + 1, False)[at]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    h = (h >> np.uint64(32)).astype(np.uint32)
    found = np.unique(np.partition(h, 2 * size)[: 2 * size]) if len(h) > 4 * size else np.unique(h)
    return (found if len(found) >= size or len(h) <= 4 * size else np.unique(h))[:size]


def likeness(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> float:
    if not len(a) and not len(b):
        return 1.0
    both = np.sort(np.concatenate([a, b]))
    same = both[1:] == both[:-1]
    first = np.concatenate([[True], ~same])
    kept = int(first.cumsum().searchsorted(size, side="right"))  # up to the last copy of the size-th value
    n = min(size, int(first.sum()))
    return int(same[: max(0, kept - 1)].sum()) / n


def hexed(s: np.ndarray) -> str:
    return s.astype(">u4").tobytes().hex()


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


class Document:
    """A text with its parse; the edited text shares the parse of what they have in common."""

    def __init__(self, doc_id: int | None, text: str):
        self.doc_id, self.text, self.n = doc_id, text, len(text)
        self.points = code_points(text)
        codes = self.points.tolist()
        self.cut = self.n - self.n // 4
        known: dict[int, int] = {}
        self.ends, self.node = parse(codes, 0, self.cut, known)
        self.known = known.copy() if self.cut < self.n else known
        more, _ = parse(codes, self.cut, self.n, known, self.node)
        self.print = signature(self.points, self.ends + more)

    def edited(self, after: str) -> tuple[str, np.ndarray]:
        """The edited text, its tail replaced by as much of the next text, and its fingerprint."""
        tail = after[: self.n - self.cut]
        points = np.concatenate([self.points[: self.cut], code_points(tail)])
        more, _ = parse(points.tolist(), self.cut, len(points), self.known, self.node)
        return self.text[: self.cut] + tail, signature(points, self.ends + more)


def longs(values: list[int | None]) -> Column:
    """An array of numbers as one constant, however many they are."""
    return F.from_json(F.lit(json.dumps(values)), "array<bigint>")


def with_buckets(docs: DataFrame, parts: int) -> DataFrame:
    """__b, __halo, __h, doc_id, text: each row in its bucket of the order (doc_id, __h), and the first of a bucket in the one before too.

    The bounds are at most ``parts`` quantiles; an id that more rows share than a bucket should have is a bound by
    itself, and its rows are dealt by ``__h`` to as many buckets as they fill. The firsts are one row per bucket.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("__h", F.shiftrightunsigned(F.xxhash64("text"), 1))
    probs = [i / parts for i in range(1, parts)]
    found = rows.agg(F.count("*").alias("n"), F.percentile_approx("doc_id", probs, 10 * parts).alias("q") if probs else F.lit(None).alias("q")).first()
    bounds = sorted(set(found["q"] or []))
    # how many buckets the rows of each bound, and those without an id, fill; a bucket's other ids come after its bound
    wanted = F.broadcast(rows.sparkSession.createDataFrame([(b,) for b in [*bounds, None]], "b long"))
    counts = {r["doc_id"]: r["count"] for r in rows.join(wanted, F.col("doc_id").eqNullSafe(F.col("b")), "left_semi").groupBy("doc_id").count().collect()}
    fill = [1, *(max(1, round(counts.get(b, 0) * parts / max(1, found["n"]))) for b in [*bounds, None])]
    base = [0]
    for m in fill:
        base.append(base[-1] + (m + 1 if m > 1 else 1))
    step = max(1, int(len(bounds) ** 0.5))
    below = lambda xs: F.size(F.filter(xs, lambda b: b <= F.col("doc_id")))
    group = F.greatest(below(longs(bounds[::step])) - 1, F.lit(0))
    at = group * step + below(F.slice(longs(bounds), group * step + 1, F.lit(step)))
    rows = rows.withColumn("__at", F.when(F.col("doc_id").isNull(), len(bounds) + 1).otherwise(at).cast("int"))
    own, many = F.element_at(longs([None, *bounds, None]), F.col("__at") + 1), F.element_at(longs(fill), F.col("__at") + 1)
    piece = F.least(F.floor(F.col("__h") / float(1 << 63) * many), many - 1)
    later = F.when(many <= 1, 0).when((F.col("__at") > 0) & F.col("doc_id").eqNullSafe(own), piece).otherwise(many)
    rows = rows.withColumn("__b", (F.element_at(longs(base), F.col("__at") + 1) + later).cast("int"))
    firsts = {r["__b"]: r["first"] for r in rows.groupBy("__b").agg(F.min(F.struct("doc_id", "__h")).alias("first")).collect()}
    order = sorted(firsts)
    before = {b: order[i - 1] for i, b in enumerate(order)}
    place, of = F.col("__b") + 1, lambda x: longs([x(firsts[b]) if b in firsts else None for b in range(base[-1] + 1)])
    first = F.col("doc_id").eqNullSafe(F.element_at(of(lambda f: f["doc_id"]), place)) & (F.col("__h") == F.element_at(of(lambda f: f["__h"]), place))
    back = F.element_at(longs([before.get(b) for b in range(base[-1] + 1)]), place).cast("int")
    rows = rows.withColumn("__back", F.when(first, back))
    own = F.struct(F.col("__b").alias("b"), F.lit(False).alias("halo"))
    also = F.struct(F.col("__back").alias("b"), F.lit(True).alias("halo"))
    places = F.when(F.col("__back").isNull(), F.array(own)).otherwise(F.array(own, also))
    return rows.select(F.explode_outer(places).alias("p"), "__h", "doc_id", "text").select(F.col("p.b").alias("__b"), F.col("p.halo").alias("__halo"), "__h", "doc_id", "text")


def compare(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every document."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def row(d: Document, after: Document) -> tuple:
        text, edited = d.edited(after.text)
        sha = hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
        return d.doc_id, d.n, sha, hexed(d.print), hexed(edited), likeness(d.print, edited), likeness(d.print, after.print)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        names = [c.split(" ")[0] for c in schema.split(", ")]
        bucket, last, over = None, None, False
        for batch in slices(batches, "text", 4 << 20):
            out = []
            for b, halo, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                if b != bucket:
                    bucket, last, over = b, None, False
                if over:  # more rows like the one that ends the bucket
                    continue
                this = Document(doc_id, text)
                if last is not None:
                    out.append(row(last, this))
                last, over = this, halo
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * len(kinds), kinds)], names)

    # several buckets a task even out what their hash deals to each
    rows = with_buckets(docs, BUCKETS * parts).repartition(parts, "__b")
    rows = rows.sortWithinPartitions("__b", "__halo", F.col("doc_id").asc_nulls_last(), "__h", "text")
    return rows.select("__b", "__halo", "doc_id", "text").mapInArrow(run, schema)
