"""Nearest neighbours by vantage-point trees, one per shard.

Vectors are dealt into shards of about ``SHARD_ROWS`` by a hash of the row. In a shard's tree each inner node
has a vantage vector and the radius that halves the rest into near and far; a leaf holds a few vectors, or any
number at one distance from the vantage vector (copies). A search keeps the best ``k`` so far and skips a
side when the triangle inequality, its bound multiplied by ``factor``, says that nothing there is nearer:
factor 1 is exact, larger factors skip more. Queries meet the trees in packed blocks; a block goes down a tree
together: each query first to its own leaf, for a bound, and then to every node that the bound leaves it. In
a leaf, a matrix product finds the rows that may be near enough, and only their exact distances are taken.
Each query's best of every shard are then merged.

Edge cases: vectors that are null, of zero length, all zeros, or hold null or non-finite components take no part;
with fewer than k candidates all are returned; equal distances go to the smaller vec_id; vectors of another
dimension than the query's are no candidates. Repeated rows of an id are a query each and a candidate each, but a
query never meets rows of its own id. Rows that are repeated very often travel once, with their number.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkloom.llm.common import slices, written

SHARD_ROWS = 8192
BLOCK_QUERIES = 256
LEAF = 64
K = 10
#: Rounding of distances may not prune: bounds are loosened by this much, relatively.
SLACK = 1e-9
#: Pairs of a query and a row whose exact distances are taken at once.
PAIRS = 1 << 14
#: Rows of an id from which on equal rows are counted rather than moved.
REPEATS = 1000


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, v (array of double): the rows that take part."""
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & F.coalesce(finite & F.exists("v", lambda x: x != 0), F.lit(False)))


def distances(rows: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Euclidean distances, the squares added in the order of the components (so that equal vectors tie exactly)."""
    diff = rows - q
    diff *= diff
    return np.sqrt(np.add.accumulate(diff, axis=1)[:, -1])


class Tree:
    """A vantage-point tree over the rows of one shard, as arrays: rows are reordered so that a node's are adjacent."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, leaf: int = LEAF):
        self.order = np.lexsort([ids])
        self.ids, self.rows = ids[self.order], rows[self.order]
        nodes: list[list[float]] = []  # start, end, vantage row (-1: leaf), near child, far child, near max, far min, far max
        order = np.arange(len(ids))
        todo = [(0, len(ids), -1, 0)]
        while todo:
            a, b, parent, side = todo.pop()
            at = len(nodes)
            if parent >= 0:
                nodes[parent][3 + side] = at
            nodes.append([a, b, -1, -1, -1, 0.0, 0.0, 0.0])
            if b - a <= leaf:
                continue
            vantage = order[a + (b - a) // 2]
            d = distances(self.rows[order[a:b]], self.rows[vantage])
            sort = np.argsort(d, kind="stable")
            order[a:b], d = order[a:b][sort], d[sort]
            mid = (b - a) // 2
            if d[0] == d[-1]:
                continue  # copies: nothing to split
            while mid < b - a and d[mid] == d[mid - 1]:
                mid += 1  # equal distances stay on one side
            if mid == b - a:
                mid = int(np.searchsorted(d, d[-1]))
            nodes[at][2:] = [float(vantage), -1, -1, d[mid - 1], d[mid], d[-1]]
            todo += [(a + mid, b, at, 1), (a, a + mid, at, 0)]
        self.nodes, self.points = np.array(nodes).reshape(-1, 8), order

    def pack(self) -> tuple:
        return self.ids.tobytes(), self.rows.tobytes(), self.nodes.tobytes(), self.points.astype(np.int64).tobytes()

    @classmethod
    def unpack(cls, ids: bytes, rows: bytes, nodes: bytes, points: bytes) -> Tree:
        self = cls.__new__(cls)
        self.ids = np.frombuffer(ids, np.int64)
        self.rows = np.frombuffer(rows, np.float64).reshape(len(self.ids), -1)
        self.nodes, self.points = np.frombuffer(nodes, np.float64).reshape(-1, 8), np.frombuffer(points, np.int64)
        return self

    def search(self, own: np.ndarray, qs: np.ndarray, k: int, factor: float = 1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query position, id and distance of the nearest rows of other ids than ``own``, nearest first, ties to smaller ids."""
        found = Best(own, qs, k)
        # each query's own leaf first, which gives it a bound
        first = np.zeros(len(qs), np.int64)
        todo = [(0, np.arange(len(qs)))] if len(self.ids) else []
        while todo:
            node, some = todo.pop()
            a, b, vantage, near, far, near_max, far_min, _ = self.nodes[node]
            if vantage < 0:
                first[some] = node
                found.add(self, int(a), int(b), some)
                continue
            side = distances(qs[some], self.rows[int(vantage)]) * 2 <= near_max + far_min
            todo += [(int(n), own_side) for n, own_side in ((near, some[side]), (far, some[~side])) if len(own_side)]
        todo = [(0, np.arange(len(qs)), np.zeros(len(qs)))] if len(self.ids) else []
        while todo:
            node, some, bound = todo.pop()
            going = bound * factor <= found.d[some, -1] * (1 + SLACK)
            some, bound = some[going], bound[going]
            if not len(some):
                continue
            a, b, vantage, near, far, near_max, far_min, far_max = self.nodes[node]
            if vantage < 0:
                found.add(self, int(a), int(b), some[first[some] != node])
                continue
            d = distances(qs[some], self.rows[int(vantage)])
            todo.append((int(far), some, np.maximum(bound, np.maximum(far_min - d, d - far_max))))
            todo.append((int(near), some, np.maximum(bound, d - near_max)))
        at, rank = np.nonzero(np.isfinite(found.d))
        return at, found.ids[at, rank], found.d[at, rank]


class Best:
    """The best ``k`` so far of each query of a block, as arrays in order of distance and id."""

    def __init__(self, own: np.ndarray, qs: np.ndarray, k: int):
        self.own, self.qs, self.squares = own, qs, (qs * qs).sum(axis=1)
        self.d, self.ids = np.full((len(qs), k), np.inf), np.full((len(qs), k), np.iinfo(np.int64).max)
        self.seen = 0

    def add(self, tree: Tree, a: int, b: int, some: np.ndarray) -> None:
        """Meet the rows of a leaf with the queries ``some``."""
        points = tree.points[a:b]
        rows, ids, k = tree.rows[points], tree.ids[points], self.d.shape[1]
        self.seen += len(points) * len(some)
        for at in range(0, len(some), max(1, (1 << 20) // max(1, len(points)))):
            part = some[at : at + max(1, (1 << 20) // max(1, len(points)))]
            size = self.squares[part][:, None] + (rows * rows).sum(axis=1)
            near = size - 2 * (self.qs[part] @ rows.T) <= (self.d[part, -1] ** 2 * (1 + SLACK))[:, None] + size * SLACK
            near &= ids != self.own[part][:, None]
            q, r = np.nonzero(near)
            for i in range(0, len(q), PAIRS):
                self.merge(part[q[i : i + PAIRS]], ids[r[i : i + PAIRS]], distances(rows[r[i : i + PAIRS]], self.qs[part[q[i : i + PAIRS]]]), k)

    def merge(self, q: np.ndarray, ids: np.ndarray, d: np.ndarray, k: int) -> None:
        fit = d <= self.d[q, -1]
        q, ids, d = q[fit], ids[fit], d[fit]
        own = np.unique(q)
        q = np.concatenate([np.repeat(own, k), q])
        ids, d = np.concatenate([self.ids[own].ravel(), ids]), np.concatenate([self.d[own].ravel(), d])
        order = np.lexsort([ids, d, q])
        starts = np.searchsorted(q[order], own)
        kept = order[(starts[:, None] + np.arange(k)).ravel()]
        self.ids[own], self.d[own] = ids[kept].reshape(-1, k), d[kept].reshape(-1, k)


def counted(rows: DataFrame) -> DataFrame:
    """``rows`` (vec_id, v) with n, how many equal rows each stands for: 1, unless an id has very many rows."""
    if rows.groupBy("vec_id").count().where(F.col("count") > REPEATS).head(1):
        return rows.groupBy("vec_id", "v").agg(F.count("*").alias("n"))
    return rows.withColumn("n", F.lit(1).cast("long"))


def index(rows: DataFrame, shards: int, k: int = K) -> DataFrame:
    """dim, shard, ids, vectors, nodes, points: a packed tree per shard and dimension, written once.

    ``rows``: vec_id, v, n; of n equal rows no search for ``k`` needs more than k.
    """

    def build(pdf):
        import pandas as pd

        tree = Tree(pdf["vec_id"].to_numpy(np.int64), np.stack(pdf["v"].to_numpy()).astype(np.float64))
        return pd.DataFrame([(int(pdf["dim"].iloc[0]), int(pdf["shard"].iloc[0]), *tree.pack())], columns=["dim", "shard", "ids", "vectors", "nodes", "points"])

    dealt = rows.withColumn("dim", F.size("v")).withColumn("shard", F.pmod(F.xxhash64(F.lit("shard"), "vec_id", "v"), F.lit(shards)).cast("int"))
    dealt = dealt.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least(F.col("n"), F.lit(k)).cast("int")))).select("vec_id", "v", "dim", "shard")
    trees = dealt.groupBy("dim", "shard").applyInPandas(build, "dim int, shard int, ids binary, vectors binary, nodes binary, points binary")
    return written(trees, "trees")


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K, factor: float = 1.0, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of ``queries`` its k nearest rows of ``vectors`` of another id."""
    rows = counted(usable(vectors))
    asked = counted(usable(queries))
    shards = max(1, ceil(rows.count() / shard_rows))
    trees = index(rows, shards, k)
    blocks = max(1, ceil(asked.count() / BLOCK_QUERIES))

    def pack(pdf):
        import pandas as pd

        pdf = pdf.iloc[np.lexsort([pdf["vec_id"].to_numpy()])]
        q = np.stack(pdf["v"].to_numpy()).astype(np.float64)
        row = int(pdf["dim"].iloc[0]), int(pdf["block"].iloc[0]), pdf["vec_id"].to_numpy(np.int64).tobytes(), pdf["n"].to_numpy(np.int64).tobytes(), q.tobytes()
        return pd.DataFrame([row], columns=["qdim", "qblock", "qids", "qns", "qs"])

    dealt = asked.withColumn("dim", F.size("v")).withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "vec_id", "v"), F.lit(blocks)))
    # written once: a block's order numbers its queries for all shards
    packed = written(dealt.groupBy("dim", "block").applyInPandas(pack, "qdim int, qblock int, qids binary, qns binary, qs binary"), "queries")
    # a row per block and shard, each of bounded size: the stated queries against all rows, in blocks
    tasks = packed.withColumn("qshard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    met = tasks.join(trees, (F.col("qshard") == F.col("shard")) & (F.col("qdim") == F.col("dim")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tree = None, None
        for batch in slices(batches, "vectors", 1):
            dim, block, qids, qns, qs, *packs = (c[0].as_py() for c in batch.columns)
            if packs[0] != held:
                held, tree = packs[0], Tree.unpack(*packs)
            qids = np.frombuffer(qids, np.int64)
            at, ids, d = tree.search(qids, np.frombuffer(qs, np.float64).reshape(len(qids), -1), k, factor)
            columns = [np.full(len(at), dim, np.int32), np.full(len(at), block, np.int32), at.astype(np.int32), qids[at], np.frombuffer(qns, np.int64)[at], ids, d]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["dim", "block", "at", "query_id", "n", "vec_id", "score"])

    # a tree is shuffled once, to the task that all blocks for its shard come to
    met = met.select("dim", "qblock", "qids", "qns", "qs", "ids", "vectors", "nodes", "points")
    near = met.mapInArrow(run, "dim int, block int, at int, query_id long, n long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("dim", "block", "at").orderBy("score", "vec_id"))
    near = near.withColumn("rank", rank).where(F.col("rank") <= k)
    return near.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))).select("query_id", "rank", "vec_id", "score")


#: The same in DuckDB by brute force; squares are added in the order of the components.
SQL = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
u AS (SELECT *, row_number() OVER () AS own FROM e WHERE vec_id IS NOT NULL AND v IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
d AS (SELECT q.vec_id AS query_id, q.own, c.vec_id,
        sqrt(list_reduce(list_transform(list_zip(q.v, c.v), lambda p: (p[2] - p[1]) * (p[2] - p[1])), lambda x, y: x + y)) AS score
      FROM u q JOIN u c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)),
r AS (SELECT *, row_number() OVER (PARTITION BY own ORDER BY score, vec_id)::INTEGER AS rank FROM d)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
