"""SimHash near-duplicates: 64-bit fingerprints, a binary-trie self-join and connected components.

Two fingerprints link when they differ in at most ``budget`` bits. Of budget + 1 segments of the 64 bits
one at least must then be equal, so every fingerprint is rotated budget + 1 times, with each segment in
front once, and only fingerprints with an equal front share a trie. In a trie, nodes are taken in pairs;
a pair's differing path bits add up, and the pair is dropped once they exceed the budget. A front that
many fingerprints share is cut into pairs of deeper trie nodes, dealt out as tasks of their own.

Inside a task only a spanning forest of the links is kept (connectivity is what counts), so a dense group
of n near copies leaves n - 1 rows, not n * n. Copies meet as one fingerprint before the join.

Edge cases: null or blank text has fingerprint zero, linked like any other; null doc_ids stay as rows and
never name a component unless all its ids are null; repeated rows stay; an empty table gives no rows, and
partitions without rows give none; extra columns are not read (``keep_one`` keeps them).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import drop, scratch, slices, written

BUDGET = 4
SHINGLE = 4
SEED = 42
BITS = 64


def fingerprint(text: bytes | None, width: int = SHINGLE) -> int:
    """The fingerprint of one text: a bit is 1 if set in over half the shingles' hashes."""
    words = (text or b"").lower().split()  # on bytes: A-Z only, and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    h, k = xxhash.xxh64_intdigest, min(width, len(words))
    ones, n = np.zeros(BITS, np.int64), len(words) - k + 1
    for at in range(0, n, 1 << 15):
        to = min(n, at + (1 << 15))
        cuts = zip(starts[at:to].tolist(), ends[at + k - 1 : to + k - 1].tolist())
        hashes = np.array([h(joined[a:b], SEED) for a, b in cuts], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """doc_id, fp (the fingerprint's 64 bits as a long), one row per row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            found = np.array([fingerprint(t, width) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, fp long")


# --- the trie self-join -----------------------------------------------------------------------------


def segments(budget: int) -> list[tuple[int, int]]:
    """(left rotation, width) of each front segment."""
    n = budget + 1
    cuts = [BITS * i // n for i in range(n + 1)]
    return [(cuts[i], cuts[i + 1] - cuts[i]) for i in range(n)]


def rotated(x: np.ndarray, by: int) -> np.ndarray:
    by %= BITS
    return x if not by else (x << np.uint64(by)) | (x >> np.uint64(BITS - by))


class Forest:
    """Union-find over positions, by arrays; the root of a tree is its smallest position."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def roots(self, x: np.ndarray) -> np.ndarray:
        x = self.up[x]
        while (y := self.up[x]).tobytes() != x.tobytes():
            x = y
        return x

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.roots(a), self.roots(b)
            apart = a != b
            a, b = np.minimum(a, b)[apart], np.maximum(a, b)[apart]
            np.minimum.at(self.up, b, a)


def crossed(la, ha, lb, hb) -> tuple[np.ndarray, np.ndarray]:
    """All (i, j) with i in [la, ha) and j in [lb, hb), range pair by range pair."""
    na, nb = ha - la, hb - lb
    n = na * nb
    pair = np.repeat(np.arange(len(n)), n)
    k = np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n)
    return la[pair] + k // nb[pair], lb[pair] + k % nb[pair]


def trie_links(x: np.ndarray, la, ha, lb, hb, cost, depth: int, budget: int, forest: Forest, few: int = 64) -> None:
    """Link in ``forest`` all positions of the sorted ``x`` that differ in at most ``budget`` bits.

    The starting node pairs are position ranges [la, ha) and [lb, hb) at one ``depth``, whose paths so far
    differ in ``cost`` bits. Pairs of small nodes are compared outright; the rest go one bit deeper.
    """
    stack = [(depth, *(np.asarray(v, np.int64) for v in (la, ha, lb, hb, cost)))]
    while stack:
        depth, la, ha, lb, hb, cost = stack.pop()
        if len(la) > 100_000:  # bounded memory: part of the frontier waits on the stack
            half = len(la) // 2
            stack += [(depth, la[s], ha[s], lb[s], hb[s], cost[s]) for s in (slice(half), slice(half, None))]
            continue
        area = (ha - la) * (hb - lb)
        sure = cost + BITS - depth <= budget  # whatever the bits that remain
        for one in np.flatnonzero(sure & (area > 1)):
            own = np.concatenate([np.arange(la[one], ha[one]), np.arange(lb[one], hb[one])])
            forest.link(np.full(len(own), own[0]), own)
        small = ~(sure & (area > 1)) & (area <= few)
        if small.any():
            i, j = crossed(la[small], ha[small], lb[small], hb[small])
            near = (i < j) & (np.bitwise_count(x[i] ^ x[j]) <= budget)
            forest.link(i[near], j[near])
        deep = ~sure & (area > few)
        la, ha, lb, hb, cost = la[deep], ha[deep], lb[deep], hb[deep], cost[deep]
        if not len(la):
            continue
        bit = np.uint64(1 << (BITS - 1 - depth))
        below = np.uint64(int(bit) - 1)

        def middle(lo):
            """Where the node that starts at position lo turns from 0 to 1 at this bit."""
            return np.searchsorted(x, (x[lo] & ~(bit | below)) | bit)

        ma, mb = np.clip(middle(la), la, ha), np.clip(middle(lb), lb, hb)
        same = la == lb
        kids = [(la, ma, lb, mb, cost), (ma, ha, mb, hb, cost), (la, ma, mb, hb, cost + 1)]
        kids.append(tuple(v[~same] for v in (ma, ha, lb, mb, cost + 1)))
        nxt = [np.concatenate([k[c] for k in kids]) for c in range(5)]
        keep = (nxt[0] < nxt[1]) & (nxt[2] < nxt[3]) & (nxt[4] <= budget)
        lone = (nxt[0] == nxt[2]) & (nxt[1] - nxt[0] == 1)  # one position with itself
        keep &= ~lone
        if keep.any():
            stack.append((depth + 1, *(v[keep] for v in nxt)))


def links(fps: DataFrame, budget: int = BUDGET, hot: int = 200_000, per_task: int = 2_000_000) -> DataFrame:
    """a, b: links between the distinct fingerprints ``fps`` (column fp) whose transitive closure is that of all links.

    A front shared by more than ``hot`` fingerprints is cut at as many further bits as bring its nodes under
    that size; each pair of nodes within the budget is a task of its own.
    """
    spark, turns = fps.sparkSession, segments(budget)
    front = F.array(*[
        F.struct(
            F.lit(r).alias("rot"),
            F.shiftrightunsigned(F.col("fp") if not by else F.shiftleft("fp", by).bitwiseOR(F.shiftrightunsigned("fp", BITS - by)), BITS - width).cast("int").alias("seg"),
        )
        for r, (by, width) in enumerate(turns)
    ])
    rows = fps.select("fp", F.explode(front).alias("f")).select("fp", "f.rot", "f.seg")
    sizes = written(rows.groupBy("rot", "seg").count(), "fronts")  # at most (budget + 1) * 2**13 rows
    total = sizes.agg(F.sum("count")).first()[0] or 0
    cut = F.ceil(F.log2(F.col("count") / hot)).cast("int")
    big = sizes.where(F.col("count") > hot).select("rot", "seg", F.least(cut, F.lit(14)).alias("q"))
    rows = rows.join(F.broadcast(big), ["rot", "seg"], "left").withColumn("q", F.coalesce("q", F.lit(0)))
    by, width = (F.element_at(F.array(*[F.lit(t[i]) for t in turns]), F.col("rot") + 1) for i in (0, 1))
    rows = rows.withColumn("turn", by).withColumn("width", width)
    rows = rows.withColumn("x", F.expr("shiftleft(fp, turn) | shiftrightunsigned(fp, (64 - turn) & 63)"))
    node = F.expr("if(q = 0, 0L, shiftrightunsigned(shiftleft(x, width), 64 - q))")
    pairs = F.expr(f"if(q = 0, array(0L), filter(sequence(0L, shiftleft(1L, q) - 1), o -> bit_count(node ^ o) <= {budget}))")
    rows = rows.withColumn("node", node).withColumn("other", F.explode(pairs))
    rows = rows.select("rot", "seg", "q", F.least("node", "other").alias("na"), F.greatest("node", "other").alias("nb"), "x")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // per_task + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:  # an empty partition
            return
        rot, seg, q, na, nb, x = (c.to_numpy() for c in pa.Table.from_batches(held).columns)
        x = x.view(np.uint64)
        for r in np.unique(rot):
            by, width = turns[r]
            plain = np.sort(x[(rot == r) & (q == 0)])
            if len(plain):
                starts = np.flatnonzero(np.concatenate([[True], plain[1:] >> np.uint64(BITS - width) != plain[:-1] >> np.uint64(BITS - width)]))
                ends = np.append(starts[1:], len(plain))
                forest = Forest(len(plain))
                more = ends - starts > 1
                s, e = starts[more], ends[more]
                trie_links(plain, s, e, s, e, np.zeros(len(s)), width, budget, forest)
                yield from forest_rows(plain, forest, by)
            for key in sorted(set(zip(*(v[(rot == r) & (q > 0)].tolist() for v in (seg, q, na, nb))))):
                own = np.sort(x[(rot == r) & (seg == key[0]) & (na == key[2]) & (nb == key[3])])
                depth, forest = width + key[1], Forest(len(own))
                if key[2] == key[3]:
                    trie_links(own, [0], [len(own)], [0], [len(own)], [0], depth, budget, forest)
                else:
                    mid = int(np.searchsorted(own, own[-1] >> np.uint64(BITS - depth) << np.uint64(BITS - depth)))
                    if mid:
                        trie_links(own, [0], [mid], [mid], [len(own)], [(key[2] ^ key[3]).bit_count()], depth, budget, forest)
                yield from forest_rows(own, forest, by)

    rows = rows.repartition(parts, "rot", "seg", "na", "nb")
    return rows.select("rot", "seg", "q", "na", "nb", "x").mapInArrow(run, "a long, b long")


def forest_rows(x: np.ndarray, forest: Forest, by: int) -> Iterator[pa.RecordBatch]:
    """Each position that isn't a root, with its root, as fingerprints turned back."""
    at = np.arange(len(x))
    up = forest.roots(at)
    own = at[up != at]
    back = rotated(x, BITS - by)
    if len(own):
        yield pa.RecordBatch.from_arrays([pa.array(v.view(np.int64)) for v in (back[own], back[up[own]])], ["a", "b"])


# --- connected components ---------------------------------------------------------------------------


def components(edges: DataFrame, most: int = 60) -> DataFrame:
    """node, root (the smallest node that it reaches) of every node in ``edges`` (a, b): large and small stars in turn.

    Minimums are partial aggregates and every join is a plain one of two written tables, so that a node with
    very many neighbours is split by the engine and never meets in one task.
    """

    def star(e: DataFrame, name: str, large: bool) -> DataFrame:
        nb = e.select(F.col("a").alias("u"), F.col("b").alias("v"))
        if large:
            nb = nb.unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = nb.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        low = written(low, f"{name}-low")
        out = nb.join(low, "u")
        if large:
            out = out.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            out = out.select(F.explode(F.array(F.struct(F.col("u").alias("a"), F.col("m").alias("b")), F.struct(F.col("v").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        return written(out.where("a <> b").distinct(), name)

    def down(e: DataFrame) -> DataFrame:
        return e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    spark = edges.sparkSession
    edges = written(down(edges).where("a <> b").distinct(), "links")
    was = state(edges)
    if not was[0]:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    for i in range(most):
        with scratch(spark) as keep:  # what the round has written goes, but for its outcome
            past, edges = edges, keep(star(star(edges, f"large{i}", True), f"small{i}", False))
        drop(past)
        now = state(edges)
        if now == was:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        was = now
    raise RuntimeError(f"components did not settle in {most} rounds")


def near_duplicates(docs: DataFrame, budget: int = BUDGET, width: int = SHINGLE) -> DataFrame:
    """doc_id, fp, component_id (the smallest doc_id reachable over links), one row per row of ``docs``."""
    with scratch(docs.sparkSession) as keep:
        prints = keep(written(fingerprints(docs, width), "fingerprints"))
        first = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
        roots = components(links(first.select("fp"), budget))
        classes = first.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
        classes = written(classes.select("fp", F.coalesce("root", "fp").alias("root"), "first"), "rooted")
        lowest = written(classes.groupBy("root").agg(F.min("first").alias("component_id")), "lowest")
        named = keep(written(classes.join(lowest, "root").select("fp", "component_id"), "named"))
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, budget: int = BUDGET, width: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` without those whose component holds a smaller doc_id.

    A doc_id names one document: repeated rows of it stay together, and rows without an id stay.
    """
    gone = near_duplicates(docs, budget, width).where("doc_id <> component_id").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs["doc_id"] == F.col("__gone"), "left_anti")
