"""Fingerprints, trie joins, components, phrase fingerprints and nearest neighbours against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

from linkloom.llm import lzprint, simhash, vptree


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, budget):
    up = list(range(len(prints)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= budget:
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(prints))]


@pytest.mark.parametrize("text", [None, "", " \n", "One", "ONE two x three", "É a b c d e f a b c d", "a " * 70000])
def test_fingerprint(text):
    assert simhash.fingerprint(None if text is None else text.encode()) == plain_fingerprint(text)


def near_prints(seed, n=400):
    """Random fingerprints, chains of near ones, and a dense group."""
    rng = random.Random(seed)
    out = [rng.getrandbits(64) for _ in range(n)]
    for _ in range(n):
        x = rng.choice(out)
        for b in rng.sample(range(64), rng.randint(0, 6)):
            x ^= 1 << b
        out.append(x)
    centre = rng.getrandbits(64)
    return sorted({*out, 0, (1 << 64) - 1, *(centre ^ (1 << a) ^ (1 << b) for a in range(16) for b in range(16))})


@pytest.mark.parametrize("hot", [200_000, 8])
def test_links_and_components(spark, hot):
    prints = near_prints(hot)
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in prints]
    edges = simhash.links(spark.createDataFrame(signed, "fp long"), 4, hot=hot)
    found = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    groups = {}
    for (s,), root in zip(signed, plain_components(prints, 4)):
        groups.setdefault(root, set()).add(s)
    mine = {}
    for (s,) in signed:
        mine.setdefault(found.get(s, s), set()).add(s)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, groups.values()))


def test_components_of_a_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 2000 + i) for i in range(500)] + [(7, 7)]
    found = {r["node"]: r["root"] for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(1, 301)} | {2000 + i: 1000 for i in range(500)}


def test_near_duplicates(spark):
    words = "the quick brown fox jumps over a lazy dog and runs far away from here to there again with some more".split()
    rng = random.Random(3)
    long = " ".join(rng.choice(words) + str(rng.randint(0, 99)) for _ in range(400))
    texts = [long, long, long + " end", None, "", "short", "SHORT", long.upper(), "another text entirely of its own kind", long]
    rows = [(i + 10, t, 0, 0) for i, t in enumerate(texts)] + [(10, long, 0, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int, component_id int")
    found = sorted((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in simhash.near_duplicates(docs).collect())
    prints = [plain_fingerprint(t) for _, t, *_ in rows]
    ids = [r[0] for r in rows]
    roots = plain_components(prints, 4)
    lowest = {r: min(ids[i] for i in range(len(ids)) if roots[i] == r) for r in set(roots)}
    assert found == sorted((i, p, lowest[r]) for i, p, r in zip(ids, prints, roots))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, r in zip(ids, roots) if lowest[r] == i)
    assert simhash.near_duplicates(docs.limit(0)).collect() == []
    with_null = docs.unionByName(spark.createDataFrame([(None, long, 0, 0)], docs.schema))
    assert simhash.keep_one(with_null).where("doc_id IS NULL").count() == 1


@pytest.mark.parametrize(("texts", "partitions"), [([], None), (["one document"], None), (["same text", "same text"], 200), ([None, None, None], None)])
def test_near_duplicates_small_tables(spark, texts, partitions):
    """Few rows, over more partitions than rows."""
    docs = spark.createDataFrame([(i + 5, t) for i, t in enumerate(texts)], "doc_id long, text string")
    if partitions:
        docs = docs.repartition(partitions)
    roots = plain_components([plain_fingerprint(t) for t in texts], 4)
    expected = [(i + 5, plain_fingerprint(t), roots[i] + 5) for i, t in enumerate(texts)]
    assert sorted((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in simhash.near_duplicates(docs).collect()) == expected
    assert sorted(r["doc_id"] for r in simhash.keep_one(docs).collect()) == sorted({c for *_, c in expected})


def plain_phrases(text):
    known, start = set(), 0
    for end in range(1, len(text) + 1):
        if text[start:end] not in known:
            known.add(text[start:end])
            start = end
    return known


def test_phrases_are_lempel_ziv():
    rng = random.Random(5)
    for _ in range(50):
        text = "".join(rng.choice("abcé🎉 ") for _ in range(rng.randint(0, 300)))
        doc = lzprint.Document(1, text)
        assert len(np.unique(doc.print)) == min(lzprint.SIZE, len(plain_phrases(text)))
        other = "".join(rng.choice("abcé🎉 ") for _ in range(rng.randint(0, 300)))
        edited, print_ = doc.edited(other)
        assert edited == text[: len(text) - len(text) // 4] + other[: len(text) // 4]
        assert print_.tolist() == lzprint.Document(1, edited).print.tolist()
        a, b = plain_phrases(text), plain_phrases(other)
        like = lzprint.likeness(doc.print, lzprint.Document(2, other).print)
        if len(a | b) <= lzprint.SIZE and a | b:
            assert like == pytest.approx(len(a & b) / len(a | b))
        assert 0 <= like <= 1
    assert lzprint.likeness(lzprint.Document(1, "").print, lzprint.Document(2, "").print) == 1.0


@pytest.mark.parametrize("partitions", ["1", "4", "50"])
def test_compare_takes_the_next_document(spark, partitions):
    rng = random.Random(7)
    rows = [(rng.randint(-50, 10**6), "".join(rng.choice("abcd ") for _ in range(rng.randint(0, 200)))) for _ in range(60)]
    rows += [(7, None), (7, "twin"), (None, "no id"), (3, "x" * 20000)]
    rows += [(i, f"row {j} of an id or of none") for i in (7, None) for j in range(40)]
    docs = spark.createDataFrame([(i, t, True) for i, t in rows], "doc_id long, text string, __halo boolean")
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        found = lzprint.compare(docs).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, r[0] or 0, xxhash.xxh64_intdigest(r[1], 42) >> 1, r[1]))
    expected = []
    for (i, t), (_, after) in zip(order, order[1:] + order[:1]):
        cut = len(t) - len(t) // 4
        edited = t[:cut] + after[: len(t) // 4]
        p, e, n = (lzprint.Document(0, x).print for x in (t, edited, after))
        expected.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), lzprint.hexed(p), lzprint.hexed(e), lzprint.likeness(p, e), lzprint.likeness(p, n)))
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[3])
    assert sorted(map(tuple, found), key=key) == sorted(expected, key=key)


def test_compare_small_tables(spark):
    one = spark.createDataFrame([(1, "abab")], "doc_id long, text string")
    assert lzprint.compare(one).first()["near_next"] == 1.0
    assert lzprint.compare(one.limit(0)).collect() == []
    assert lzprint.compare(spark.createDataFrame([(None, "a"), (None, "b")], "doc_id long, text string")).count() == 2


def plain_nearest(rows, k):
    """A list of neighbours for each row that is a query, by a plain loop."""
    use = [(i, np.array(v, float)) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v) and i is not None]
    out = []
    for q, v in use:
        if q % 100 == 0:
            near = sorted((float(np.sqrt(np.add.accumulate((w - v) ** 2)[-1])), i) for i, w in use if i != q and len(w) == len(v))[:k]
            out += [(q, r + 1, i, s) for r, (s, i) in enumerate(near)]
    return out


@pytest.mark.parametrize("shard_rows", [8192, 60])
def test_nearest_is_exact_at_factor_one(spark, shard_rows):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(500)]
    rows += [(1000 + i, rows[100][1]) for i in range(200)]  # one very common vector
    rows += [(2000, None), (2100, []), (2200, [0.0] * 8), (2300, [float("nan")] * 8), (2400, [None] * 8), (2500, [1.0, 2.0]), (2600, [1.0, 2.5]), (2700, [float("inf")] * 8)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int")
    found = vptree.nearest(df, df.where("vec_id % 100 = 0"), shard_rows=shard_rows).collect()
    assert sorted(map(tuple, found)) == sorted(plain_nearest(rows, 10))
    assert vptree.nearest(df.limit(0), df).collect() == []
    assert vptree.nearest(df, df.limit(0)).collect() == []


def test_factor_trades_recall(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(20, 16)) * 4
    rows = [(i, (centres[i % 20] + rng.normal(size=16)).astype(np.float32).tolist()) for i in range(2000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    near = {r[:3:2] for r in map(tuple, vptree.nearest(df, df.where("vec_id % 100 = 0"), factor=1.3, shard_rows=500).select("query_id", "rank", "vec_id").collect())}
    exact = {(q, i) for q, _, i, _ in plain_nearest(rows, 10)}
    assert len(near & exact) / len(exact) >= 0.9


@pytest.mark.parametrize("repeats", [1000, 3])
def test_repeated_rows_are_queries_each(spark, monkeypatch, repeats):
    """An id in two rows, and an id in very many equal rows: each row asks and answers for itself."""
    monkeypatch.setattr(vptree, "REPEATS", repeats)
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(1, 130)]
    rows += [(100, rows[99][1]), (100, rng.normal(size=4).tolist())] + [(200, rows[0][1])] * 40 + [(7, rows[6][1])] * 20
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = vptree.nearest(df, df.where("vec_id % 100 = 0"), shard_rows=30).collect()
    assert sorted(map(tuple, found)) == sorted(plain_nearest(rows, 10))


def test_tree_prunes(monkeypatch):
    """On clustered vectors a query meets few rows and still finds the nearest."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(50, 4)) * 50
    rows = np.concatenate([c + rng.normal(size=(100, 4)) for c in centres])
    tree, made = vptree.Tree(np.arange(len(rows)), rows, leaf=16), []
    plain = vptree.Best.__init__

    def noted(self, *args):
        plain(self, *args)
        made.append(self)

    monkeypatch.setattr(vptree.Best, "__init__", noted)
    at, ids, d = tree.search(np.arange(0, 5000, 100), rows[::100], 10)
    assert made[0].seen < 50 * len(rows) / 8
    expected = [(q, r, i) for q, v in enumerate(rows[::100]) for r, (_, i) in enumerate(sorted((x, i) for i, x in enumerate(vptree.distances(rows, v)) if i != 100 * q)[:10])]
    assert list(zip(at.tolist(), [k % 10 for k in range(len(at))], ids.tolist())) == expected
