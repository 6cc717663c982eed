"""Mixing, chat, archives, languages, licenses and the pipeline."""

import hashlib
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from linkloom.llm import chat, langid, license_scan, mixing, queries, simhash, warc
from linkloom.llm.files import put


def against_duckdb(spark, tmp_path, name, tables):
    """A query's rows over small tables, in Spark and in DuckDB."""
    con = duckdb.connect()
    for table, df in tables.items():
        df.write.mode("overwrite").parquet(f"{tmp_path}/{table}.parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    df = queries.queries()[name](spark, str(tmp_path))
    mine = sorted((repr(tuple(r[c] for c in sorted(df.columns))) for r in df.collect()))
    rel = con.execute(queries.oracle_sql()[name])
    names = [c[0] for c in rel.description]
    theirs = sorted(repr(tuple(r[names.index(c)] for c in sorted(df.columns))) for r in rel.fetchall())
    return mine, theirs


DOCS = "doc_id long, text string, source string, size int, __note string"


def documents(spark):
    rows = [(i, "word " * (i % 37 + 1), f"s{i % 3}", 1, "x") for i in range(400)]
    rows += [(1000 + i, "big " * 900, "hot", 1, "x") for i in range(150)]
    rows += [(2000, None, "s1", 1, "x"), (2001, "", "empty", 1, "x"), (2002, "one", None, 1, "x"), (2002, "one", None, 1, "x"), (None, "no id", "s2", 1, "x"), (2003, "a\x0bb c　d", "tiny", 1, None)]
    return spark.createDataFrame(rows, DOCS)


def test_mixture_is_the_sql(spark, tmp_path):
    mine, theirs = against_duckdb(spark, tmp_path, "op1_source_mixture", {"documents": documents(spark)})
    assert mine == theirs and len(mine) == 556


def test_mixture_targets_and_copies(spark, monkeypatch):
    docs = documents(spark)
    report = mixing.mixture_report(docs).toPandas()
    assert (report.taken <= 3 * report["size"]).all()
    by = report.drop_duplicates("source_size")
    assert (by.target <= 3 * by.source_size + 1e-6).all()
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    emitted = mixing.mix(docs)
    assert emitted.columns == docs.columns
    counts = {r["doc_id"]: r["n"] for r in emitted.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    expected = report.groupby("doc_id", dropna=False)["copies"].sum()
    assert {k: v for k, v in counts.items() if k is not None} == {int(k): v for k, v in expected.items() if k == k and v}
    assert mixing.mix(docs.limit(0)).collect() == [] and mixing.mixture_report(docs.limit(0)).collect() == []


def test_rows_without_ids_meet_the_target(spark):
    """Texts draw where ids are missing, so a source without ids comes near its target."""
    rows = [(None, f"text {i} " * (i % 5 + 1), "none") for i in range(3000)] + [(i, "word " * 8, "some") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    report = mixing.mixture_report(docs).toPandas()
    for _, own in report.groupby(report.doc_id.isna()):
        assert own.taken.sum() == pytest.approx(own.target.iloc[0], rel=0.05)
    again = mixing.mixture_report(docs).toPandas()
    assert sorted(report.fillna(-1).itertuples(index=False)) == sorted(again.fillna(-1).itertuples(index=False))


def test_plan_shares_the_excess(spark):
    sizes = spark.createDataFrame([("a", 1), ("b", 1000), ("c", 10), (None, 0)], "source string, size long")
    found = {r["__mix_source"]: r["__mix_target"] for r in mixing.plan(sizes).collect()}
    # a and c stop at three times their size; b takes what is left
    assert found == {"a": 3.0, "c": 30.0, "b": pytest.approx(978.0), None: 0.0}


CHAT = "conv_id long, turn long, role string, text string, node int"


def test_chat_is_the_sql(spark, tmp_path):
    rows = [(c, t, ("user", "assistant")[t % 2], f"turn {t} of {c} \\ # < é🎉", 1) for c in range(30) for t in range(c % 7 + 1)]
    rows += [(50, 0, "system", None, 1), (50, 0, "user", "tie", 1), (50, 0, "user", "tie", 1), (51, 3, "assistant", "### user: x </turn>\n", 1), (52, 0, "assistant", "", 1), (53, 0, "a:b\n", "odd role", 1)]
    rows += [(60, t, "assistant", f"{t}", 1) for t in range(300)]
    mine, theirs = against_duckdb(spark, tmp_path, "op2_reply_trees", {"conversations": spark.createDataFrame(rows, CHAT)})
    assert mine == theirs


def test_chat_nulls_and_empty(spark):
    rows = spark.createDataFrame([(1, None, None, None), (None, 1, "user", "lost")], "conv_id long, turn long, role string, text string")
    found = chat.read_back(chat.conversations_formatted(rows))
    assert sorted((r["conv_id"] is None, r["n_turns"]) for r in found.collect()) == [(False, 1), (True, 1)]
    assert chat.conversations_formatted(rows.limit(0)).collect() == []


def tree_paths(nodes):
    """Root-to-leaf paths and their scores, by walking."""
    at = {n: (p, s) for n, p, s in nodes}
    parents = {p for _, p, _ in nodes if p in at}
    out = []
    for n in at:
        if n in parents:
            continue
        path, score, i = [], 0.0, n
        while i is not None and i in at and i not in path:
            path.append(i)
            score += at[i][1] or 0.0
            i = at[i][0]
        if i is None or i not in at:
            out.append((score, n, path[::-1]))
    return [p for _, _, p in sorted(out, key=lambda x: (-x[0], x[1]))]


def test_reply_trees(spark):
    trees = {
        1: [(1, None, 1.0), (2, 1, 5.0), (3, 1, 2.0), (4, 3, 9.0), (5, 2, 1.0), (6, 2, 1.0)],
        2: [(1, None, 0.0)],
        3: [(1, 99, 1.0), (2, 1, None)],  # an unknown parent makes a root
        4: [(1, 2, 1.0), (2, 1, 1.0), (3, None, 1.0)],  # a cycle
        5: [(1, None, 0.0)] + [(i, i - 1, 1.0) for i in range(2, 70)] + [(100 + i, 35, 0.5) for i in range(20)],
    }
    rows = [(t, n, p, s, "user" if n % 2 else "assistant", f"{t}/{n}") for t, nodes in trees.items() for n, p, s in nodes]
    nodes = spark.createDataFrame(rows, "tree long, node long, parent long, score double, role string, text string")
    for top in (None, 2):
        found = {}
        for r in chat.paths(nodes, top).collect():
            found.setdefault((r["tree"], r["branch"]), []).append((r["depth"], r["node"]))
        mine = {k: [n for _, n in sorted(v)] for k, v in found.items()}
        assert mine == {(t, i + 1): p for t, ns in trees.items() for i, p in enumerate(tree_paths(ns)) if top is None or i < top}
    said = {(r["tree"], r["branch"]): chat.turns(r["formatted"]) for r in chat.formatted(nodes, 1).collect()}
    assert [x for _, x in said[1, 1]] == ["1/1", "1/3", "1/4"]


def test_large_branched_trees(spark):
    """Some thousand turns in random trees with equal and null scores, and one long text, against the walk."""
    import random

    rng = random.Random(11)
    rows, trees = [], {}
    for t in range(60):
        n = rng.randint(1, 120)
        trees[t] = [(i, rng.randint(max(0, i - 6), i - 1) if i else None, rng.choice([None, 0.5, 1.0, 2.0])) for i in range(n)]
        rows += [(t, i, p, s, rng.choice(["user", "assistant"]), f"{t}/{i} \\ # </turn>" + "y" * (3_000_000 if (t, i) == (7, 0) else 0)) for i, p, s in trees[t]]
    assert len(rows) > 2000
    nodes = spark.createDataFrame(rows, "tree long, node long, parent long, score double, role string, text string")
    said = {(r[0], r[1]): r[4:] for r in rows}
    found = {(r["tree"], r["branch"]): r for r in chat.formatted(nodes, 3).collect()}
    expected = {(t, i + 1): p for t, ns in trees.items() for i, p in enumerate(tree_paths(ns)[:3])}
    assert set(found) == set(expected)
    for key, path in expected.items():
        r = found[key]
        assert chat.turns(r["formatted"]) == [said[key[0], n] for n in path]
        assert [chat.unescape(r["formatted"][a:b]) for a, b in zip(r["starts"], r["ends"])] == [said[key[0], n][1] for n in path if said[key[0], n][0] == "assistant"]


def test_template_escapes_reversibly():
    for text in ("", "\\", "### a: b </turn>\n", "\\### Assistant: </turn> ok", "####", "<\\<", "line\nline"):
        assert chat.unescape(chat.escape(text)) == text
        assert "###" not in chat.escape(text) and "</turn>" not in chat.escape(text)
    with pytest.raises(ValueError):
        chat.turns("### user: no end")


PAGES = "page_id long, url string, html string, digest string, first int"


def test_archives_are_the_sql(spark, tmp_path):
    page = "<html>" + "é content " * 30
    rows = [(i, f"http://h/{i}", page + str(i % 7), None, 1) for i in range(200)]
    rows += [(300, None, None, None, 1), (301, "a b\r\nc", "", None, 1), (302, "u", "short", None, 1), (303, "u", "short", None, 1), (None, "u", "none " * 40, None, 1), (400, "u", "x" * 3_000_000, None, 1), (401, "v", "x" * 3_000_000, None, 1)]
    mine, theirs = against_duckdb(spark, tmp_path, "op3_warc_dictionary", {"pages": spark.createDataFrame(rows, PAGES)})
    assert mine == theirs


def test_revisits_across_archives(spark, monkeypatch):
    """Some MB of pages, a third of them one page, in many small archives: each revisit names the smallest page_id of its payload."""
    monkeypatch.setattr(warc.write_archives, "__defaults__", (warc.LEAST, 100_000))
    body = lambda i: f"<html>{'common ' * 800 if i % 3 == 0 else f'page {i % 700} ' * 60}</html>"
    pages = spark.createDataFrame([(i, f"http://h/{i}", body(i)) for i in range(2100)], "page_id long, url string, html string").repartition(7)
    first = {}
    for i in range(2100):
        first.setdefault(body(i), i)
    expected = [(i, len(body(i)), hashlib.sha256(body(i).encode()).hexdigest(), "response" if first[body(i)] == i else "revisit", None if first[body(i)] == i else first[body(i)]) for i in range(2100)]
    found = warc.archived(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, found)) == expected and sum(r["record_type"] == "revisit" for r in found) > 1000


def test_archive_frames(spark, tmp_path):
    made = [warc.record(i, f"http://h/{i}", b"<p>body %d</p>" % i * 20, hashlib.sha256(b"%d" % i).hexdigest(), None if i % 2 else 1) for i in range(50)]
    content = warc.archive(made)
    assert content[:4] == (0x184D2A5D).to_bytes(4, "little")
    found = list(warc.records(content))
    assert [f["Page-ID"] for f, _ in found] == [str(i) for i in range(50)]
    assert all(len(b) == int(f["Content-Length"]) for f, b in found)
    with pytest.raises(ValueError):
        list(warc.records(b"nothing"))
    assert list(warc.records(warc.archive(made[:1])))[0][1] == list(warc.records(content))[0][1]
    assert warc.archived(spark.createDataFrame([], PAGES)).collect() == []
    put(f"file://{tmp_path}/new", "a", b"1")
    assert (tmp_path / "new" / "a").read_bytes() == b"1"


WORDS = {
    "en": "the of and to in is that for it was on are with as his they be at one have this from".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par plus pas au sur ne se".split(),
}


def sentences(lang, i, n=60):
    return " ".join(WORDS[lang][(i * 7 + k * k + k) % len(WORDS[lang])] for k in range(n))


def test_languages(spark):
    rows = [(i, sentences(lang, i), lang) for i, lang in enumerate(list(WORDS) * 60)]
    rows += [(900, None, "en"), (901, "12 !?", "fr"), (902, "", None), (903, sentences("de", 5), None), (903, sentences("de", 5), None), (None, sentences("fr", 2), "fr"), (904, (sentences("en", 1, 40) + " " + sentences("fr", 1, 40)), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit(1))
    model = langid.fit(docs.where(~langid.held_out(F.col("doc_id"))))
    assert model[0] == ["de", "en", "fr"]
    found = langid.identify(docs, model).collect()
    assert len(found) == len(rows)
    by = {r["doc_id"]: r for r in found}
    truth = {i: lang for i, _, lang in rows if i is not None and i < 900}
    assert sum(by[i]["lang_pred"] == lang for i, lang in truth.items()) == len(truth)
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 for i in (900, 901, 902))
    assert by[903]["lang_pred"] == "de" and by[None]["lang_pred"] == "fr"
    assert sorted(by[904]["languages"]) == ["en", "fr"] and 0.3 < by[904]["score"] < 0.7
    kept = langid.known_language(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 3
    assert langid.identify(docs.limit(0), model).collect() == []
    nothing = langid.fit(docs.limit(0))
    assert {r["lang_pred"] for r in langid.identify(docs, nothing).collect()} == {"und"}


def test_texts_in_no_learned_language_go(spark):
    """Also where only one or two languages are learned, and from short texts; texts in several learned ones stay."""
    foreign = ["Привет, мир. Сегодня хорошая погода", "Привет", "สวัสดีชาวโลก", "今天天气很好", "hyvää huomenta ystävä", "huomenta", "xkq zzvp qwrtk jjhx"]
    foreign.append(f"{sentences('de', 1, 20)} {' '.join(['погода сегодня хорошая'] * 20)}")
    mostly = f"{sentences('de', 1, 60)} {' '.join(['погода'] * 20)}"
    for langs in (["de"], ["de", "en"], ["de", "en", "fr"]):
        rows = [(i, sentences(lang, i // len(langs)), lang) for i, lang in enumerate(langs * 40)]
        mixed = " ".join(sentences(lang, 3, 40) for lang in langs)
        docs = spark.createDataFrame([*rows, (1000, mixed, None), (1001, mostly, None), (1002, "der", None)] + [(2000 + i, t, None) for i, t in enumerate(foreign)], "doc_id long, text string, lang string")
        by = {r["doc_id"]: r for r in langid.identify(docs, langid.fit(docs)).collect()}
        assert all(by[i]["lang_pred"] == lang for i, _, lang in rows)
        assert all(by[2000 + i]["lang_pred"] == "und" and by[2000 + i]["score"] == 0 and by[2000 + i]["languages"] == [] for i in range(len(foreign)))
        assert sorted(by[1000]["languages"]) == langs and by[1000]["score"] < 1 / len(langs) + 0.1
        assert {r["doc_id"] for r in langid.known_language(docs).collect()} == {i for i, _, _ in rows} | {1000, 1001, 1002}


def test_every_language_is_learned(spark):
    """Each of 300 languages has a script of its own: eight code points of the Hangul block."""
    rows = [(i, " ".join(chr(0xAC00 + 8 * i + (k * k + k // 3) % 8) * 2 for k in range(40)), f"l{i:03}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs)
    assert model[0] == [r[2] for r in rows]
    found = {r["doc_id"]: r["lang_pred"] for r in langid.identify(docs, model).collect()}
    assert found == {i: lang for i, _, lang in rows}


def plain_mixture(text, table):
    """Words, rounds of expectation-maximisation and the choice of languages, one number at a time."""
    import math

    words, word = [], []
    for c in (text or "").lower() + "\n":
        if c.isalpha():
            word.append(ord(c))
        elif word:
            words.append(word)
            word = []
    n_langs = len(table[0]) - 1
    if not words:
        return [], [], 1.0
    logs = []
    for w in words:
        padded, total = [0, *w, 0], [0.0] * (n_langs + 1)
        for i in range(1, len(padded) - 1):
            h = (padded[i - 1] * 0x9E3779B1 + padded[i] * 0x85EBCA77 + padded[i + 1] * 0xC2B2AE3D) % 2**32
            h = (h ^ h >> 15) * 0x2C1B3C6D % 2**32
            total = [a + float(b) for a, b in zip(total, table[h >> 17])]
        logs.append(total)

    def rounds(share, rows, n):
        for _ in range(n):
            parts = [[p * math.exp(x - max(row)) for p, x in zip(share, row)] for row in rows]
            share = [sum(part[j] / sum(part) for part in parts) / len(rows) for j in range(len(share))]
        return share

    unknown = rounds([1 / (n_langs + 1)] * (n_langs + 1), logs, langid.ROUNDS)[-1]
    if sum(row[-1] - max(row[:-1]) for row in logs) <= langid.PENALTY * math.log((1 - unknown) * len(logs) + 1):
        unknown = 0.0
    rows = [row[:-1] for row in logs]
    share = rounds([1 / n_langs] * n_langs, rows, langid.ROUNDS)
    order = sorted(range(n_langs), key=lambda j: -share[j])
    best, value = None, -math.inf
    for size in range(1, n_langs + 1):
        if size > 1 and share[order[size - 1]] <= 0.01:
            break
        p = [share[j] if j in order[:size] else 0.0 for j in range(n_langs)]
        p = rounds([x / sum(p) for x in p], rows, langid.SET_ROUNDS if size > 1 else 0)
        fit = sum(math.log(sum(a * math.exp(x - max(row)) for a, x in zip(p, row))) for row in rows) - langid.PENALTY * size * math.log(len(rows) + 1)
        if fit <= value:
            break
        best, value = p, fit
    own = [j for j in sorted(range(n_langs), key=lambda j: -best[j]) if best[j] > 0]
    return own, [best[j] for j in own], unknown


def test_inference_is_the_plain_one(spark):
    """A few hundred texts of one to four languages, foreign words among them; also piece by piece."""
    import random

    rng = random.Random(6)
    words = WORDS | {"es": "el los las una por con para como más pero sus este sin sobre ser también hasta hay donde quien".split()}
    docs = spark.createDataFrame([(i, " ".join(rng.choices(words[lang], k=40)), lang) for i, lang in enumerate(list(words) * 40)], "doc_id long, text string, lang string")
    langs, table = langid.fit(docs)
    texts = ["", None, "123", "der", "погода"]
    for _ in range(300):
        parts = [rng.choices(words[x], k=rng.randint(1, 60)) for x in rng.sample(list(words), rng.randint(1, 4))] + [["погода", "xkqz"][: rng.randint(0, 2)] * rng.randint(0, 9)]
        texts.append(" ".join(w for p in parts for w in p))
    picked, shares, unknown = langid.infer(texts, table)
    rows = table.tolist()
    for i, text in enumerate(texts):
        own, share, rest = plain_mixture(text, rows)
        assert picked[i].tolist() == own and shares[i].tolist() == pytest.approx(share, abs=2e-3) and unknown[i] == pytest.approx(rest, abs=2e-3), text
        if i % 10 == 5 and own:
            p, s, u = langid.infer_long(text, table, long=40)
            assert p.tolist() == own and s.tolist() == pytest.approx(share, abs=2e-3) and u == pytest.approx(rest, abs=2e-3)


def test_long_texts_are_read_in_pieces(monkeypatch):
    """The second half of a long text counts like the first, and a text of one long word is no burden."""
    table = np.log(np.random.default_rng(1).dirichlet(np.ones(langid.BUCKETS), 3).T).astype(np.float32)
    text = " ".join(sentences("de", i) for i in range(30)) + " " + " ".join(sentences("fr", i) for i in range(30)) + " " + "x" * 3000
    whole = langid.infer([text, "short", text], table)
    monkeypatch.setattr(langid, "LONG", 1000)
    pieces = langid.infer([text, "short", text], table)
    for a, b in zip(whole[:2], pieces[:2]):
        assert [x.tolist() for x in a] == [pytest.approx(x.tolist(), abs=1e-2) for x in b]


def test_em_recovers_proportions():
    like = np.array([[1, 0.1]] * 30 + [[0.1, 1]] * 10, np.float32)
    share = langid.em(like, np.array([0]), np.array([40]), np.full((1, 2), 0.5, np.float32), 30)
    assert share[0][0] == pytest.approx(0.805, abs=0.02)


def scanned(spark, texts):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, license string")
    return {(r["doc_id"], r["license"]): r["containment"] for r in license_scan.scan(docs).collect()}


def test_licenses(spark, tmp_path):
    gpl, mit = license_scan.TEMPLATES["gpl-3.0"], license_scan.TEMPLATES["mit"]
    broken = mit.split()
    broken[50] = "changed"
    filler = " ".join(f"filler{i}" for i in range(300))
    texts = [f"{filler} {gpl}", f"{mit.upper()} {filler}", " ".join(broken), None, "", "Released under the MIT License.", " ".join(mit.split()[:40]), filler, f"{filler} Licensed under CC BY-NC 4.0. {filler} licensed under cc-by nc (4.0)", gpl]
    found = scanned(spark, texts)
    assert {k for k in found if k[1] in ("gpl-3.0", "mit")} == {(0, "gpl-3.0"), (1, "mit"), (2, "mit"), (9, "gpl-3.0")}
    assert found[5, "mit-line"] == 1.0 and found[8, "cc-by-nc-4.0-line"] == 1.0 and found[0, "gpl-3.0"] == 1.0
    assert 0.8 <= found[2, "mit"] < 1.0
    assert license_scan.scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    # repeated rows, and two halves of one notice in rows that share an id or have none: each is a text of its own
    half = mit.split()
    halves = [(i, " ".join(x)) for i in (None, 77) for x in (half[:45], half[45:])]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(0, texts[0]), (None, texts[1]), *halves], "doc_id long, text string")
    assert sorted(r["license"] for r in license_scan.scan(docs).where("doc_id IS NULL").collect()) == ["mit"]
    assert license_scan.scan(docs).where("doc_id = 77").count() == 0 and license_scan.scan(docs).where("doc_id = 0").count() == 2
    mine, theirs = against_duckdb(spark, tmp_path, "op10_license_bands", {"documents": docs})
    assert mine == theirs


def plain_containment(words, template):
    """The best share of the template's shingles in any window of twice its length, by a loop over all windows."""
    cut = lambda w: [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    own, said = cut(template), cut(words)
    return max((len(set(own) & set(said[i : i + 2 * len(own)])) / len(set(own)) for i in range(len(said))), default=0)


def test_licenses_with_insertions_and_edits(spark):
    """A notice split by foreign words is found wherever it stands, and every edited copy that a loop finds."""
    import random

    rng = random.Random(1)
    mit = license_scan.template_words(license_scan.TEMPLATES["mit"])
    lead = lambda n: [f"lead{rng.random()}".replace(".", "") for _ in range(n)]
    texts = [[*lead(n), *mit[:45], *lead(gap), *mit[45:]] for n in range(0, 90, 3) for gap in (0, 40, 60)]
    for name, template in license_scan.TEMPLATES.items():
        own = license_scan.template_words(template)
        if len(own) > 15:
            texts += [[*lead(7), *(w if rng.random() > rate else f"edit{i}" for i, w in enumerate(own)), *lead(20)] for rate in (0.01, 0.02, 0.03, 0.04) for _ in range(8)]
    found = scanned(spark, [" ".join(t) for t in texts])
    for name, template in license_scan.TEMPLATES.items():
        own = license_scan.template_words(template)
        expected = {i: c for i, t in enumerate(texts) if (c := plain_containment(t, own)) >= license_scan.LEAST}
        assert {i: c for (i, n), c in found.items() if n == name} == pytest.approx(expected), name


def test_scan_is_native(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = license_scan.scan(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_pipeline(spark, tmp_path):
    rows = [(i, sentences(lang, i, 200) + f" {i} {i * 31} {i * 17}", lang, f"s{i % 4}") for i, lang in enumerate(list(WORDS) * 40)]
    rows += [(500, rows[0][1], "en", "s1"), (501, "0101 !!", "en", "s1"), (502, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    first = dict(corpus_pipeline.STAGES)
    known = first["language_id"](spark, docs, str(tmp_path))
    assert known.columns == docs.columns and {r["doc_id"] for r in known.collect()} == {r[0] for r in rows} - {501, 502}
    single = first["near_duplicates"](spark, known, str(tmp_path))
    ids = {r["doc_id"] for r in single.collect()}
    groups = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(known).collect()}
    assert ids == {i for i, c in groups.items() if i == c} and 500 not in ids
    mixed = first["mixture"](spark, single, str(tmp_path))
    assert mixed.columns == docs.columns
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.count() == mixed.count() and {r["doc_id"] for r in out.select("doc_id").collect()} <= ids
    library = Tokenizer.from_file(queries.vocabulary("word_bpe_49k.json"))
    said = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in out.limit(20).collect():
        ids = np.array(library.encode(said[r["doc_id"]], add_special_tokens=False).ids, "<u4")
        assert r["ids"] == ids.tobytes() and r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(ids).hexdigest()
    assert corpus_pipeline.ORACLE_SQL is None and 4 <= len(corpus_pipeline.STAGES) <= 5


@pytest.mark.parametrize("rows", [[], [(1, "der die und den von zu das mit sich", "de", "s1")], [(1, None, None, None), (2, "", "en", "s")]])
def test_pipeline_of_few_rows(spark, tmp_path, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long")).repartition(5)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted(r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == [i for i, text, *_ in rows if text]


def test_written_tables_go(spark):
    from linkloom.llm import common

    with pytest.raises(RuntimeError), common.scratch(spark) as keep:
        kept = keep(common.written(spark.range(3), "kept"))
        gone = common.written(spark.range(4), "gone")
        raise RuntimeError
    assert kept.count() == 3
    with pytest.raises(Exception, match="does not exist|FILE_NOT_EXIST|no such file"):
        gone.count()
    common.release(spark)
    assert common.folders() == []
    assert common.shared_dir(spark).startswith("file:")
