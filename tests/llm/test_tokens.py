"""Encoding against the tokenizers library; token shards against plain arrays."""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from linkloom.llm import bpe, wavelet
from linkloom.llm.queries import vocabulary

WORD, BYTE = vocabulary("word_bpe_49k.json"), vocabulary("byte_bpe_50k.json")
PIECES = ["a", "B", "ing ", " the ", " ", "  ", "\n", "\n\n", "\t", "0", "12", "'s", "'LL", "é", "É", "é", "ß", "Σ", "σς", "İ", " ", " ", "\x1c", "\x85", "中文", "🎉", "👩‍👩", "<|endoftext|>", "<|startoftext|>", "<|", ".", ",", "!?", "aaaa", "\x00"]
texts = st.lists(st.sampled_from(PIECES), max_size=30).map("".join) | st.text(max_size=40)


@pytest.fixture(scope="module")
def libraries():
    return Tokenizer.from_file(WORD), Tokenizer.from_file(BYTE)


@settings(max_examples=300, deadline=None)
@given(batch=st.lists(texts, min_size=1, max_size=4))
def test_word_bpe_is_the_library(batch, libraries):
    ids, said = bpe.coder(WORD).texts(pa.array(batch))
    for text, own, spoken in zip(batch, ids.to_pylist(), said.to_pylist()):
        expected = libraries[0].encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own, "<u4").tolist() == expected
        assert spoken == libraries[0].decode(expected, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(batch=st.lists(texts, min_size=1, max_size=4))
def test_byte_tokens_are_the_library(batch, libraries):
    for text, own in zip(batch, wavelet.tokens(BYTE).texts(pa.array(batch))):
        assert own.tolist() == libraries[1].encode(text, add_special_tokens=False).ids


def test_merges_in_runs():
    merges = bpe.coder(WORD).merges
    library = Tokenizer.from_file(WORD)
    for word in ("a" * 17, "ababab", "mississippi", "x"):
        assert merges.encode([word.encode()])[0].tolist() == library.encode(word, add_special_tokens=False).ids
    ids, counts = merges.encode([b"aab", b"x"])
    assert counts.sum() == len(ids) and len(counts) == 2 and len(merges.encode([])[0]) == 0


def test_caches_are_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 20)
    monkeypatch.setattr(bpe, "CACHE_WORDS", 40)
    monkeypatch.setattr(wavelet, "CACHE_PIECES", 20)
    coder, tokens, a, b = bpe.Coder(WORD), wavelet.Tokens(BYTE), Tokenizer.from_file(WORD), Tokenizer.from_file(BYTE)
    for i in range(8):
        text = " ".join(f"word{i}{j}" for j in range(30))
        ids, _ = coder.texts(pa.array([text, None]))
        assert np.frombuffer(ids[0].as_py(), "<u4").tolist() == a.encode(text, add_special_tokens=False).ids
        assert ids[1].as_py() == b""
        assert tokens.texts(pa.array([text, None]))[0].tolist() == b.encode(text, add_special_tokens=False).ids
        assert len(coder.pieces.index) <= 20 + 30 and len(coder.words.index) <= 40 + 31


@pytest.mark.parametrize("part", [wavelet.PART, 1024])
@pytest.mark.parametrize("top", [1, 2, 300, 70000])
def test_shard(top, part, monkeypatch):
    monkeypatch.setattr(wavelet, "PART", part)
    ids = np.random.default_rng(top).integers(0, top, 3000).astype(np.uint32)
    shard = wavelet.Shard(wavelet.build(np.arange(3), np.array([1000, 0, 2000]), ids, "x"))
    assert shard.tokens().tolist() == ids.tolist()
    assert [shard.access(i) for i in range(0, 3000, 17)] == ids[::17].tolist()
    for token in [*ids[:8].tolist(), top + 5]:
        at = np.flatnonzero(ids == token).tolist()
        assert shard.count(token) == len(at) and shard.rank(token, 1234) == sum(a < 1234 for a in at)
        assert [shard.select(token, k) for k in range(min(5, len(at)))] == at[:5]
        if len(at) < 500:
            assert shard.occurrences(token) == at
    with pytest.raises(IndexError):
        shard.access(3000)
    with pytest.raises(IndexError):
        shard.select(top + 5, 0)


def test_shard_opens_what_it_needs():
    """Of a file of some MB, access and a count open a part of each level, with the stored counts, not the planes."""
    ids = np.random.default_rng(9).integers(0, 30_000, 3_000_000).astype(np.uint32)
    shard = wavelet.Shard(wavelet.build(np.arange(1), np.array([len(ids)]), ids, "x"))
    assert shard.parts > 5 and shard.levels == 15
    sections = len(shard.head["sections"])
    assert shard.access(1_234_567) == ids[1_234_567] and len(shard.opened) <= 3 + 2 * shard.levels < sections / 2
    token = int(ids[77])
    at = np.flatnonzero(ids == token)
    assert shard.count(token) == len(at) and shard.occurrences(token) == at.tolist()
    assert np.array_equal(shard.tokens(), ids)


def test_long_texts_are_encoded_whole(libraries):
    """A text of several MB, white space of every kind, in both encoders."""
    import random

    rng = random.Random(8)
    text = "".join(rng.choice(["word", "another", "é", "x1", ",", "."]) + rng.choice([" ", "  ", "\n", " \n\t", ""]) for _ in range(500_000))
    assert len(text) > 2_000_000
    assert wavelet.tokens(BYTE).texts(pa.array([text]))[0].tolist() == libraries[1].encode(text, add_special_tokens=False).ids
    ids, _ = bpe.coder(WORD).texts(pa.array([text]))
    assert np.frombuffer(ids[0].as_py(), "<u4").tolist() == libraries[0].encode(text, add_special_tokens=False).ids


ROWS = [(5, "Hello world, it's <|endoftext|> fine"), (2, None), (9, ""), (7, "x  y\n\nz "), (7, "x  y\n\nz "), (None, "no id"), (1, "long " * 3000)]


def test_token_files(spark, monkeypatch, libraries):
    docs = spark.createDataFrame([(i, t, "noise") for i, t in ROWS], "doc_id long, text string, shard string")
    found = wavelet.token_files(docs, BYTE).collect()
    order = sorted(ROWS, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    start, expected = 0, []
    for doc, text in order:
        ids = [*libraries[1].encode(text or "", add_special_tokens=False).ids, 2]
        expected.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, found), key=lambda r: r[1]) == expected
    assert wavelet.token_files(docs.limit(0), BYTE).collect() == []


def test_digests_and_decode(spark, libraries):
    docs = spark.createDataFrame([(i, t, 1) for i, t in ROWS], "doc_id long, text string, n_tokens int")
    found = sorted((r["doc_id"] or -1, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.digests(docs, WORD).collect())
    expected = []
    for doc, text in ROWS:
        ids = libraries[0].encode(text or "", add_special_tokens=False).ids
        sha = [hashlib.sha256(x).hexdigest() for x in (np.array(ids, "<u4").tobytes(), libraries[0].decode(ids, skip_special_tokens=False).encode())]
        expected.append((doc or -1, len(ids), *sha))
    assert found == sorted(expected)
    coded = bpe.encode(docs, WORD)
    said = {(r["doc_id"] or -1): r["text"] for r in bpe.decode(coded, WORD).collect()}
    assert said[2] == "" and said[5] == "hello</w> world</w> ,</w> it</w> 's</w> <|endoftext|> fine</w>"
    assert bpe.digests(docs.limit(0), WORD).collect() == []
