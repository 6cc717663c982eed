"""BPE encoding and decoding by a pair occurrence index.

Texts are cut at white space and the distinct pieces of a batch are normalised (canonical composition, lower
case) and split into words; pieces beyond Latin letters are normalised and split by the library. The words that a worker has not met are merged together: an index maps the rank
of every adjacent pair to all its positions; ranks are taken in ascending order from a heap, all positions of
a rank are merged at once, and the pairs that this makes are added to the lists of their ranks. A document's
ids are then gathered piece by piece. Pieces and words stay in per-worker banks of bounded size.

Edge cases: null text is empty and has no ids; special tokens inside a text become their ids, as the library
does by default; white space carries nothing; bytes that the vocabulary lacks are dropped; repeated rows and
extra columns change nothing; texts are encoded whole.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer, pre_tokenizers

from linkloom.llm.common import slices

#: Entries of the banks of a worker; a bank that is over is emptied before more is learned.
CACHE_PIECES = 300_000
CACHE_WORDS = 400_000
NONE = np.int64(1 << 40)
#: Up to here every version of Unicode agrees on letters, numbers and case.
BEYOND_LATIN = regex.compile("[^\\x00-\\u024F]")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself if visible, else one from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class Merges:
    """The tables of one vocabulary file and the merging of words."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.end = spec["model"].get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) or r"(?!)")
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(split["pattern"]["Regex"])
        self.size = max([*vocab.values(), *self.special.values()]) + 1
        self.tokens = [""] * self.size
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        pairs = [(m.split(" ") if isinstance(m, str) else m) for m in merges]
        self.left = np.array([vocab[a] for a, _ in pairs], np.int64)
        self.right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        keys = self.left * self.size + self.right
        self.rank_of = np.argsort(keys, kind="stable")
        self.keys = keys[self.rank_of]
        symbols = byte_symbols()
        self.inner = np.array([vocab.get(s, -1) for s in symbols], np.int64)
        self.last = np.array([vocab.get(s + self.end, -1) for s in symbols], np.int64)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair; NONE where it never merges."""
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (a >= 0) & (b >= 0), self.rank_of[at], NONE)

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after another, and how many each has."""
        if not words:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum(sizes)
        token = self.inner[raw]
        token[ends - 1] = self.last[raw[ends - 1]]
        owner = np.repeat(np.arange(len(words)), sizes)
        if (token < 0).any():  # bytes unknown to the vocabulary
            owner, token = owner[token >= 0], token[token >= 0]
        n = len(token)
        same = owner[1:] == owner[:-1] if n else np.zeros(0, bool)
        nxt = np.append(np.where(same, np.arange(1, n), -1), -1)[:n]
        prv = np.concatenate([[-1], np.where(same, np.arange(n - 1), -1)])[:n]
        rank = np.full(n, NONE)
        head = np.flatnonzero(nxt >= 0)
        rank[head] = self.ranks(token[head], token[nxt[head]])

        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def add(at: np.ndarray, rank: np.ndarray) -> None:
            at, rank = at[rank < NONE], rank[rank < NONE]
            if not len(at):
                return
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            for r, own in zip(rank[np.concatenate([[0], cuts])].tolist(), np.split(at, cuts)):
                if r in index:
                    index[r].append(own)
                else:
                    index[r] = [own]
                    heapq.heappush(heap, r)

        add(head, rank[head])
        while heap:
            r = heapq.heappop(heap)
            lists = index.pop(r)
            a, b, made = self.left[r], self.right[r], self.made[r]
            at = np.unique(np.concatenate(lists)) if len(lists) > 1 else np.unique(lists[0])
            at = at[(token[at] == a) & (nxt[at] >= 0)]
            at = at[token[nxt[at]] == b]
            if a == b and len(at) > 1:  # runs: from the left, none overlapping
                taken, kept = set(), []
                for i in at.tolist():
                    if i not in taken:
                        kept.append(i)
                        taken.add(int(nxt[i]))
                at = np.array(kept)
            if not len(at):
                continue
            gone = nxt[at]
            after = nxt[gone]
            token[at], token[gone] = made, -1
            nxt[at], nxt[gone] = after, -1
            prv[after[after >= 0]] = at[after >= 0]
            before = prv[at]
            left, right = before[before >= 0], at[after >= 0]
            new = np.concatenate([left, right])
            add(new, self.ranks(token[new], token[nxt[new]]))
        alive = token >= 0
        return token[alive].astype(np.uint32), np.bincount(owner[alive], minlength=len(words))


class Bank:
    """Ids of strings: a place for each string, and one flat array for all their ids."""

    def __init__(self):
        self.index: dict[str, int] = {}
        self.begun, self.sizes, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def add(self, keys: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        have = len(self.begun)
        self.begun = np.concatenate([self.begun, len(self.flat) + np.cumsum(counts) - counts])
        self.sizes = np.concatenate([self.sizes, counts])
        self.flat = np.concatenate([self.flat, ids])
        self.index.update(zip(keys, range(have, have + len(keys))))

    def places(self, keys: list[str]) -> np.ndarray:
        return np.fromiter(map(self.index.__getitem__, keys), np.int64, len(keys))

    def ids(self, at: np.ndarray) -> np.ndarray:
        """The ids of the strings at these places, one after another."""
        n = self.sizes[at]
        return self.flat[np.repeat(self.begun[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())]


class Coder:
    """Ids of pieces of text without ASCII white space, and of their words, kept in banks of bounded size."""

    def __init__(self, path: str):
        self.merges = Merges(path)
        self.token_strings = pa.array(self.merges.tokens, pa.string())
        self.normalize = Tokenizer.from_file(path).normalizer.normalize_str
        self.library_split = pre_tokenizers.Split(Regex(self.merges.words.pattern), "removed", invert=True).pre_tokenize_str
        # all new pieces are split at once; the newline between them comes out as a word of its own, without ids
        self.split = regex.compile(f"(?:{self.merges.words.pattern})|\n")
        self.forget_words()
        self.pieces = Bank()

    def forget_words(self) -> None:
        self.words = Bank()
        self.words.add(["\n"], np.zeros(0, np.uint32), np.zeros(1, np.int64))

    def coded(self, words: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words of n pieces, with a newline between pieces, one after another, and how many each piece has."""
        if len(self.words.index) > CACHE_WORDS:
            self.forget_words()
        new = [w for w in dict.fromkeys(words) if w not in self.words.index]
        self.words.add(new, *self.merges.encode([w.encode("utf-8", "surrogatepass") for w in new]))
        at = self.words.places(words)
        owner = np.cumsum(at == 0)
        return self.words.ids(at), np.bincount(owner, self.words.sizes[at], minlength=n).astype(np.int64)

    def plain(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same of pieces of Latin text, split at once."""
        text = "\n".join(pieces)
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        return self.coded(self.split.findall(text.lower()), len(pieces))

    def strange(self, piece: str) -> np.ndarray:
        """Ids of any other piece: the library finds special tokens, case and classes of its own version of Unicode."""
        out, at = [], 0
        for m in [*self.merges.cut.finditer(piece), None]:
            part = self.normalize(piece[at : m.start() if m else len(piece)])
            out.append(self.coded([w for w, _ in self.library_split(part)], 1)[0])
            if m:
                out.append(np.array([self.merges.special[m[0]]], np.uint32))
                at = m.end()
        return np.concatenate(out)

    def learn(self, pieces: list[str]) -> None:
        if len(self.pieces.index) > CACHE_PIECES:
            self.pieces = Bank()
        new = [p for p in pieces if p not in self.pieces.index]
        other = [p for p in new if not p.isascii() and BEYOND_LATIN.search(p) or "<" in p and self.merges.cut.search(p)]
        if other:
            rare = set(other)
            new = [p for p in new if p not in rare]
            ids = [self.strange(p) for p in other]
            self.pieces.add(other, np.concatenate(ids), np.array([len(x) for x in ids]))
        for at in range(0, len(new), 100_000):
            self.pieces.add(new[at : at + 100_000], *self.plain(new[at : at + 100_000]))

    def texts(self, texts: pa.Array) -> tuple[pa.Array, pa.Array]:
        """For each text (null: empty) its ids as little-endian 32-bit integers, and its decoded text."""
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        offsets, values = lists.offsets.to_numpy().astype(np.int64), lists.values
        full = pc.greater(pc.binary_length(values), 0).to_numpy(zero_copy_only=False)
        offsets = np.concatenate([[0], np.cumsum(full)])[offsets]
        coded = values.filter(pa.array(full)).dictionary_encode()
        pieces = coded.dictionary.to_pylist()
        self.learn(pieces)
        at = self.pieces.places(pieces)[coded.indices.to_numpy()]
        ids = self.pieces.ids(at)
        cuts = np.concatenate([[0], np.cumsum(self.pieces.sizes[at])])[offsets]
        raw = pa.Array.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(cuts * 4), pa.py_buffer(ids.astype("<u4"))])
        said = self.token_strings.take(pa.array(ids))
        return raw.cast(pa.binary()), pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), said), " ")


@lru_cache(maxsize=2)
def coder(path: str) -> Coder:
    """One coder per process and vocabulary file."""
    return Coder(path)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (binary: little-endian unsigned 32-bit integers), one row per row of ``docs``."""
    return coded(docs, path, [("ids", "binary", lambda ids, said: ids)])


def sha(a: pa.Array) -> pa.Array:
    return pa.array([hashlib.sha256(x.as_buffer()).hexdigest() for x in a], pa.string())


DIGESTS = [
    ("n_tokens", "long", lambda ids, said: pc.divide(pc.binary_length(ids).cast(pa.int64()), 4)),
    ("ids_sha256", "string", lambda ids, said: sha(ids)),
    ("decoded_sha256", "string", lambda ids, said: sha(said)),
]


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every text and of what its ids decode to."""
    return coded(docs, path, DIGESTS)


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """``digests`` with the ids themselves (binary: little-endian unsigned 32-bit integers)."""
    return coded(docs, path, [*DIGESTS, ("ids", "binary", lambda ids, said: ids)])


def coded(docs: DataFrame, path: str, columns: list) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path)
        for batch in slices(batches, "text"):
            ids, said = own.texts(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(f(ids, said) for *_, f in columns)], ["doc_id", *(c[0] for c in columns)])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, ", ".join(["doc_id long", *(f"{c[0]} {c[1]}" for c in columns)]))


def decode(rows: DataFrame, path: str) -> DataFrame:
    """doc_id, text: the token strings of ``ids``, joined by spaces (this vocabulary has no decoder); null ids: empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = coder(path).merges.tokens
        for batch in slices(batches, "ids"):
            lists = [np.frombuffer(x or b"", "<u4").tolist() for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([" ".join([tokens[i] for i in x]) for x in lists], pa.string())], ["doc_id", "text"])

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
