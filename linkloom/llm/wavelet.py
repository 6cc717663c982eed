"""Token ids in wavelet-matrix files: one succinct, compressed file per shard of documents.

Documents are range-partitioned and sorted by doc_id, tokenised, and cut into shards of about
``SHARD_TOKENS``. A shard's tokens are renumbered to the ids it uses and stored as a wavelet matrix: a bit
plane per level, the most significant bit first, with the zeros of each level moved ahead of its ones for
the next. The file holds the ones in every ``BLOCK`` bits of a plane, whose running sums give rank in one step
and which select searches, and each plane in parts of ``PART`` bits that are compressed by themselves. So the
token at a position, how often an id occurs, and where, each open one part a level, not the file; whole
documents are read back by undoing the levels.

Layout of a file: ``MAGIC``, the header's length (4 bytes, little-endian), a JSON header, then the sections
that it lists, each a Zstandard frame: document ids (null as the smallest 64-bit integer), documents' token
counts, the alphabet, for each level the ones of its blocks, and for each level the parts of its plane.

Edge cases: null text is empty and consists of the end id; null doc_ids come last; equal doc_ids are ordered
by a hash of the text and the text, and split among tasks by it; a text longer than a shard is a shard of its own; an empty table gives no file and no rows; extra
columns are not read.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkloom.llm.common import fresh_dir, slices, written
from linkloom.llm.files import contents, put

MAGIC = b"LLWM0002"
#: Bits of a plane for each stored count, and for each frame.
BLOCK = 512
PART = 1 << 19
SHARD_TOKENS = 4 << 20
END_ID = 2
NULL_ID = np.iinfo(np.int64).min
CACHE_PIECES = 600_000
#: New pieces that the library sees at once.
TOGETHER = 20_000
#: White space as the vocabulary's splitter has it (fixed: the Unicode property White_Space).
#: First for Python's patterns, then for Arrow's.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
RE2_SPACE = r"\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


class Tokens:
    """Ids of texts by the tokenizers library, which sees each distinct piece once.

    The splitter never lets a match run from non-white to white space, so a text may be cut there: into pieces
    of leading white space and what follows. Texts whose white space is single spaces and newlines are cut by
    Arrow; others by a pattern; those with the text of a special token go to the library whole. Many pieces are
    encoded as one text, whose ids are cut again by the bytes that each token stands for. What is known of pieces
    that a batch has more than once stays in a cache of bounded size, one flat array of ids for all.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        if hasattr(self.library.model, "_resize_cache"):  # pieces are kept here, so the library's own bank only costs
            self.library.model._resize_cache(0)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.n_bytes = np.zeros(self.library.get_vocab_size(), np.int64)  # a byte-level token has a character per byte
        for token, i in self.library.get_vocab(with_added_tokens=False).items():
            self.n_bytes[i] = len(token)
        self.newline = len(self.whole("\n"))
        self.piece = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
        self.blank_end = re.compile(f"[{SPACE}]\\Z")
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.kept = 0, 0  # of begun and sizes, and of flat: what follows is of the last batch only
        self.begun, self.sizes, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def learn(self, pieces: list[str], n_bytes: np.ndarray | None = None, once: np.ndarray | None = None) -> np.ndarray:
        """The place of each of these distinct pieces in ``begun`` and ``sizes``; none may end in white space.

        ``n_bytes``: their lengths in UTF-8, if known; ``once``: those that are not worth keeping, whose places hold until the next call.
        """
        if len(self.index) > CACHE_PIECES:
            self.forget()
        n, m = self.kept
        self.begun, self.sizes, self.flat = self.begun[:n], self.sizes[:n], self.flat[:m]
        at = np.fromiter(map(self.index.get, pieces, repeat(-1)), np.int64, len(pieces))
        unknown = np.flatnonzero(at < 0)
        if len(unknown):
            rare = np.zeros(len(unknown), bool) if once is None else once[unknown]
            unknown = np.concatenate([unknown[~rare], unknown[rare]])
            new, stay = [pieces[i] for i in unknown.tolist()], int((~rare).sum())
            size = np.fromiter((len(p.encode()) for p in new), np.int64, len(new)) if n_bytes is None else n_bytes[unknown]
            lists, counts = [], []
            for a in range(0, len(new), TOGETHER):
                ids = self.whole("".join(new[a : a + TOGETHER]))
                ends = np.cumsum(size[a : a + TOGETHER])
                counts.append(np.diff(np.searchsorted(np.cumsum(self.n_bytes[ids]), ends, side="right"), prepend=0))
                lists.append(ids)
            counts = np.concatenate(counts)
            self.begun = np.concatenate([self.begun, m + np.cumsum(counts) - counts])
            self.sizes = np.concatenate([self.sizes, counts])
            self.flat = np.concatenate([self.flat, *lists])
            self.index.update(zip(new[:stay], range(n, n + stay)))
            self.kept = n + stay, m + int(counts[:stay].sum())
            at[unknown] = np.arange(n, n + len(new))
        return at

    def gathered(self, at: np.ndarray) -> np.ndarray:
        """The ids of the pieces at these places, one after another."""
        n = self.sizes[at]
        return self.flat[np.repeat(self.begun[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())]

    def slow(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special):
            return self.whole(text)
        pieces = self.piece.findall(text)
        last = self.whole(pieces.pop()) if pieces and self.blank_end.search(pieces[-1]) else np.zeros(0, np.uint32)
        places = dict(zip(distinct := list(dict.fromkeys(pieces)), self.learn(distinct).tolist()))
        return np.concatenate([self.gathered(np.array([places[p] for p in pieces], np.int64)), last])

    def texts(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text (null: none)."""
        if not len(texts):
            return []
        texts = pc.fill_null(texts, "")
        # a newline ahead of each text makes its first piece like any other; its one id is dropped again
        led = pc.binary_join_element_wise("\n", texts, "")
        lists = pc.split_pattern(pc.replace_substring(led, "\n", " \n"), " ")
        coded = lists.values.dictionary_encode()
        offsets, at = lists.offsets.to_numpy(), coded.indices.to_numpy()
        odd = pc.match_substring_regex(coded.dictionary, f"^$|[{RE2_SPACE}]$")
        for s in self.special:
            odd = pc.or_(odd, pc.match_substring(coded.dictionary, s))
        odd = odd.to_numpy(zero_copy_only=False)
        pieces = coded.dictionary.filter(pa.array(~odd))
        pieces = pc.if_else(pc.starts_with(pieces, "\n"), pieces, pc.binary_join_element_wise("", pieces, " "))
        place = np.full(len(odd), -1)
        once = np.bincount(at, minlength=len(odd)) == 1
        place[~odd] = self.learn(pieces.to_pylist(), pc.binary_length(pieces).to_numpy().astype(np.int64), once[~odd])
        # of each text's pieces the first is empty: what stood before the added newline
        inner = np.ones(len(at), bool)
        inner[offsets[:-1]] = False
        bad = np.add.reduceat((odd[at] & inner).astype(np.int64), offsets[:-1]) > 0
        # white space at the start would run on from the added newline
        bad |= pc.match_substring_regex(texts, f"^[{RE2_SPACE}]").to_numpy(zero_copy_only=False)
        kept = ~odd[at]
        at = place[at[kept]]
        flat, n = self.gathered(at), self.sizes[at]
        cuts = np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], np.cumsum(kept)])[offsets]]
        plain = [None if b else flat[i + self.newline : j] for b, i, j in zip(bad.tolist(), cuts[:-1].tolist(), cuts[1:].tolist())]
        return [self.slow(texts[i].as_py()) if x is None else x for i, x in enumerate(plain)]


@lru_cache(maxsize=2)
def tokens(path: str) -> Tokens:
    return Tokens(path)


# --- one shard --------------------------------------------------------------------------------------


def build(doc_ids: np.ndarray, counts: np.ndarray, ids: np.ndarray, name: str) -> bytes:
    """The file of one shard."""
    present = np.zeros(int(ids.max()) + 1 if len(ids) else 1, bool)
    present[ids] = True
    alphabet = np.flatnonzero(present).astype(np.uint32)
    code = np.cumsum(present) - 1
    level = max(1, int(len(alphabet) - 1).bit_length())
    x = code.astype(np.uint16 if level <= 16 else np.uint32)[ids]
    zstd = zstandard.ZstdCompressor(level=1)
    sections, ranks, planes, zeros = [doc_ids.astype("<i8").tobytes(), counts.astype("<u4").tobytes(), alphabet.astype("<u4").tobytes()], [], [], []
    for bit in range(level - 1, -1, -1):
        ones = (x >> bit & 1).astype(bool)
        low = x[~ones]
        zeros.append(len(low))
        plane = np.packbits(ones, bitorder="little")
        ranks.append(block_ones(plane).astype("<u2").tobytes())
        planes += [plane[at : at + PART // 8].tobytes() for at in range(0, len(plane), PART // 8)]
        x = np.concatenate([low, x[ones]])
    packed = [zstd.compress(s) for s in [*sections, *ranks, *planes]]
    head = json.dumps({"shard": name, "docs": len(doc_ids), "tokens": len(ids), "zeros": zeros, "sections": [len(p) for p in packed]}).encode()
    return b"".join([MAGIC, len(head).to_bytes(4, "little"), head, *packed])


def block_ones(plane: np.ndarray) -> np.ndarray:
    """Ones in every BLOCK bits of a plane."""
    per = BLOCK // 8
    return np.bitwise_count(np.pad(plane, (0, -len(plane) % per)).view(np.uint64)).reshape(-1, per // 8).sum(axis=1, dtype=np.int64)


class Shard:
    """A shard's file, with access, rank, select, counting and occurrence lookup; frames are opened as they are needed."""

    def __init__(self, content: bytes):
        if content[: len(MAGIC)] != MAGIC:
            raise ValueError("not a token shard")
        at = len(MAGIC) + 4
        size = int.from_bytes(content[at - 4 : at], "little")
        self.content, self.head = content, json.loads(content[at : at + size])
        self.ends = at + size + np.cumsum(self.head["sections"])
        self.name, self.n, self.zeros = self.head["shard"], self.head["tokens"], self.head["zeros"]
        self.opened: dict[int, bytes] = {}
        self.doc_ids, self.counts = np.frombuffer(self.frame(0), "<i8"), np.frombuffer(self.frame(1), "<u4")
        self.alphabet = np.frombuffer(self.frame(2), "<u4")
        self.levels, self.parts = len(self.zeros), -(-self.n // PART)
        self._ranks: dict[int, np.ndarray] = {}

    def frame(self, i: int) -> bytes:
        """A section; up to 64 stay open."""
        if i not in self.opened:
            if len(self.opened) >= 64:
                self.opened.pop(next(iter(self.opened)))
            size = self.head["sections"][i]
            self.opened[i] = zstandard.ZstdDecompressor().decompress(self.content[self.ends[i] - size : self.ends[i]])
        return self.opened[i]

    def part(self, level: int, i: int) -> np.ndarray:
        """The part of a plane that holds bit ``i``."""
        return np.frombuffer(self.frame(3 + self.levels + level * self.parts + i // PART), np.uint8)

    def plane(self, level: int) -> np.ndarray:
        own = 3 + self.levels + level * self.parts
        sizes, zstd = self.head["sections"], zstandard.ZstdDecompressor()
        return np.frombuffer(b"".join(zstd.decompress(self.content[self.ends[i] - sizes[i] : self.ends[i]]) for i in range(own, own + self.parts)), np.uint8)

    def ranks(self, level: int) -> np.ndarray:
        """Ones before every BLOCK bits of a plane, summed from the counts in the file."""
        if level not in self._ranks:
            self._ranks[level] = np.concatenate([[0], np.cumsum(np.frombuffer(self.frame(3 + level), "<u2"), dtype=np.int64)])
        return self._ranks[level]

    def ones(self, level: int, i: int) -> int:
        """Ones among the first ``i`` bits of a plane: the sum up to its block, and those in the block."""
        block = i // BLOCK
        n = int(self.ranks(level)[block])
        if i % BLOCK:
            at = block * BLOCK % PART // 8
            own = self.part(level, i)[at : at + (i % BLOCK + 7) // 8]
            n += int(np.bitwise_count(own).sum())
            if i % 8:
                n -= int(own[-1] >> (i % 8)).bit_count()
        return n

    def bit(self, level: int, i: int) -> int:
        return int(self.part(level, i)[i % PART // 8] >> (i % 8)) & 1

    def access(self, i: int) -> int:
        """The id at a position."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        code = 0
        for level in range(self.levels):
            one = self.bit(level, i)
            code = code << 1 | one
            i = self.zeros[level] + self.ones(level, i) if one else i - self.ones(level, i)
        return int(self.alphabet[code])

    def span(self, token: int, to: int | None = None) -> tuple[int, int]:
        """Where, past the last level, the occurrences of an id among the first ``to`` positions lie."""
        code = int(np.searchsorted(self.alphabet, token))
        if code == len(self.alphabet) or self.alphabet[code] != token:
            return 0, 0
        a, b = 0, self.n if to is None else to
        for level in range(self.levels):
            one = code >> (self.levels - 1 - level) & 1
            ra, rb = self.ones(level, a), self.ones(level, b)
            a, b = (self.zeros[level] + ra, self.zeros[level] + rb) if one else (a - ra, b - rb)
        return a, b

    def rank(self, token: int, to: int) -> int:
        """Occurrences of an id before position ``to``."""
        a, b = self.span(token, to)
        return b - a

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def place(self, level: int, k: int, one: int) -> int:
        """The position of the k-th (from 0) bit of a kind in a plane: blocks first, then bits."""
        r = self.ranks(level)
        before = r if one else np.minimum(np.arange(len(r)) * BLOCK, self.n) - r
        block = int(np.searchsorted(before, k, side="right")) - 1
        at = block * BLOCK % PART // 8
        bits = np.unpackbits(self.part(level, block * BLOCK)[at : at + BLOCK // 8], bitorder="little")
        return block * BLOCK + int(np.flatnonzero(bits[: self.n - block * BLOCK] == one)[k - int(before[block])])

    def select(self, token: int, k: int) -> int:
        """The position of the k-th (from 0) occurrence of an id."""
        a, b = self.span(token)
        if not 0 <= k < b - a:
            raise IndexError(k)
        code, i = int(np.searchsorted(self.alphabet, token)), a + k
        for level in range(self.levels - 1, -1, -1):
            one = code >> (self.levels - 1 - level) & 1
            i = self.place(level, i - self.zeros[level] if one else i, one)
        return i

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, k) for k in range(self.count(token))]

    def tokens(self) -> np.ndarray:
        """All ids, in order: the levels undone from the last to the first."""
        x = np.zeros(self.n, np.uint16 if self.levels <= 16 else np.uint32)
        for level in range(self.levels - 1, -1, -1):
            ones = np.unpackbits(self.plane(level), count=self.n, bitorder="little").view(bool)
            z, up = self.zeros[level], np.empty_like(x)
            up[~ones] = x[:z]
            up[ones] = x[z:] | x.dtype.type(1 << (self.levels - 1 - level))
            x = up
        return self.alphabet[x] if self.n else np.zeros(0, np.uint32)


# --- all shards -------------------------------------------------------------------------------------


def write_shards(docs: DataFrame, path: str, directory: str, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Write the documents' shards to ``directory``; a written table of shard, tokens, docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part = tokens(path), TaskContext.get().partitionId()
        doc_ids, ids, counts, held, number = [], [], [], 0, 0
        end = np.array([end_id], np.uint32)

        def flush() -> pa.RecordBatch:
            name = f"part-{part:06d}-{number:06d}"
            all_ids = np.concatenate([x for pair in ids for x in (pair, end)])
            put(directory, f"{name}.wm", build(np.array(doc_ids, np.int64), np.array(counts), all_ids, name))
            row = [name], [len(all_ids)], [len(doc_ids)]
            return pa.RecordBatch.from_arrays([pa.array(v) for v in row], ["shard", "tokens", "docs"])

        for batch in slices(batches, "text", 8 << 20):
            for doc, x in zip(batch.column(0).to_pylist(), own.texts(batch.column(1))):
                doc_ids.append(NULL_ID if doc is None else doc)
                ids.append(x.astype(np.uint16) if len(x) and x.max() < 65536 else x)
                counts.append(len(x) + 1)
                held += len(x) + 1
                if held >= shard_tokens:
                    yield flush()
                    doc_ids, ids, counts, held, number = [], [], [], 0, number + 1
        if doc_ids:
            yield flush()

    key = F.col("doc_id").asc_nulls_last()
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    rows = rows.repartitionByRange(key, "h").sortWithinPartitions(key, "h", "text").drop("h")
    return written(rows.mapInArrow(run, "shard string, tokens long, docs long"), "shards")


def read_shards(shards: DataFrame, directory: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "content", 1):
            shard = Shard(batch.column(0)[0].as_py())
            ids, ends = shard.tokens().astype("<u4"), np.cumsum(shard.counts, dtype=np.int64)
            crcs = [zlib.crc32(ids[a:b]) for a, b in zip((ends - shard.counts).tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([shard.name] * len(ends), pa.string()),
                    pa.array(shard.doc_ids, mask=shard.doc_ids == NULL_ID),
                    pa.array(ends - shard.counts),
                    pa.array(shard.counts.astype(np.int64)),
                    pa.array(crcs, pa.int64()),
                ],
                ["shard", "doc_id", "at", "n_tokens", "ids_crc32"],
            )

    # one row per shard: a running total in the order of their names, which is that of doc_ids
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = shards.select(F.col("shard").alias("own"), F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    files = contents(shards.sparkSession, directory, "*.wm").select("content")
    rows = files.mapInArrow(run, "shard string, doc_id long, at long, n_tokens long, ids_crc32 long")
    rows = rows.join(starts, rows["shard"] == starts["own"])  # and only what the table of shards names
    return rows.select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, path: str) -> DataFrame:
    """Write all documents' shards to the shared folder and read them back."""
    directory = fresh_dir(docs.sparkSession, "tokens")
    shards = write_shards(docs, path, directory)
    if not shards.head(1):
        return docs.sparkSession.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return read_shards(shards, directory)
