"""Multilingual mixture inference: which languages a document is in, and in what proportions.

The model is one table of log-likelihoods of character trigrams (hashed to ``BUCKETS``) per language, from a
bounded sample of labelled rows. A document's words, with their likelihood under each language, are the
observations of a mixture; expectation-maximisation estimates its proportions. Languages, in order of
proportion, enter the document's set while the penalised log-likelihood (a penalty per language that grows
with the log of the number of words) improves.

The background, for words of no learned language, is a further component of a mixture of its own. It gives a
trigram ``POOLED`` times its mean likelihood over the languages, and a floor, the geometric mean of an even
share and the largest likelihood that a language gives a trigram it never showed. So trigrams that a language
showed speak for it, those that none showed for the background, in any amount of labelled text. A document is
``und`` where the background's proportion is over half and it alone explains the text better than each word's
best language, by the penalty of a language for the words that are left (so a learned language's new words do
not reject a text that has its known ones);
elsewhere proportions are of the learned part.

Edge cases: null text, or text with no letter, is ``und`` with score 0 and no languages; without labelled
rows every document is ``und``; rows labelled null or with null text teach nothing; repeated rows and extra
columns change nothing. Long texts are read whole, in pieces of ``LONG`` characters that end where a word does (a
word longer than that is cut), piece by piece for every round, so that memory does not grow with them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.llm.common import slices

BUCKETS = 1 << 15
#: The bound of the sample: about this many labelled rows of each language, picked by a hash of their ids.
FIT_DOCS = 1500
#: Up to this many languages a slice of texts is 1 MB; with more it is smaller by as much, so that memory is bounded.
FULL_SLICE = 256
#: Log-likelihood that a further language must add, for each unit of log(words + 1).
PENALTY = 6.0
UNKNOWN = "und"
#: The weight, in the background, of the languages' mean likelihood (less where the floor leaves less of 1).
POOLED = 1 / 3
#: Rounds of expectation-maximisation: from an even start, and from the leading languages of a set.
ROUNDS = 6
SET_ROUNDS = 4
#: Texts of more characters are gone through in pieces, as many again for more languages than FULL_SLICE.
LONG = 4 << 20

_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """Whether a code point is a letter, as a table made once per process."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters


def lowered(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all texts, each ended by a newline, in lower case, and where each text ends."""
    low = [(t or "").lower() + "\n" for t in texts]
    points = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
    return points, np.cumsum(np.fromiter(map(len, low), np.int64, len(low)))


def grams(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of letters, the bucket of the trigram around each, and which of them start a word."""
    is_letter = letters()[points]
    c = np.where(is_letter, points, 0).astype(np.uint32)
    at = np.flatnonzero(is_letter)
    before = np.concatenate([np.zeros(1, np.uint32), c[:-1]])
    after = np.concatenate([c[1:], np.zeros(1, np.uint32)])
    mixed = before[at] * np.uint32(0x9E3779B1) + c[at] * np.uint32(0x85EBCA77) + after[at] * np.uint32(0xC2B2AE3D)
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0x2C1B3C6D)
    return at, (mixed >> np.uint32(32 - 15)).astype(np.int32), before[at] == 0


def fit(labelled: DataFrame, fit_docs: int = FIT_DOCS) -> tuple[list[str], np.ndarray]:
    """The learned languages, in order, and their table of log-likelihoods (BUCKETS x languages, the background last).

    The sample is every labelled row whose hashed id is below fit_docs over the language's rows.
    """
    known = labelled.where("lang IS NOT NULL AND text IS NOT NULL")
    counts = known.groupBy("lang").count().collect()  # a row per language, all of which are learned
    if not counts:
        return [], np.zeros((BUCKETS, 0), np.float32)
    langs = sorted(r["lang"] for r in counts)
    share = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(1.0, fit_docs / r["count"]))])
    luck = (F.xxhash64(F.lit("fit"), F.col("doc_id")).bitwiseAND(F.lit((1 << 52) - 1))).cast("double") / float(1 << 52)
    sample = known.where(luck < F.try_element_at(share, F.col("lang"))).select("lang", F.col("text").cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in slices(batches, "text", 1 << 20):
            names = batch.column(0).to_pylist()
            points, ends = lowered(batch.column(1).to_pylist())
            at, bucket, _ = grams(points)
            owner = np.searchsorted(ends, at, side="right")
            for name in set(names):
                own = np.array([x == name for x in names])[owner]
                totals[name] = totals.get(name, 0) + np.bincount(bucket[own], minlength=BUCKETS)
        for name, n in totals.items():
            full = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(full)), pa.array(full), pa.array(n[full])], ["lang", "bucket", "n"])

    rows = sample.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = rows.toPandas()  # at most languages x BUCKETS rows
    table = np.full((BUCKETS, len(langs)), 0.1)
    for i, lang in enumerate(langs):
        own = found[found["lang"] == lang]
        table[own["bucket"].to_numpy(), i] += own["n"].to_numpy()
    table /= table.sum(axis=0)
    floor = np.sqrt(table.min(axis=0).max() / BUCKETS)
    background = min(POOLED, 1 - floor * BUCKETS) * table.mean(axis=1, keepdims=True) + floor
    return langs, np.log(np.hstack([table, background])).astype(np.float32)


def em(like: np.ndarray, starts: np.ndarray, counts: np.ndarray, share: np.ndarray, rounds: int) -> np.ndarray:
    """Proportions (documents x languages) after some rounds; like: likelihoods of each word, scaled to a maximum of 1."""
    for _ in range(rounds):
        part = like * np.repeat(share, counts, axis=0)
        part /= part.sum(axis=1, keepdims=True)
        share = np.add.reduceat(part, starts, axis=0) / counts[:, None]
    return share


def word_logs(texts: list[str | None], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-likelihoods of every word (words x languages, the background last), and the text each is of."""
    points, ends = lowered(texts)
    at, bucket, first = grams(points)
    heads = np.flatnonzero(first)
    logs = np.empty((len(heads), table.shape[1]), np.float32)
    step = max(1000, 500_000 // table.shape[1])
    for a in range(0, len(heads), step):  # words by words, so that the gathered rows stay small
        to = heads[a + step] if a + step < len(heads) else len(bucket)
        logs[a : a + step] = np.add.reduceat(table[bucket[heads[a] : to]], heads[a : a + step] - heads[a], axis=0)
    return logs, np.searchsorted(ends, at[heads], side="right")


def scaled(logs: np.ndarray) -> np.ndarray:
    """Likelihoods with a maximum of 1 for each word."""
    return np.maximum(np.exp(logs - logs.max(axis=1, keepdims=True)), np.float32(1e-30))


def infer_long(text: str, table: np.ndarray, penalty: float = PENALTY, long: int = LONG) -> tuple[np.ndarray, np.ndarray, float]:
    """``infer`` of one text, in pieces: the chosen languages' positions, their proportions, the background's."""
    cuts = [0]
    while cuts[-1] < len(text):
        at = min(cuts[-1] + long, len(text))
        while at < len(text) and at < cuts[-1] + 2 * long and text[at].isalpha():
            at += 1
        cuts.append(at)

    def pieces() -> Iterator[np.ndarray]:
        for a, b in zip(cuts[:-1], cuts[1:]):
            logs, _ = word_logs([text[a:b]], table)
            if len(logs):
                yield logs

    def rounds(share: np.ndarray, of, n: int) -> np.ndarray:
        for _ in range(n):
            total = np.zeros(len(share))
            for logs in pieces():
                part = of(logs) * share.astype(np.float32)
                total += (part / part.sum(axis=1, keepdims=True)).sum(axis=0, dtype=np.float64)
            share = total / n_words
        return share

    n_langs = table.shape[1] - 1
    n_words, better = 0, 0.0
    for logs in pieces():
        n_words += len(logs)
        better += float((logs[:, -1] - logs[:, :-1].max(axis=1)).sum(dtype=np.float64))
    if not n_words:
        return np.zeros(0, np.int64), np.zeros(0), 1.0
    unknown = float(rounds(np.full(n_langs + 1, 1 / (n_langs + 1)), scaled, ROUNDS)[-1])
    if better <= penalty * np.log((1 - unknown) * n_words + 1):
        unknown = 0.0
    learned = lambda logs: scaled(logs[:, :-1])
    share = rounds(np.full(n_langs, 1 / n_langs), learned, ROUNDS)
    order = np.argsort(-share, kind="stable")
    best, value, size = None, -np.inf, 0
    for more in range(1, n_langs + 1):
        if more > 1 and share[order[more - 1]] <= 0.01:
            break
        p = np.zeros(n_langs)
        p[order[:more]] = np.maximum(share[order[:more]], 1e-6)
        p = rounds(p / p.sum(), learned, SET_ROUNDS if more > 1 else 0)
        fit = sum(float(np.log((learned(logs) * p.astype(np.float32)).sum(axis=1, dtype=np.float64)).sum()) for logs in pieces())
        fit -= penalty * more * np.log(n_words + 1)
        if fit <= value:
            break
        best, value, size = p, fit, more
    own = np.argsort(-best, kind="stable")[:size]
    return own, best[own], unknown


def infer(texts: list[str | None], table: np.ndarray, penalty: float = PENALTY) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """For each text the chosen languages' positions, largest proportion first, their proportions, and the background's.

    The background's is of the whole text, 1 without letters and 0 where it does not explain the text better
    than the words' best languages; the languages' are of the learned part.
    """
    n = len(texts)
    picked, shares, unknown = [np.zeros(0, np.int64)] * n, [np.zeros(0)] * n, np.ones(n)
    n_langs = table.shape[1] - 1
    if n_langs < 1:
        return picked, shares, unknown
    long = [i for i, t in enumerate(texts) if len(t or "") > LONG * FULL_SLICE // max(FULL_SLICE, n_langs)]
    for i in long:
        picked[i], shares[i], unknown[i] = infer_long(texts[i], table, penalty, LONG * FULL_SLICE // max(FULL_SLICE, n_langs))
    if long:
        texts = [None if i in set(long) else t for i, t in enumerate(texts)]
    logs, owner = word_logs(texts, table)
    if not len(logs):
        return picked, shares, unknown
    starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    docs, counts = owner[starts], np.diff(np.append(starts, len(owner)))

    everything = np.full((len(docs), n_langs + 1), 1 / (n_langs + 1), np.float32)
    unknown[docs] = em(scaled(logs), starts, counts, everything, ROUNDS)[:, -1]
    better = np.add.reduceat((logs[:, -1] - logs[:, :-1].max(axis=1)).astype(np.float64), starts)
    unknown[docs[better <= penalty * np.log((1 - unknown[docs]) * counts + 1)]] = 0
    like = scaled(logs[:, :-1])

    share = em(like, starts, counts, np.full((len(docs), n_langs), 1 / n_langs, np.float32), ROUNDS)
    order = np.argsort(-share, axis=1, kind="stable")
    rank = np.argsort(order, axis=1, kind="stable")

    def fitted(sel: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Proportions and penalised log-likelihood of documents ``sel`` with their ``size`` leading languages."""
        words = np.repeat(sel, counts)
        own_counts = counts[sel]
        own_starts = np.concatenate([[0], np.cumsum(own_counts)[:-1]])
        begun = np.where(rank[sel] < size, np.maximum(share[sel], 1e-6), 0).astype(np.float32)
        begun /= begun.sum(axis=1, keepdims=True)
        own = like[words]
        p = em(own, own_starts, own_counts, begun, SET_ROUNDS) if size > 1 else begun
        fit = np.add.reduceat(np.log((own * np.repeat(p, own_counts, axis=0)).sum(axis=1, dtype=np.float64)), own_starts)
        return p, fit - penalty * size * np.log(own_counts + 1)

    everyone = np.ones(len(docs), bool)
    best, value = fitted(everyone, 1)
    size = np.ones(len(docs), np.int64)
    going = everyone
    for more in range(2, n_langs + 1):
        going = going & (size == more - 1) & (np.take_along_axis(share, order[:, more - 1 : more], 1)[:, 0] > 0.01)
        if not going.any():
            break
        p, v = fitted(going, more)
        better = v > value[going]
        rows = np.flatnonzero(going)[better]
        best[rows], value[rows], size[rows] = p[better], v[better], more
    for i, d in enumerate(docs.tolist()):
        p = best[i]
        own = np.argsort(-p, kind="stable")[: size[i]]
        picked[d], shares[d] = own, p[own].astype(float)
    return picked, shares, unknown


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], carry: list[str] | None = None, most_unknown: float = 0.5) -> DataFrame:
    """doc_id, lang_pred, score (its proportion), languages and proportions, one row per row of ``docs``.

    ``carry`` names further columns of ``docs`` to keep, ahead of those; documents of which more than
    ``most_unknown`` is background are ``und``.
    """
    langs, table = model
    shared = docs.sparkSession.sparkContext.broadcast((langs, table))  # BUCKETS x languages
    carry = ["doc_id"] if carry is None else carry
    rows = docs.select(*[F.col(f"`{c}`") for c in carry], F.col("text").cast("string").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, table = shared.value
        names = np.array([*langs, UNKNOWN], object)
        for batch in slices(batches, "__text", (1 << 20) * FULL_SLICE // max(FULL_SLICE, len(langs))):
            picked, shares, unknown = infer(batch.column(len(carry)).to_pylist(), table)
            for i in np.flatnonzero(unknown > most_unknown):
                picked[i] = shares[i] = ()
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[: len(carry)],
                    pa.array([names[p[0]] if len(p) else UNKNOWN for p in picked], pa.string()),
                    pa.array([min(1.0, float(s[0])) if len(s) else 0.0 for s in shares], pa.float64()),
                    pa.array([[names[i] for i in p] for p in picked], pa.list_(pa.string())),
                    pa.array([list(s) for s in shares], pa.list_(pa.float64())),
                ],
                names=[*carry, "lang_pred", "score", "languages", "proportions"],
            )

    schema = rows.drop("__text").schema
    for name, kind in (("lang_pred", T.StringType()), ("score", T.DoubleType()), ("languages", T.ArrayType(T.StringType())), ("proportions", T.ArrayType(T.DoubleType()))):
        schema = schema.add(name, kind)
    return rows.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """Whether the fold of a doc_id (crc32 of its text, mod 4) is 2; rows without an id are learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def known_language(docs: DataFrame, least: float = 0.5, fit_docs: int = FIT_DOCS) -> DataFrame:
    """The rows of ``docs`` in languages of its labelled rows, together with at least ``least`` of the text."""
    model = fit(docs, fit_docs)
    names = docs.columns
    safe = docs.toDF(*[f"__c{i}" for i in range(len(names))])
    text = F.col(f"__c{names.index('text')}").cast("string")
    rows = identify(safe.withColumn("text", text), model, carry=safe.columns, most_unknown=1 - least)
    return rows.where(F.col("lang_pred") != UNKNOWN).select(*safe.columns).toDF(*names)
