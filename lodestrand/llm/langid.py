"""Language ID by mixture inference.

Each language has a multinomial over hashed byte trigrams of lower-cased words. A document is a mixture: every word
comes from one language with that language's proportion. Expectation-maximisation estimates the proportions; languages
leave the set while the penalised likelihood does not fall.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, utf8

BUCKETS = 1 << 15
SMOOTH = 0.5
ROUNDS = 30
#: The price of a language in the set, times the logarithm of the number of words.
PENALTY = 1.0
CACHE_WORDS = 600_000
UNKNOWN = "und"

#: ASCII that is not a letter separates words; every byte from 128 on counts as part of a letter.
_LETTERS = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.decode().lower().encode().translate(_LETTERS).split()


def _trigrams(joined: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams of words joined by single spaces, and a mask of those that don't span two words."""
    a = np.frombuffer(joined, np.uint8).astype(np.uint32)
    h = ((((a[:-2] << 8 | a[1:-1]) << 8) | a[2:]) * np.uint32(2654435761)) >> np.uint32(17)
    return h, a[1:-1] != 32


def held_out(doc_id) -> bool:
    return doc_id is not None and crc32(str(doc_id).encode()) % 4 == 2


class Model:
    """Log probabilities (BUCKETS x languages) and the languages in sorted order."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        self.table = np.log((counts + SMOOTH) / (counts.sum(0) + SMOOTH * BUCKETS)).astype(np.float32) if languages else counts

    def start(self) -> None:
        """The word cache lives in the worker, not in what is broadcast."""
        self.rows: dict[bytes, int] = {}
        self.known = np.zeros((1024, len(self.languages)), np.float32)

    def likelihoods(self, texts: list[list[bytes]]) -> list[np.ndarray]:
        """For each list of words the log likelihood of each word in each language."""
        missing = list({w for ws in texts for w in ws if w not in self.rows})
        if len(self.rows) + len(missing) > CACHE_WORDS:
            self.start()
            missing = list({w for ws in texts for w in ws})
        if missing:
            h, own = _trigrams(b" " + b" ".join(missing) + b" ")
            begins = np.cumsum([0, *(len(w) + 1 for w in missing[:-1])])
            fresh = np.add.reduceat(self.table[h] * own[:, None], begins, axis=0)
            base = len(self.rows)
            if base + len(missing) > len(self.known):
                self.known = np.concatenate([self.known[:base], np.zeros((base + 2 * len(missing), self.known.shape[1]), np.float32)])
            self.known[base : base + len(missing)] = fresh
            self.rows.update(zip(missing, range(base, base + len(missing)), strict=True))
        return [self.known[np.fromiter(map(self.rows.__getitem__, ws), np.int64, len(ws))] for ws in texts]

    def infer(self, ll: np.ndarray) -> np.ndarray:
        """The proportions of the languages in a document; those outside the chosen set are 0."""
        n, k = ll.shape
        top = ll.max(1, keepdims=True)
        like = np.exp((ll - top).astype(np.float64))
        chosen = np.arange(k)
        part, value = _mixture(like, ROUNDS)
        while len(chosen) > 1:
            keep = part * n >= 1  # a language with less than one word goes at once
            if keep.all():
                keep[part.argmin()] = False
            elif not keep.any():
                keep[part.argmax()] = True
            fewer, below = _mixture(like[:, chosen[keep]], ROUNDS)
            gone = (~keep).sum()
            if below + PENALTY * gone * np.log(n + 1) < value:
                if gone == 1:
                    break
                keep = np.arange(len(chosen)) != part.argmin()  # not all of them at once: try the least alone
                fewer, below = _mixture(like[:, chosen[keep]], ROUNDS)
                if below + PENALTY * np.log(n + 1) < value:
                    break
            chosen, part, value = chosen[keep], fewer, below
        out = np.zeros(k)
        out[chosen] = part
        return out


def _mixture(like: np.ndarray, rounds: int) -> tuple[np.ndarray, float]:
    """EM over the proportions: (proportions, log likelihood)."""
    n, k = like.shape
    if k == 1:
        return np.ones(1), float(np.log(np.maximum(like[:, 0], 1e-300)).sum())
    part = np.full(k, 1 / k)
    for _ in range(rounds):
        total = like @ part
        np.maximum(total, 1e-300, out=total)
        after = part * ((1 / total) @ like) / n
        moved = np.abs(after - part).max()
        part = after
        if moved < 1e-3:
            break
    return part / part.sum(), float(np.log(np.maximum(like @ part, 1e-300)).sum())


def fit(docs: DataFrame) -> Model:
    """Counts the trigrams of all documents with a language whose crc32(doc_id) mod 4 is not 2, null ids included.

    BUCKETS counts a language reach the driver; a collection has few languages, and its lang values are their names.
    """
    train = docs.where("lang is not null and text is not null and (doc_id is null or crc32(cast(cast(doc_id as string) as binary)) % 4 != 2)").select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in slices(batches):
            by: dict[str, list[bytes]] = {}
            for t, lang in zip(utf8(batch.column("text")), batch.column("lang").to_pylist(), strict=True):
                by.setdefault(lang, []).extend(words_of(t))
            for lang, words in by.items():
                if words:
                    h, own = _trigrams(b" " + b" ".join(words) + b" ")
                    total[lang] = total.get(lang, 0) + np.bincount(h[own], minlength=BUCKETS)
        for lang, counts in total.items():
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.string()), pa.array(used.astype(np.int32)), pa.array(counts[used].astype(np.int64))], ["lang", "bucket", "n"])

    got = train.mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(set(got.column("lang").unique().to_pylist()))
    counts = np.zeros((BUCKETS, len(languages)))
    at = {x: i for i, x in enumerate(languages)}
    counts[got.column("bucket").to_numpy(), [at[x] for x in got.column("lang").to_pylist()]] = got.column("n").to_numpy()
    return Model(languages, counts)


PREDICTIONS = "doc_id long, held_out boolean, lang_pred string, score double, languages string"


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """One row for each document: doc_id, held_out, lang_pred, score (its proportion), languages (the chosen set, by proportion).

    ``und`` with score 0 if the text is null, has no letter, or nothing was learned. Repeated rows are predicted each; an
    empty table gives an empty result; very long texts count whole; of languages that score alike the first by name is
    given. lang, source and doc_id are not read for a prediction.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        if not hasattr(own, "rows"):
            own.start()
        for batch in slices(batches):
            ids = batch.column("doc_id").to_pylist()
            words = [words_of(t) if own.languages and _has_letter(t) else [] for t in utf8(batch.column("text"))]
            pred, score, sets = [], [], []
            for ll in own.likelihoods(words):
                if not len(ll):
                    pred.append(UNKNOWN), score.append(0.0), sets.append("")
                    continue
                part = own.infer(ll)
                best = int(part.argmax())
                pred.append(own.languages[best]), score.append(min(1.0, float(part[best])))
                sets.append(",".join(own.languages[i] for i in np.argsort(-part, kind="stable") if part[i] > 0))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(map(held_out, ids), pa.bool_()), pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(sets, pa.string())], [c.split()[0] for c in PREDICTIONS.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, PREDICTIONS)


def _has_letter(text: bytes) -> bool:
    return not text.translate(_LETTERS).isspace() and any(map(str.isalpha, text.decode()))
