"""Quality rules: repetition rules and a hashed n-gram likelihood ratio.

Byte trigrams are hashed into BUCKETS cells. The raw multinomial counts every document of the corpus, the target
multinomial the trusted (labelled good) ones. A document's verdict is the mean over its trigrams of the logarithm of
target over raw probability, against one threshold for all documents.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stored, parts, slices, small, utf8

BUCKETS = 1 << 16
#: At most this share of the trusted documents may fall below the threshold.
TRUSTED_LOSS = 0.001
SMOOTH = 0.5

_SYMBOLS = b"#*$%&|<>"
_SPACE = b" \t\n\r\x0b\x0c"
_TAIL = bytes(range(0x80, 0xC0))


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one UTF-8 text."""
    words = text.split()
    chars = len(text.translate(None, _SPACE + _TAIL))
    symbols = len(text) - len(text.translate(None, _SYMBOLS))
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeat_words(words)


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words which the text holds twice or more."""
    n = len(words)
    if n < 4:
        return 0
    first: dict[bytes, int] = {}
    ids = np.fromiter(map(first.setdefault, words, itertools.count()), np.int64, n)
    pair = ids[:-1] * n + ids[1:]
    if n > 2_000_000:
        pair = np.unique(pair, return_inverse=True)[1]
    key = pair[:-1] * n + ids[2:]
    order = np.sort(key)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    again = np.isin(key, twice)
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k : n - 2 + k] |= again
    return int(covered.sum())


def features(text: bytes) -> np.ndarray:
    """The hashed trigrams of one text."""
    a = np.frombuffer(text, np.uint8).astype(np.uint32)
    if len(a) < 3:
        return np.zeros(0, np.uint32)
    return ((((a[:-2] << 8 | a[1:-1]) << 8) | a[2:]) * np.uint32(2654435761)) >> np.uint32(16)


def _counts(docs: DataFrame) -> np.ndarray:
    """Trigram counts over all the documents. One row a bucket and task is shuffled, BUCKETS rows reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in slices(batches):
            found = [features(t) for t in utf8(batch.column("text"))]
            if found:
                total += np.bincount(np.concatenate(found), minlength=BUCKETS)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["bucket", "n"])

    out = np.zeros(BUCKETS, np.int64)
    rows = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    got = rows.toArrow()
    out[got.column("bucket").to_numpy()] = got.column("n").to_numpy()
    return out


class Model:
    """The log ratio of each bucket and the threshold. ratio is None where no document is trusted."""

    def __init__(self, ratio: np.ndarray | None, threshold: float):
        self.ratio, self.threshold = ratio, threshold

    def score(self, text: bytes) -> float:
        """Mean log ratio of the trigrams; 0 for a text without any and without a trusted document."""
        if self.ratio is None:
            return 0.0
        f = features(text)
        return float(self.ratio[f].mean()) if len(f) else 0.0


def threshold(good: np.ndarray, bad: np.ndarray, loss: float = TRUSTED_LOSS) -> float:
    """The middle of the best cuts: it rejects the most bad documents among cuts that reject at most ``loss`` of the good."""
    if not len(good):
        return -np.inf
    good, bad = np.sort(good), np.sort(bad)
    top = good[int(loss * len(good))]  # a cut at or below rejects at most the allowed share
    below = bad[bad < top]
    return float((below[-1] + top) / 2) if len(below) else float(top - abs(top) - 0.05)


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Counts over all documents; target counts and threshold from all labelled documents.

    Labels that are null or have no document count for nothing. Without trusted documents the model keeps everything.
    """
    each = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where("doc_id is not null and quality in (0, 1)").dropDuplicates(["doc_id"])
    ids = Stored(each, "labelled")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    sample = texts.join(small(ids), "doc_id").select("text", "quality")
    target = _counts(sample.where("quality = 1"))
    if not target.sum():
        return Model(None, -np.inf)
    raw = _counts(docs)
    p, q = (target + SMOOTH) / (target.sum() + SMOOTH * BUCKETS), (raw + SMOOTH) / (raw.sum() + SMOOTH * BUCKETS)
    model = Model(np.log(p / q), 0.0)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            s = [(model.score(t), base_failed(*base_counts(t))) for t in utf8(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("quality"), pa.array([x for x, _ in s], pa.float64()), pa.array([f for _, f in s], pa.bool_())], ["quality", "score", "failed"])

    scores = Stored(sample.mapInArrow(scored, "quality int, score double, failed boolean").where("not failed").select("quality", "score"), "labelled-scores")
    model.threshold = cut(scores.df)
    scores.drop(), ids.drop()
    return model


def cut(scores: DataFrame, loss: float = TRUSTED_LOSS) -> float:
    """threshold() of a table (quality, score); a row each comes to the driver."""
    good = scores.where("quality = 1")
    n = good.count()
    if not n:
        return -np.inf
    top = good.orderBy("score").limit(int(loss * n) + 1).agg(F.max("score")).first()[0]
    below = scores.where((F.col("quality") == 0) & (F.col("score") < top)).agg(F.max("score")).first()[0]
    return float((below + top) / 2) if below is not None else float(top - abs(top) - 0.05)


def base_failed(n_words: int, word_chars: int, n_symbols: int, n_dup_lines: int, n_repeat_words: int) -> bool:
    return n_words < 50 or 100 * n_repeat_words > 50 * n_words


RULES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, score double, kept boolean"


def judge(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and the columns RULES for every document.

    A null text has no words and so fails. Repeated rows get a verdict each; an empty table gives an empty result;
    other columns are not read. Very long texts are judged whole; a score at the threshold is kept.
    """
    names = ["doc_id", *(c.split()[0] for c in RULES.split(", "))]
    kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for t in utf8(batch.column("text")):
                counts = base_counts(t)
                failed, s = base_failed(*counts), shared.value.score(t)
                rows.append((*counts, failed, s, not failed and s >= shared.value.threshold))
            cols = list(zip(*rows, strict=True)) if rows else [()] * 8
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True))], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id long, {RULES}")


def keep(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that pass the rules, with all their columns. A null text fails."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("boolean")
    def passes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            yield pa.array([not base_failed(*base_counts(t)) and shared.value.score(t) >= shared.value.threshold for part in parts(column) for t in utf8(part)], pa.bool_())

    return docs.where(passes(F.col("text").cast("string")))
