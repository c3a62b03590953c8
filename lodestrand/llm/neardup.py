"""Near-duplicate documents by DartMinHash.

A document is a weighted set of five-word shingles. Every shingle has a stream of darts, made from its hash alone: a
dart has a rank, a weight within a dyadic layer, and a coordinate. Darts land at the unit rate on the region below the
shingle's weight, and a document keeps at each coordinate the dart of least rank. Two documents agree at a coordinate
with the probability of their weighted Jaccard similarity. The work is about K log K darts a document, however many
shingles it has. Coordinates in bands make bucket keys; candidate pairs are verified on the shingle sets themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stored, slices, small, utf8
from .links import attach, classes

WORDS = 5
SIMILARITY = 0.8
#: BANDS bands of ROWS coordinates: a pair at similarity 0.8 shares a band with probability 1 - 5e-5.
BANDS, ROWS = 25, 5
#: Cells in which the frequency of shingles is counted where it orders them.
CELLS = 1 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _unit(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def signature(elements: np.ndarray, weights: np.ndarray | None = None, k: int = BANDS * ROWS) -> np.ndarray:
    """The k least darts of one weighted set: elements are distinct uint64 hashes, weights positive (1 if not given).

    Darts of an element fall as a Poisson process in rank, with rate k times the width of the layer: layer 0 holds the
    weights up to 1, layer j those in (2^(j-1), 2^j]. Ranks up to t / total weight, t = ln k + 2, fill nearly every
    coordinate; while one is empty the bound doubles.
    """
    if not len(elements):
        return np.zeros(0, np.uint64)
    w = np.ones(len(elements)) if weights is None else np.asarray(weights, np.float64)
    layers = np.maximum(0, np.ceil(np.log2(w))).astype(np.int64)
    item, layer = [np.arange(len(w))], [np.zeros(len(w), np.int64)]
    for j in range(1, int(layers.max()) + 1):
        item.append(np.flatnonzero(layers >= j)), layer.append(np.full(len(item[-1]), j))
    item, layer = np.concatenate(item), np.concatenate(layer)
    low = np.where(layer == 0, 0.0, 2.0 ** (layer - 1))
    width = np.where(layer == 0, 1.0, low)
    seed = _mixed(elements[item] + _MIX * (layer.astype(np.uint64) + np.uint64(1)))
    bound = (np.log(k) + 2) / w.sum()
    with np.errstate(over="ignore"):
        while True:
            best, dart = np.full(k, np.inf), np.zeros(k, np.uint64)
            live, rank, done = np.arange(len(item)), np.zeros(len(item)), 0
            while len(live):
                # a block of arrivals for every live stream, about as many as fall below the bound
                block = int(max(2, min(1.1 * k * bound * width[live].max() + 4, 1 + 2_000_000 // len(live))))
                m = np.arange(done + 1, done + block + 1, dtype=np.uint64)
                h = _mixed(seed[live][:, None] + _MIX * m)
                ranks = rank[:, None] - np.cumsum(np.log(_unit(h)), 1) / (k * width[live][:, None])
                i, j = np.nonzero(ranks <= bound)
                name, r, of = h[i, j], ranks[i, j], live[i]
                at = _mixed(name ^ _MIX)
                hit = low[of] + width[of] * _unit(_mixed(at ^ _MIX)) <= w[item[of]]
                place, r, name = (at[hit] % np.uint64(k)).astype(np.int64), r[hit], name[hit]
                np.minimum.at(best, place, r)
                first = r == best[place]
                dart[place[first]] = name[first]
                more = ranks[:, -1] <= bound
                live, rank, done = live[more], ranks[more, -1], done + block
            if np.isfinite(best).all():
                return dart
            bound *= 2


_CACHE: dict[bytes, int] = {}


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words, from a bounded cache."""
    if len(_CACHE) > 600_000:
        _CACHE.clear()
    get = _CACHE.get
    out = list(map(get, words))
    if None in out:
        for i, x in enumerate(out):
            if x is None:
                out[i] = _CACHE[words[i]] = int.from_bytes(blake2b(words[i], digest_size=8).digest(), "little")
    return np.array(out, np.uint64)


def shingles(words: list[bytes], size: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words; of the whole text if it is shorter; none of no words."""
    if not words:
        return np.zeros(0, np.uint64)
    h = word_hashes(words)
    n = max(1, len(h) - size + 1)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(min(size, len(h))):
            out = _mixed(out * _MIX + h[j : j + n] + np.uint64(1))
    return np.unique(out)


def words_of(text: bytes) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return text.lower().split()


def _digest(words: list[bytes]) -> bytes:
    """Names a sequence of words; equal sequences are one node of the link graph."""
    return blake2b(b" ".join(words), digest_size=16).digest()


def sketch(docs: DataFrame) -> DataFrame:
    """doc_id, digest, bands (array of 64-bit keys) for every document; digest and bands are null without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            names, bands = [], []
            for t in utf8(batch.column("text")):
                w = words_of(t)
                names.append(_digest(w) if w else None)
                if not w:
                    bands.append(None)
                    continue
                s, key = signature(shingles(w)).reshape(BANDS, ROWS), np.arange(BANDS, dtype=np.uint64)
                for j in range(ROWS):
                    key = _mixed(key * _MIX + s[:, j])
                bands.append(key.view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], ["doc_id", "digest", "bands"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, digest binary, bands array<long>")


def _shingle_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """node, shingles (sorted 64-bit) of one text for each wanted node (id, node: its digest, doc), named by its id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = [words_of(t) for t in utf8(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([pa.array([_digest(w) for w in words], pa.binary()), pa.array([shingles(w).tobytes() for w in words], pa.binary())], ["name", "shingles"])

    # one document of each wanted digest: found by doc_id, so that only these texts move
    ids = Stored(wanted.select("doc").distinct(), "wanted-documents")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.join(small(ids), texts["doc_id"].eqNullSafe(ids.df["doc"]), "left_semi")
    sets = texts.select("text").mapInArrow(run, "name binary, shingles binary")
    return sets.join(wanted.select("id", F.col("node").alias("name")), "name").select(F.col("id").alias("node"), "shingles").dropDuplicates(["node"])


def _similar(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    @F.arrow_udf("double")
    def jaccard(a: pa.Array, b: pa.Array) -> pa.Array:
        out = []
        for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            if min(len(x), len(y)) < least * max(len(x), len(y)):
                out.append(0.0)
                continue
            both = len(np.intersect1d(x, y, assume_unique=True))
            out.append(both / (len(x) + len(y) - both))
        return pa.array(out, pa.float64())

    return attach(pairs, sets, ["shingles"]).withColumn("similarity", jaccard("a_shingles", "b_shingles")).where(F.col("similarity") >= least).select("a", "b", "similarity")


def _by_leader(mixed: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) of nodes of different classes in a bucket that can be similar, by their differences from its leader.

    Let F be the shingles that only one of a set and the leader's has, s their number, n the set's size. The sets x and y
    differ in the shingles in which their F differ, and they are similar only if these number at most r (nx + ny), with
    r = (1 - least) / (1 + least). So with sy <= sx they share t = (sx + sy - r (nx + ny)) / 2 shingles of F at least, and
    one of the first s - t + 1 of each under any common order. A node outside the leader's class is not similar to the
    leader, so its s is over r (n + n of the leader), which makes t large. The order is by rarity, counted in cells: most
    edits are rare, so the variants of one text meet only where they share an edit.
    """
    rows = mixed.select(F.col("leader").alias("a"), F.col("node").alias("b"), "component", (F.col("component") != F.col("lead")).alias("rest")).distinct().where("a != b")
    r = (1 - least) / (1 + least)

    def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "b_shingles"):
            out, n, m = [], [], []
            salts = _mixed(batch.column("a").to_numpy().view(np.uint64) + _MIX)
            for salt, x, y in zip(salts, batch.column("a_shingles").to_pylist(), batch.column("b_shingles").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                out.append(_mixed(np.setxor1d(x, y, assume_unique=True) ^ salt).tobytes())
                n.append(len(y)), m.append(len(x))
            yield pa.RecordBatch.from_arrays([batch.column("b"), batch.column("component"), batch.column("rest"), pa.array(n, pa.int64()), pa.array(m, pa.int64()), pa.array(out, pa.binary())], ["node", "component", "rest", "n", "m", "diff"])

    diffs = Stored(attach(rows, sets, ["shingles"]).select("a", "b", "component", "rest", "a_shingles", "b_shingles").mapInArrow(differ, "node long, component long, rest boolean, n long, m long, diff binary"), "differences")
    cells = lambda x: (x % np.uint64(CELLS)).astype(np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS, np.int64)
        for batch in batches:
            for x in batch.column("diff").to_pylist():
                np.add.at(total, cells(np.frombuffer(x, np.uint64)), 1)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["cell", "n"])

    got = diffs.df.select("diff").mapInArrow(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()  # CELLS rows at most
    often = np.zeros(CELLS, np.int64)
    often[got.column("cell").to_numpy()] = got.column("n").to_numpy()
    shared = mixed.sparkSession.sparkContext.broadcast(often)

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "diff"):
            size, far, near = [], [], []
            for x, n, m, rest in zip(*(batch.column(c).to_pylist() for c in ("diff", "n", "m", "rest")), strict=True):
                x = np.frombuffer(x, np.uint64)
                s, x = len(x), x[np.lexsort((x, shared.value[cells(x)]))].view(np.int64)
                both = r * (n + n / least)
                t = max(1, np.ceil(s - both - 1e-9))  # as the one with more differences
                u = max(1, np.ceil(s - both / 2 - 1e-9), np.ceil((s + r * (m - n * (1 / least if rest else 1))) / 2 - 1e-9))  # as the other
                size.append(s), far.append(x[: max(0, int(s - t + 1))]), near.append(x[: max(0, int(s - u + 1))])
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("node", "component", "rest", "n")), pa.array(size, pa.int64()), pa.array(far, kind), pa.array(near, kind)], ["node", "component", "rest", "n", "s", "far", "near"])

    found = Stored(diffs.df.mapInArrow(heads, "node long, component long, rest boolean, n long, s long, far array<long>, near array<long>"), "heads")
    diffs.drop()
    one = lambda use, side: found.df.select(F.posexplode(use).alias(f"at_{side}", "shingle"), *[F.col(c).alias(f"{c}_{side}") for c in ("node", "component", "rest", "n", "s")])
    t = f"greatest(1, ceil((s_x + s_y - {r} * (n_x + n_y)) / 2 - 1e-9))"
    can = (
        f"at_x <= s_x - {t} and at_y <= s_y - {t} and "
        "component_x != component_y and (rest_x or rest_y) and s_y <= s_x "
        f"and least(n_x, n_y) >= {least} * greatest(n_x, n_y) - 1e-9 and s_x - s_y <= {r} * (n_x + n_y) + 1e-9"
    )
    both = one("far", "x").join(one("near", "y"), "shingle").where(can)
    return both.select(F.least("node_x", "node_y").alias("a"), F.greatest("node_x", "node_y").alias("b")).distinct()


def groups(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One row for each document: doc_id, class_id (least doc_id of its class), class_size (rows), kept.

    A class is a connected component of documents whose sets of five-word shingles have a Jaccard similarity of at least
    ``least``; texts of the same words are always in one class. A text of fewer than five words is one shingle. Null,
    empty and blank texts are alone in their classes and kept. Of the rows with the least doc_id of a class all are kept,
    so rows that repeat an id count as one document; rows without a doc_id are kept. An empty table gives an empty
    result; other columns are not read. Very long texts count with all their shingles.
    """
    signed = Stored(sketch(docs), "sketch")
    worded = signed.df.where("digest is not null")

    def load(names: DataFrame) -> Stored:
        return Stored(_shingle_sets(docs, names), "shingles")

    def verify(pairs: DataFrame, sets: DataFrame) -> Stored:
        return Stored(_similar(pairs, sets, least).select("a", "b"), "links")

    rows = worded.select(F.col("digest").alias("node"), F.col("bands").alias("buckets"), F.col("doc_id").alias("doc"))
    found = Stored(classes(rows, load, verify, narrow=lambda mixed, sets: _by_leader(mixed, sets, least)), "linked-documents")
    each = worded.groupBy("digest").agg(F.min("doc_id").alias("any_id"), F.count("*").alias("rows"))
    of = Stored(each.join(small(found).withColumnRenamed("node", "digest"), "digest", "left"), "nodes")
    sizes = of.df.where("component is not null").groupBy("component").agg(F.min("any_id").alias("class_id"), F.sum("rows").alias("class_size"))
    linked = of.df.where("component is not null").join(sizes, "component").select("digest", "class_id", "class_size")
    alone = of.df.where("component is null").select("digest", F.col("any_id").alias("class_id"), F.col("rows").alias("class_size"))
    label = Stored(linked.unionByName(alone), "classes")
    of.drop(), found.drop()
    out = signed.df.select("doc_id", "digest").join(label.df, "digest", "left")
    alone = F.col("digest").isNull()
    return out.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.lit(1)).otherwise(F.col("class_size")).cast("long").alias("class_size"),
        F.coalesce(alone | (F.col("doc_id") == F.col("class_id")), F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The documents with one of each class, all columns. Cases as in groups(); an id goes if none of its rows is kept."""
    gone = Stored(groups(docs, least).where("doc_id is not null").groupBy(F.col("doc_id").alias("gone")).agg(F.max("kept").alias("kept")).where("not kept").select("gone"), "gone")
    return docs.join(small(gone), docs["doc_id"].cast("long") == gone.df["gone"], "left_anti")
