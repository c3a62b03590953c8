"""Near-duplicates: signatures, groups of many variants, and the cases of the docstring."""

import random
import sys
from pathlib import Path

import numpy as np

sys.path.insert(0, str(Path(__file__).parent))
import brute

from lodestrand.llm import neardup


def test_signatures_estimate_weighted_jaccard():
    r = np.random.default_rng(4)
    for share in (0.3, 0.8):
        both = r.integers(0, 1 << 62, 200).astype(np.uint64)
        n = int(200 * share)
        a = np.concatenate([both[:n], r.integers(0, 1 << 62, (200 - n) // 2).astype(np.uint64)])
        b = np.concatenate([both[:n], r.integers(0, 1 << 62, (200 - n) - (200 - n) // 2).astype(np.uint64)])
        w = r.random(200) * 5 + 0.1
        x, y = neardup.signature(a, w[: len(a)], 2000), neardup.signature(b, np.concatenate([w[:n], w[len(a) :][: len(b) - n]])[: len(b)], 2000)
        wa, wb = dict(zip(a.tolist(), w[: len(a)], strict=True)), dict(zip(b.tolist(), np.concatenate([w[:n], w[len(a) :][: len(b) - n]])[: len(b)].tolist(), strict=True))
        keys = wa.keys() | wb.keys()
        true = sum(min(wa.get(k, 0), wb.get(k, 0)) for k in keys) / sum(max(wa.get(k, 0), wb.get(k, 0)) for k in keys)
        assert abs(np.mean(x == y) - true) < 0.05


def variants(n, edits, seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghijklmno") for _ in range(6))
    base = [word() for _ in range(120)]
    for _ in range(n):
        w = list(base)
        for _ in range(r.randint(0, edits)):
            k = r.randrange(len(w))
            w[k : k + 1] = r.choice([[word()], [], [w[k], word()]])
        yield " ".join(w)


def test_groups_of_variants_about_the_threshold(spark):
    texts = [*variants(130, 7, 1), *variants(60, 3, 2), *variants(40, 12, 3)]
    rows = list(enumerate(texts))
    got = {r.doc_id: r.class_id for r in neardup.groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()}
    assert got == brute.near_classes(rows)


def test_cases(spark):
    long = " ".join(f"word{i}" for i in range(60))
    rows = [(5, long, 1), (3, long.upper() + "\n", 2), (3, long.upper() + "\n", 2), (7, long.replace("word7", "other"), 3), (8, None, 4), (9, "", 5), (10, " \t", 6), (None, long, 7), (11, "two words", 8), (12, "Two  words", 9), (13, "three words here", 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest int")
    got = sorted((tuple(r) for r in neardup.groups(docs).collect()), key=repr)
    want = [(3, 3, 5, True), (3, 3, 5, True), (5, 3, 5, False), (7, 3, 5, False), (8, 8, 1, True), (9, 9, 1, True), (10, 10, 1, True), (None, 3, 5, True), (11, 11, 2, True), (12, 11, 2, False), (13, 13, 1, True)]
    assert got == sorted(want, key=repr)
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r.digest for r in kept.collect()) == [2, 2, 4, 5, 6, 7, 8, 10]
    assert neardup.groups(docs.limit(0)).count() == 0
