"""The registered queries over the whole small tables, against the plain versions in brute.py."""

import sys
from hashlib import sha256
from math import isclose, log10
from collections import Counter
from pathlib import Path
from zlib import crc32

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import brute

from lodestrand.llm import media, queries


@pytest.fixture(scope="module")
def docs(spark, sf):
    return {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


def by_id(df):
    rows = df.collect()
    out = {r.doc_id: r for r in rows}
    assert len(out) == len(rows)
    return out


def test_op1(spark, sf, docs):
    got = by_id(queries.op1_secrets(spark, sf))
    assert got.keys() == docs.keys()
    for d, r in got.items():
        assert (r.n_assign, r.n_access, r.n_hex, r.base_sha256) == brute.secrets(docs[d].text)
        base = [s for s in r.spans.split(",") if s and not s.startswith("random")]
        assert sha256(",".join(base).encode()).hexdigest() == r.base_sha256


def test_op2(spark, sf, docs):
    got = by_id(queries.op2_licenses(spark, sf))
    assert got.keys() == docs.keys()
    for d, r in got.items():
        assert (r.labels, round(r.score, 9)) == brute.license_labels(docs[d].text)
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute.licenses(docs[d].text)
        assert 0 <= r.score <= 1
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert r.labels == ",".join(sorted(set(r.labels.split(","))))


def test_op3(spark, sf, docs):
    got = by_id(queries.op3_lm_scores(spark, sf))
    tokens = {d: [*(w.translate(brute.UPPER) for w in brute.words(r.text)), None] for d, r in docs.items()}
    c = Counter(w for d, ws in tokens.items() if not brute.held_out(d, 7) for w in ws)
    n, v = sum(c.values()), len(c)
    for d, ws in tokens.items():
        r = got[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (brute.held_out(d, 7), len(ws), sum(w in c for w in ws), n)
        assert isclose(r.base_score, sum(log10((c[w] + 1) / (n + v + 1)) for w in ws), rel_tol=1e-9)
        assert r.score < 0


def test_op4(spark, sf, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = queries.op4_packing(spark, sf).collect()
    ids = {d: np.array([*e.ids, 0], "<u4") for d, e in zip(docs, t.encode_batch([r.text or "" for r in docs.values()], add_special_tokens=False), strict=True)}
    at = dict.fromkeys(docs, 0)
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        own = ids[r.doc_id]
        assert r.start == at[r.doc_id] and r.length > 0 and r.doc_tokens == len(own)
        assert r.ids_crc32 == crc32(own[r.start : r.start + r.length].tobytes())
        at[r.doc_id] += r.length
    assert at == {d: len(x) for d, x in ids.items()}
    length: dict = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == length.get(r.sequence_id, 0)
        length[r.sequence_id] = r.offset + r.length
    assert max(length.values()) <= 1024
    padded = sum(n if n & (n - 1) == 0 else 1024 for n in length.values())
    assert padded - sum(length.values()) == 0


def test_op5(spark, sf, docs):
    import base64

    import public_tokenizers as P
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    e = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = by_id(queries.op5_byte_bpe(spark, sf))
    for d, r in docs.items():
        ids = e.encode_ordinary(r.text or "")
        assert (got[d].n_tokens, got[d].ids_sha256, got[d].decoded_sha256) == (len(ids), sha256(" ".join(map(str, ids)).encode()).hexdigest(), sha256((r.text or "").encode()).hexdigest())


def test_op6(spark, sf, docs):
    got = by_id(queries.op6_quality(spark, sf))
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    for d, r in docs.items():
        g = got[d]
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words, g.base_failed) == brute.quality(r.text)
        assert not (g.base_failed and g.kept)
    kept = brute.kept({d: r.text for d, r in docs.items()}, labels, {d: g.base_failed for d, g in got.items()})
    assert {d: g.kept for d, g in got.items()} == kept
    judged = [(g.kept, labels[d]) for d, g in got.items() if labels.get(d) is not None and not g.base_failed]
    good, bad = [k for k, q in judged if q == 1], [k for k, q in judged if q == 0]
    assert np.mean(good) >= 0.99
    assert not bad or np.mean(bad) <= 0.6


def test_op8(spark, sf, docs):
    got = by_id(queries.op8_media(spark, sf))
    for d, r in docs.items():
        data = (r.text or "").encode()
        payload = data + b" " * (-len(data) % 192 or (0 if data else 192))
        g = got[d]
        assert (g.n_bytes, g.payload_bytes, g.payload_sha256, g.tail_crc32) == (len(data), len(payload), sha256(payload).hexdigest(), crc32(payload[-16:]))
        assert g.media_bytes > g.payload_bytes
    # the files themselves, by a reader of their own: one track of 8-bit samples whose chunks are the payload
    for r in media.to_containers(spark.read.parquet(f"{sf}/documents.parquet")).collect():
        data = (docs[r.doc_id].text or "").encode()
        payload = data + b" " * (-len(data) % 192 or (0 if data else 192))
        file = bytes(r.container)
        assert (len(file), sha256(file).hexdigest()) == (got[r.doc_id].media_bytes, got[r.doc_id].media_sha256)
        boxes = brute.boxes(file)
        (sizes,), (chunks,), (spans,) = (boxes[k] for k in ("stsz", "stco" if "stco" in boxes else "co64", "stsc"))
        wide = 4 if "stco" in boxes else 8
        at = [int.from_bytes(chunks[8 + wide * i : 8 + wide * (i + 1)]) for i in range(int.from_bytes(chunks[4:8]))]
        size, n = int.from_bytes(sizes[4:8]), int.from_bytes(sizes[8:12])
        assert size * n == len(payload)
        runs = [tuple(int.from_bytes(spans[8 + 12 * i + 4 * j : 12 + 12 * i + 4 * j]) for j in range(2)) for i in range(int.from_bytes(spans[4:8]))]
        per = [next(k for f, k in reversed(runs) if f <= i) for i in range(1, len(at) + 1)]
        assert b"".join(file[a : a + k * size] for a, k in zip(at, per, strict=True)) == payload
    same: dict = {}
    for d, r in docs.items():
        same.setdefault(r.text, set()).add((got[d].media_sha256, got[d].feature, got[d].media_bytes))
    assert all(len(x) == 1 for x in same.values())


def test_op9(spark, sf, docs):
    got = by_id(queries.op9_language(spark, sf))
    seen = {r.lang for d, r in docs.items() if r.lang is not None and not brute.held_out(d, 4)}
    right = []
    for d, r in docs.items():
        g = got[d]
        assert g.held_out == brute.held_out(d, 4) and 0 <= g.score <= 1
        assert g.lang_pred in seen | {"und"}
        assert (g.lang_pred == "und") == (not any(map(str.isalpha, r.text or "")))
        if g.held_out and r.lang:
            right.append(g.lang_pred == r.lang)
    assert np.mean(right) >= 0.95, np.mean(right)


def test_op10(spark, sf, docs):
    got = by_id(queries.op10_near_duplicates(spark, sf))
    want = brute.near_classes([(d, r.text) for d, r in docs.items()])
    assert {d: g.class_id for d, g in got.items()} == want
    size = Counter(want.values())
    assert all(g.class_size == size[g.class_id] and g.kept == (g.class_id == d) for d, g in got.items())


def test_op3_beats_unigrams(spark, sf, docs):
    """On held-out documents the model is better than smoothed counts of single subword ids."""
    from lodestrand.llm import bpe

    own = bpe.encoder(bpe.vocabulary(), bpe.default_pattern(), bpe.LibraryEncoder)
    ids = dict(zip(docs, own.encode([b" " + b" ".join((r.text or "").encode().lower().split()) for r in docs.values()]), strict=True))
    n = np.bincount(np.concatenate([x for d, x in ids.items() if not brute.held_out(d, 7)]), minlength=50257) + 0.5
    got = by_id(queries.op3_lm_scores(spark, sf))
    out = [d for d in docs if brute.held_out(d, 7)]
    single = sum(np.log10(n / n.sum())[ids[d]].sum() for d in out)
    assert sum(got[d].score for d in out) > 0.9 * single  # log probabilities: closer to 0 is better
