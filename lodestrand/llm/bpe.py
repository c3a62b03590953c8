"""Byte-level BPE encoding and decoding in padded numpy matrices.

Distinct pre-tokens are sorted into length buckets. A bucket is one matrix of symbol ids, a row a word. Every
round looks up the rank of all neighbouring pairs in a hash table held in flat arrays, merges in each row the
leftmost pair of least rank, and closes the gap. Rows without a mergeable pair leave the matrix.
"""

from __future__ import annotations

import base64
import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import parts, slices, utf8

#: Entries of the per-worker word cache; an entry takes about 250 bytes. Full, it admits no more words.
CACHE_WORDS = 600_000
_NONE = np.int64(1) << 40
#: Bytes of a row of a matrix at most. Longer runs are cut where no merge can cross, else swept in a row of their own.
WIDEST = 256


def vocabulary(name: str = "byte_bpe_50k.tiktoken") -> str:
    """The path of a public vocabulary file; the library keeps no copy of its own."""
    import public_tokenizers

    return public_tokenizers.path(name)


class PairTable:
    """Open addressing over (left, right) pairs: lookup(left, right) gives the merged id, or a huge number."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        self.mask = (1 << int(max(4, np.ceil(np.log2(max(1, len(left)) * 4))))) - 1
        self.keys = np.full(self.mask + 1, -1, np.int64)
        self.values = np.full(self.mask + 1, _NONE, np.int64)
        self.probes = 1
        for key, value in zip(((left << 32) | right).tolist(), merged.tolist(), strict=True):
            slot, n = self._slot(key), 1
            while self.keys[slot] not in (-1, key):
                slot, n = (slot + 1) & self.mask, n + 1
            if self.keys[slot] == -1 or value < self.values[slot]:
                self.keys[slot], self.values[slot] = key, value
            self.probes = max(self.probes, n)

    def _slot(self, key: int) -> int:
        return ((key * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) >> 40) & self.mask

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left.astype(np.int64) << 32) | right
        slot = ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) & self.mask
        out = np.where(self.keys[slot] == key, self.values[slot], _NONE)
        open_ = np.flatnonzero((self.keys[slot] != key) & (self.keys[slot] != -1))
        k, s = key.ravel()[open_] if key.ndim > 1 else key[open_], slot.ravel()[open_]
        flat = out.ravel()
        for _ in range(self.probes):
            if not len(open_):
                break
            s = (s + 1) & self.mask
            hit = self.keys[s] == k
            flat[open_[hit]] = self.values[s[hit]]
            more = ~hit & (self.keys[s] != -1)
            open_, k, s = open_[more], k[more], s[more]
        return flat.reshape(out.shape)


class MatrixBpe:
    """Encodes like the tiktoken library does for the same ranks and pattern, without special tokens."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bytes_of = {b: a for a, b in self.ranks.items()}
        self.pattern = regex.compile(pattern)
        self.first = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        left, right, merged = [], [], []
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), merged.append(rank)
        self.pairs = PairTable(np.array(left, np.int64), np.array(right, np.int64), np.array(merged, np.int64))
        self.beside = np.zeros((256, 256), bool)  # bytes that stand beside each other in some token
        for token in self.ranks:
            for a, b in itertools.pairwise(token):
                self.beside[a, b] = True

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """The ids of single pre-tokens, as little-endian uint32. A pre-token that is a token by itself is that token."""
        out: list[bytes] = [b""] * len(words)
        buckets: dict[int, list[int]] = {}
        ranks = self.ranks
        for i, w in enumerate(words):
            whole = ranks.get(w)
            if whole is not None:
                out[i] = whole.to_bytes(4, "little")
            else:
                buckets.setdefault(max(4, 1 << (len(w) - 1).bit_length()), []).append(i)
        for width, rows in buckets.items():
            step = max(1, (1 << 20) // width)
            for at in range(0, len(rows), step):
                part = rows[at : at + step]
                for i, ids in zip(part, self._merge([words[i] for i in part], width), strict=True):
                    out[i] = ids
        return out

    def _merge(self, words: list[bytes], width: int) -> list[bytes]:
        if width > WIDEST:  # a long run without a boundary
            return [self._long(w) for w in words]
        sizes = np.array([len(w) for w in words])
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(-1, width)
        cells = self.first[raw]
        column = np.arange(width)
        cells[column >= sizes[:, None]] = -1
        done = [b""] * len(words)
        index = np.arange(len(words))
        rank = self._ranks(cells)
        while len(index):
            best = rank.argmin(1)
            low = rank[np.arange(len(index)), best]
            ready = low >= _NONE
            if ready.any():
                flat, at = cells[ready].astype("<u4").tobytes(), 0
                for i, n in zip(index[ready].tolist(), (4 * sizes[ready]).tolist(), strict=True):
                    done[i] = flat[at : at + n]
                    at += 4 * width
                keep = ~ready
                index, cells, rank, best, low, sizes = index[keep], cells[keep], rank[keep], best[keep], low[keep], sizes[keep]
                if not len(index):
                    break
            # the right part of the merged pair goes; what follows it moves one cell to the left
            source = np.where(column > best[:, None], np.minimum(column + 1, width - 1), column)
            cells = np.take_along_axis(cells, source, 1)
            cells[:, -1] = -1
            here = np.arange(len(index))
            cells[here, best] = low
            sizes = sizes - 1
            if width > 4 and sizes.max() <= width // 2:
                width //= 2
                cells, column = np.ascontiguousarray(cells[:, :width]), np.arange(width)
            rank = self._ranks(cells)
        return done

    def _ranks(self, cells: np.ndarray) -> np.ndarray:
        out = np.full(cells.shape, _NONE, np.int64)
        rows, cols = np.nonzero(cells[:, 1:] >= 0)
        out[rows, cols] = self.pairs.lookup(cells[rows, cols], cells[rows, cols + 1])
        return out

    def _long(self, word: bytes) -> bytes:
        """A run of over WIDEST bytes, cut between bytes that no token holds side by side, which no merge can cross."""
        raw = np.frombuffer(word, np.uint8)
        cuts = [0, *(np.flatnonzero(~self.beside[raw[:-1], raw[1:]]) + 1).tolist(), len(raw)]
        pieces = [word[i:j] for i, j in itertools.pairwise(cuts)]
        out: dict[bytes, bytes] = {}
        widths: dict[int, list[bytes]] = {}
        for x in dict.fromkeys(pieces):
            widths.setdefault(max(4, 1 << (len(x) - 1).bit_length()), []).append(x)
        for width, rows in widths.items():
            if width > WIDEST:
                out.update((x, self._sweep(x)) for x in rows)
                continue
            step = max(1, (1 << 20) // width)
            for at in range(0, len(rows), step):
                out.update(zip(rows[at : at + step], self._merge(rows[at : at + step], width), strict=True))
        return b"".join(map(out.__getitem__, pieces))

    def _sweep(self, word: bytes) -> bytes:
        """One row of any length: each round merges the pair of least rank wherever it stands, from the left.

        That is the same as one merge after the other as long as no merge makes a pair of a lower rank, be it for a
        moment beside the next place; else only the leftmost place merges in that round.
        """
        cells = self.first[np.frombuffer(word, np.uint8)]
        rank = self.pairs.lookup(cells[:-1], cells[1:])
        while len(rank) and (low := int(rank.min())) < _NONE:
            at = np.flatnonzero(rank == low)
            # of places that overlap (a run of one symbol) every second, from the left
            first = np.concatenate([[True], at[1:] != at[:-1] + 1])
            at = at[(np.arange(len(at)) - np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))) % 2 == 0]
            between = self.pairs.lookup(np.full(len(at), low), cells[at]).min() if (at[1:] == at[:-1] + 2).any() else _NONE
            after = self._merged(cells, rank, at, low)
            if min(between, after[2]) < low and len(at) > 1:
                after = self._merged(cells, rank, at[:1], low)
            cells, rank, _ = after
        return cells.astype("<u4").tobytes()

    def _merged(self, cells: np.ndarray, rank: np.ndarray, at: np.ndarray, low: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Cells and ranks after the pairs at some places became ``low``, and the least rank that is new."""
        keep = np.ones(len(cells), bool)
        keep[at + 1] = False
        cells = cells.copy()
        cells[at] = low
        cells, rank = cells[keep], np.concatenate([[_NONE], rank])[keep][1:]
        at = at - np.arange(len(at))  # where the merged symbols stand afterwards
        near = np.unique(np.concatenate([at - 1, at]))
        near = near[(near >= 0) & (near < len(rank))]
        rank[near] = self.pairs.lookup(cells[near], cells[near + 1])
        return cells, rank, int(rank[near].min()) if len(near) else _NONE

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class Encoder:
    """MatrixBpe behind a bounded cache of space-delimited chunks.

    The pattern always cuts in front of a single space that stands between two other characters, so what follows
    such a space up to the next encodes alike wherever it stands. Texts in which a space has white space beside it
    are cut by the pattern itself.
    """

    def __init__(self, path: str, pattern: str, cache_words: int = CACHE_WORDS):
        self.pattern = regex.compile(pattern)
        self.cache: dict[bytes, bytes] = {}
        self.limit = cache_words
        self.setup(path, pattern)

    def setup(self, path: str, pattern: str) -> None:
        self.bpe = MatrixBpe(path, pattern)

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """One array of ids for each UTF-8 text."""
        known, get = self.cache, self.cache.get
        out: list = [None] * len(texts)
        open_, missing = [], set()
        for i, text in enumerate(texts):
            if any(map(text.__contains__, _BESIDE)) or text[:1] in _EDGES or text[-1:] in _EDGES:
                keys = [w[1:] if w[:1] == b" " and w[1:2] not in (b"", b" ") else b" " + w for w in map(str.encode, self.pattern.findall(text.decode()))]
            else:
                keys = text.split(b" ")
                keys[0] = b" " + keys[0]
            found = list(map(get, keys))
            if None in found:
                missing.update(k for k, x in zip(keys, found, strict=True) if x is None)
                open_.append((i, keys, found))
            else:
                out[i] = np.frombuffer(b"".join(found), np.uint32)
        if open_:
            todo = list(missing)
            fresh = dict(zip(todo, self.encode_chunks([k[1:] if k[:1] == b" " else b" " + k for k in todo]), strict=True))
            for i, keys, found in open_:
                out[i] = np.frombuffer(b"".join([fresh[k] if x is None else x for k, x in zip(keys, found, strict=True)]), np.uint32)
            room = self.limit - len(known)
            if room > 0:
                known.update(fresh if len(fresh) <= room else itertools.islice(fresh.items(), room))
        return out

    def encode_chunks(self, chunks: list[bytes]) -> list[bytes]:
        words, findall = [], self.pattern.findall
        for c in map(bytes.decode, chunks):
            if not c:
                words.append([])
            elif c[1:].isalpha() and (c[0] == " " or c[0].isalpha()):
                words.append([c])
            elif c[1:-1].isalpha() and c[-1] in ".,;:!?" and (c[0] == " " or c[0].isalpha()):
                words.append([c[:-1], c[-1]])
            else:
                words.append(findall(c))
        each = list({w for ws in words for w in ws})
        ids = dict(zip(each, self.bpe.encode_words([w.encode() for w in each]), strict=True))
        return [ids[ws[0]] if len(ws) == 1 else b"".join(map(ids.__getitem__, ws)) for ws in words]


class LibraryEncoder(Encoder):
    """The same cache in front of the tiktoken library: for stages that only need ids of the public vocabulary."""

    def setup(self, path: str, pattern: str) -> None:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.width = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.width[rank] = len(token)

    def encode_chunks(self, chunks: list[bytes]) -> list[bytes]:
        out: list[bytes] = [b""] * len(chunks)
        run: list[int] = []
        for i, c in enumerate(chunks):
            if 1 < len(c) < 200 and c[0] == 32 and c[1] not in _UNSURE and c[-1:] not in _EDGES and (c[-1] < 128 or c[-2] != 0xC2 and c[-3] not in _UNSURE):
                run.append(i)  # begins and ends a cut of the pattern wherever it stands
            else:
                out[i] = np.array(self.own.encode_ordinary(c.decode()), "<u4").tobytes()
        for at in range(0, len(run), 500):
            part = run[at : at + 500]
            ids = np.array(self.own.encode_ordinary(b"".join([chunks[i] for i in part]).decode()), "<u4")
            ends = np.searchsorted(np.cumsum(self.width[ids]), np.cumsum([len(chunks[i]) for i in part])) + 1
            flat, begin = ids.tobytes(), 0
            for i, end in zip(part, (4 * ends).tolist(), strict=True):
                out[i], begin = flat[begin:end], end
        return out


#: White space beside a space, and the first bytes of white space outside ASCII: such texts are cut by the pattern.
_BESIDE = [b"  ", *(x for w in b"\t\n\r\x0b\x0c\x1c\x1d\x1e\x1f" for x in (bytes([w, 32]), bytes([32, w]))), b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80"]
_EDGES = {bytes([w]) for w in b" \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f"}
#: First bytes of white space, ASCII or not.
_UNSURE = {*b" \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f", 0xC2, 0xE1, 0xE2, 0xE3}
_ENCODERS: dict[tuple, Encoder] = {}


def encoder(path: str, pattern: str, kind: type[Encoder] = Encoder) -> Encoder:
    """One encoder for each worker process, vocabulary and kind."""
    if (path, pattern, kind) not in _ENCODERS:
        _ENCODERS[path, pattern, kind] = kind(path, pattern)
    return _ENCODERS[path, pattern, kind]


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """Adds the column ``ids`` (array of int) with the BPE ids of every whole text.

    A null text gives an empty array, as does an empty one. All other columns pass through; a column that already
    has the name ``ids`` is replaced.
    """
    path, pattern = path or vocabulary(), pattern or default_pattern()

    @F.arrow_udf("array<int>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = encoder(path, pattern)
        for column in batches:
            yield pa.array([x.astype(np.int32) for part in parts(column) for x in own.encode(utf8(part))], pa.list_(pa.int32()))

    return docs.withColumn(ids, run(F.col(text)))


def decode(docs: DataFrame, path: str | None = None, pattern: str | None = None, ids: str = "token_ids", data: str = "decoded") -> DataFrame:
    """Adds the binary column ``data`` with the bytes of each id array. A null array gives null; an unknown id fails."""
    path, pattern = path or vocabulary(), pattern or default_pattern()

    @F.arrow_udf("binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = encoder(path, pattern)
        for column in batches:
            yield pa.array([None if x is None else own.bpe.decode(x) for x in column.to_pylist()], pa.binary())

    return docs.withColumn(data, run(F.col(ids)))


def round_trip(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """One row for each document: doc_id, n_tokens, ids_sha256, decoded_sha256, round_trip.

    The digest of ``encode`` followed by ``decode`` without handing the ids to the JVM. Null texts count as empty;
    rows that repeat stay; an empty table gives an empty result; other columns are not read.
    """
    from hashlib import sha256

    path, pattern = path or vocabulary(), pattern or default_pattern()
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()), ("round_trip", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        top = max(own.bpe.bytes_of) + 1
        decimal = [b"%d" % i for i in range(top)]
        for batch in slices(batches):
            texts = utf8(batch.column("text"))
            n, a, b, same = [], [], [], []
            for text, ids in zip(texts, own.encode(texts), strict=True):
                each = ids.tolist()
                back = own.bpe.decode(each)
                n.append(len(each)), a.append(sha256(b" ".join(map(decimal.__getitem__, each))).hexdigest()), b.append(sha256(back).hexdigest()), same.append(back == text)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(same, pa.bool_())], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, round_trip boolean")
