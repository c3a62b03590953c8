"""Bounded-space online packing of token ids into fixed windows.

A partition keeps ``open_windows`` windows. A document's next stretch goes into the window that it fills best. If it
fits none, the fullest window is topped up with the head of the stretch and emitted, and the rest goes on into the
fresh window. What is open at the end of a partition is stored, and groups of partitions merge these leftovers; the
last remainder of a group becomes sequences whose lengths are powers of two, which need no padding.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import LibraryEncoder, default_pattern, encoder, vocabulary
from .common import Stored, slices, utf8

WINDOW = 1024
OPEN_WINDOWS = 8
#: Partitions whose leftovers (at most OPEN_WINDOWS windows each) one task merges.
MERGE_PARTITIONS = 64
END = 0

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def specials(path: str | None = None) -> dict[bytes, int]:
    """The literal special tokens of a tokenizers file and their ids: in a text they stand for themselves."""
    with open(path or vocabulary("byte_bpe_50k.json"), encoding="utf-8") as f:
        return {x["content"].encode(): x["id"] for x in json.load(f)["added_tokens"]}


def encoded(own: LibraryEncoder, texts: list[bytes], special: dict[bytes, int]) -> list[np.ndarray]:
    """The ids of each text; special tokens part it, and what lies between them is encoded by itself."""
    if not any(x in t for x in special for t in texts):
        return own.encode(texts)
    cut = re.compile(b"(%s)" % b"|".join(map(re.escape, sorted(special, key=len, reverse=True))))
    pieces = [cut.split(t) for t in texts]  # plain and special pieces in turn
    plain = iter(own.encode([x for p in pieces for x in p[::2]]))
    return [np.concatenate([np.array([special[x]], np.uint32) if k % 2 else next(plain) for k, x in enumerate(p)]) for p in pieces]


class Windows:
    """The open windows of one partition. Pieces are (doc, start, ids, doc_tokens) in the order of their offsets."""

    def __init__(self, size: int = WINDOW, count: int = OPEN_WINDOWS):
        self.size = size
        self.open: list[list] = [[] for _ in range(count)]
        self.fill = [0] * count

    def add(self, doc, ids: np.ndarray) -> Iterator[list]:
        """Places a document; yields each window that became full."""
        start, n, total = 0, len(ids), len(ids)
        while total - start >= self.size:
            yield [(doc, start, ids[start : start + self.size], n)]
            start += self.size
        while start < total:
            left = total - start
            fits = [(self.size - f, i) for i, f in enumerate(self.fill) if self.size - f >= left]
            gap, i = min(fits) if fits else min((self.size - f, i) for i, f in enumerate(self.fill))
            take = min(gap, left)
            self.open[i].append((doc, start, ids[start : start + take], n))
            self.fill[i] += take
            start += take
            if self.fill[i] == self.size:
                yield self.open[i]
                self.open[i], self.fill[i] = [], 0


def merge(pieces: list[tuple], size: int = WINDOW) -> Iterator[list]:
    """Lays leftover pieces end to end into full windows, and the remainder into windows of power-of-two lengths."""
    left = sum(len(p[2]) for p in pieces)
    room, window = 0, []
    for doc, start, ids, n in pieces:
        at = 0
        while at < len(ids):
            if not room:
                room = size if left >= size else 1 << (left.bit_length() - 1)
                left -= room
            take = min(room, len(ids) - at)
            window.append((doc, start + at, ids[at : at + take], n))
            at, room = at + take, room - take
            if not room:
                yield window
                window = []


def pack(docs: DataFrame, path: str | None = None, pattern: str | None = None, window: int = WINDOW, open_windows: int = OPEN_WINDOWS, keep_ids: bool = False, special: dict[bytes, int] | None = None) -> DataFrame:
    """Packs every whole text, followed by id END, into sequences of at most ``window`` ids.

    One row for each piece: doc_id, start, length, ids_crc32 (of the little-endian unsigned 32-bit ids), doc_tokens,
    sequence_id, offset, and with ``keep_ids`` the ids themselves. A null text counts as empty and so is the end id
    alone; a null doc_id stays null; rows that repeat are packed as often as they stand there; an empty table gives an
    empty result; columns besides doc_id and text are left aside. Very long texts are packed whole, over as many windows
    as they fill. Windows that fit equally well count in their order. Ids are those of the public 50k byte-level
    vocabulary as the tokenizers library gives them: a literal ``special`` token of a text (those of the public file if
    none are given) is its own id.
    """
    path, pattern, special = path or vocabulary(), pattern or default_pattern(), specials() if special is None else special
    ids_type = ", token_ids array<int>"
    schema = pa.schema(
        [(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
        + [("token_ids", pa.list_(pa.int32())), ("part", pa.int64())]
    )

    def rows(windows, first: int, part: int, ids_too: bool) -> pa.RecordBatch:
        cols: list[list] = [[] for _ in range(9)]
        for k, w in enumerate(windows):
            at = 0
            for doc, start, ids, n in w:
                data = ids.astype("<u4")
                for c, v in zip(cols, (doc, start, len(ids), crc32(data.tobytes()), n, first + k, at, ids.astype(np.int32) if ids_too else None, part), strict=True):
                    c.append(v)
                at += len(ids)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part = encoder(path, pattern, LibraryEncoder), TaskContext.get().partitionId()
        state, end, count = Windows(window, open_windows), np.array([END], np.uint32), part << 36
        for batch in slices(batches):
            done = []
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encoded(own, utf8(batch.column("text")), special), strict=True):
                done.extend(state.add(doc, np.concatenate([ids, end])))
            yield rows(done, count, -1, keep_ids)
            count += len(done)
        yield rows([w for w in state.open if w], count, part, True)

    first = Stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, PIECES + ids_type + ", part long"), "pieces")

    def last(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["sequence_id", "offset"])
        doc = [None if pd.isna(x) else int(x) for x in pdf.doc_id.astype(object)]
        pieces = list(zip(doc, pdf.start.tolist(), [np.asarray(x, np.uint32) for x in pdf.token_ids], pdf.doc_tokens.tolist(), strict=True))
        out = rows(list(merge(pieces, window)), (1 << 62) + (int(key[0]) << 36), 0, keep_ids)
        return out.drop_columns(["part"]).to_pandas(types_mapper=lambda t: pd.Int64Dtype() if t == pa.int64() else None)

    columns = [c.split()[0] for c in PIECES.split(", ")] + ["token_ids"] * keep_ids
    closed = first.df.where("part < 0").select(columns)
    rest = first.df.where("part >= 0").withColumn("part", F.expr(f"part div {MERGE_PARTITIONS}")).groupBy("part").applyInPandas(last, PIECES + ids_type)
    return closed.unionByName(rest.select(columns))
