"""ISO media containers: writing bytes as 8-bit audio samples, and reading codec, duration and keyframe byte ranges.

The reader walks the nested boxes and decodes the sample tables only; payloads stay undecoded.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from struct import calcsize, error, pack, unpack_from
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, utf8

UNIT = 192
RATE = 8000
#: Samples in a chunk and between two sync samples of the containers that we write. A sample is one UNIT of bytes.
CHUNK, SYNC = 64, 16
_NESTED = {b"moov", b"trak", b"mdia", b"minf", b"stbl", b"edts", b"udta", b"moof", b"traf", b"dinf"}


def box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    return pack(">I4s", len(body) + 8, kind) + body if len(body) + 8 < 1 << 32 else pack(">I4sQ", 1, kind, len(body) + 16) + body


def full(kind: bytes, *parts: bytes, flags: int = 0) -> bytes:
    return box(kind, pack(">I", flags), *parts)


def write(payload: bytes) -> bytes:
    """An ISO media file that holds the payload, a positive multiple of UNIT bytes, as unsigned 8-bit samples."""
    if not payload or len(payload) % UNIT:
        raise ValueError(f"the payload must be a positive multiple of {UNIT} bytes")
    n = len(payload) // UNIT
    matrix = pack(">9I", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)
    head = box(b"ftyp", b"isom", pack(">I", 512), b"isomiso2mp41")
    wide = len(payload) + 8 >= 1 << 32
    first = len(head) + (16 if wide else 8)
    chunks = range(0, n, CHUNK)
    runs = [pack(">3I", 1, CHUNK, 1)] * (n >= CHUNK) + [pack(">3I", n // CHUNK + 1, n % CHUNK, 1)] * (n % CHUNK > 0)
    places = [first + c * UNIT for c in chunks]
    syncs = range(1, n + 1, SYNC)
    table = box(
        b"stbl",
        full(b"stsd", pack(">I", 1), box(b"raw ", bytes(6), pack(">H", 1), bytes(8), pack(">HHHHI", 1, 8, 0, 0, RATE << 16))),
        full(b"stts", pack(">3I", 1, n, UNIT)),
        full(b"stss", pack(">I", len(syncs)), pack(f">{len(syncs)}I", *syncs)),
        full(b"stsc", pack(">I", len(runs)), *runs),
        full(b"stsz", pack(">2I", UNIT, n)),
        full(b"co64", pack(">I", len(places)), pack(f">{len(places)}Q", *places)) if places[-1] >= 1 << 32 else full(b"stco", pack(">I", len(places)), pack(f">{len(places)}I", *places)),
    )
    length = min(len(payload), 0xFFFFFFFF)
    media = box(
        b"mdia",
        full(b"mdhd", pack(">4I2H", 0, 0, RATE, length, 0x55C4, 0)),
        full(b"hdlr", pack(">I4s3I", 0, b"soun", 0, 0, 0), b"samples\0"),
        box(b"minf", full(b"smhd", bytes(4)), box(b"dinf", full(b"dref", pack(">I", 1), full(b"url ", flags=1))), table),
    )
    track = box(b"trak", full(b"tkhd", pack(">5I", 0, 0, 1, 0, length), bytes(8), pack(">4H", 0, 0, 0x100, 0), matrix, bytes(8), flags=7), media)
    return head + box(b"mdat", payload) + box(b"moov", full(b"mvhd", pack(">4IIH", 0, 0, RATE, length, 0x10000, 0x100), bytes(10), matrix, bytes(24), pack(">I", 2)), track)


def boxes(data: bytes, begin: int = 0, end: int | None = None, path: tuple = ()) -> Iterator[tuple[tuple, int, int]]:
    """(path, begin, end) of every box body, depth first. A box that overruns its parent ends the walk with ValueError."""
    end = len(data) if end is None else end
    while begin + 8 <= end:
        size, kind = unpack_from(">I4s", data, begin)
        body = begin + 8
        if size == 1:
            if begin + 16 > end:
                raise ValueError("a box header is cut off")
            (size,) = unpack_from(">Q", data, body)
            body += 8
        elif size == 0:
            size = end - begin
        if size < body - begin or begin + size > end:
            raise ValueError(f"box {kind!r} at {begin} overruns its parent")
        yield (*path, kind), body, begin + size
        if kind in _NESTED:
            yield from boxes(data, body, begin + size, (*path, kind))
        begin += size


def _table(data: bytes, at: int, end: int, row: str, skip: int = 4) -> list[tuple]:
    (n,) = unpack_from(">I", data, at + skip)
    size = calcsize(">" + row)
    begin = at + skip + 4
    if begin + n * size > end:
        raise ValueError("a sample table is cut off")
    flat = unpack_from(">" + row * n, data, begin)
    return list(zip(*[iter(flat)] * len(row), strict=True))


def tracks(data: bytes) -> list[dict]:
    """For each track: codec, timescale, duration (ticks), samples, ranges (byte ranges of all its chunks), keyframes (byte ranges of its sync samples)."""
    found: list[dict] = []
    for path, at, end in boxes(data):
        kind = path[-1]
        if kind == b"trak":
            found.append({"at": at})
        elif not found or b"trak" not in path:
            continue
        t = found[-1]
        if kind == b"mdhd":
            t["timescale"], t["duration"] = unpack_from(">IQ", data, at + 20) if data[at] == 1 else unpack_from(">II", data, at + 12)
        elif kind == b"hdlr":
            t["handler"] = data[at + 8 : at + 12].decode("latin-1")
        elif kind == b"stsd":
            t["codec"] = data[at + 12 : at + 16].decode("latin-1")
        elif kind == b"stts":
            t["times"] = _table(data, at, end, "II")
        elif kind == b"stss":
            t["sync"] = [x for (x,) in _table(data, at, end, "I")]
        elif kind == b"stsc":
            t["runs"] = _table(data, at, end, "III")
        elif kind == b"stsz":
            size, n = unpack_from(">II", data, at + 4)
            t["sizes"] = [size] * n if size else [x for (x,) in _table(data, at, end, "I", 8)]
        elif kind in (b"stco", b"co64"):
            t["places"] = [x for (x,) in _table(data, at, end, "I" if kind == b"stco" else "Q")]
    return [_ranges(t, len(data)) for t in found]


def _ranges(t: dict, size: int) -> dict:
    sizes, places, runs = t.get("sizes", []), t.get("places", []), t.get("runs", [])
    starts, chunks, sample, run = [], [], 0, 0
    for number, place in enumerate(places, 1):
        while run + 1 < len(runs) and runs[run + 1][0] <= number:
            run += 1
        at = place
        for _ in range(runs[run][1] if runs else 0):
            if sample >= len(sizes):
                break
            starts.append(at)
            at += sizes[sample]
            sample += 1
        if at > size:
            raise ValueError("a chunk lies outside the file")
        chunks.append((place, at))
    if sample != len(sizes):
        raise ValueError("the sample tables don't agree")
    sync = t.get("sync") or range(1, len(sizes) + 1)
    return {
        "codec": t.get("codec", ""), "handler": t.get("handler", ""), "timescale": t.get("timescale", 0), "duration": t.get("duration", 0),
        "ticks": sum(n * d for n, d in t.get("times", [])), "samples": len(sizes), "ranges": chunks,
        "keyframes": [(starts[k - 1], starts[k - 1] + sizes[k - 1]) for k in sync],
    }


def read_samples(data: bytes, track: dict) -> bytes:
    return b"".join(data[a:b] for a, b in track["ranges"])


def payload_of(text: bytes) -> bytes:
    return text + b" " * (-len(text) % UNIT or UNIT * (not text))


CONTAINERS = "doc_id long, n_bytes long, container binary"
FEATURES = "codec string, handler string, timescale long, duration_s double, n_samples long, keyframes array<struct<begin:long,end:long>>"


def to_containers(docs: DataFrame) -> DataFrame:
    """One row for each document: doc_id, n_bytes of its UTF-8 text, container (the media file as binary).

    Null and empty texts are one unit of spaces; repeated rows stay; an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = utf8(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(map(len, texts), pa.int64()), pa.array([write(payload_of(t)) for t in texts], pa.binary())], ["doc_id", "n_bytes", "container"])

    return _base(docs).mapInArrow(run, CONTAINERS)


def inspect(files: DataFrame, container: str = "container") -> DataFrame:
    """Adds the columns FEATURES of the first track. A null, a file without a track, and bytes that are no container give nulls."""

    @F.arrow_udf(f"struct<{','.join(c.replace(' ', ':', 1) for c in FEATURES.split(', '))}>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.struct([("codec", pa.string()), ("handler", pa.string()), ("timescale", pa.int64()), ("duration_s", pa.float64()), ("n_samples", pa.int64()), ("keyframes", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])))])
        for column in batches:
            out = []
            for data in column.to_pylist():
                try:
                    t = tracks(data)[0]
                    out.append({"codec": t["codec"], "handler": t["handler"], "timescale": t["timescale"], "duration_s": t["duration"] / t["timescale"] if t["timescale"] else None, "n_samples": t["samples"], "keyframes": [{"begin": a, "end": b} for a, b in t["keyframes"]]})
                except (ValueError, TypeError, IndexError, ArithmeticError, error):
                    out.append(None)
            yield pa.array(out, kind)

    made = files.withColumn("__media", run(F.col(container)))
    return made.select(*[F.col(f"`{c}`") for c in files.columns], "__media.*")


def _base(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


DIGESTS = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, codec string, duration_s double, n_keyframes long"


def digests(docs: DataFrame) -> DataFrame:
    """One row for each document: the digests of its container and of the samples read back from it.

    Null and empty texts are one unit of spaces; repeated rows stay; an empty table gives an empty result; other
    columns are not read; very long texts are one container each. Equal texts give equal values: the containers hold no times or names.
    """
    names = [c.split()[0] for c in DIGESTS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for text in utf8(batch.column("text")):
                data = write(payload_of(text))
                t = tracks(data)[0]
                back = read_samples(data, t)
                if t["ticks"] != t["duration"]:
                    raise ValueError("the time table and the duration differ")
                keys = pack(f">{2 * len(t['keyframes'])}Q", *(x for k in t["keyframes"] for x in k))
                feature = f"{t['codec'].strip()}:{t['timescale']}:{t['duration']}:{len(t['keyframes'])}:{sha256(keys).hexdigest()[:16]}"
                rows.append((len(text), len(back), sha256(back).hexdigest(), crc32(back[-16:]), len(data), sha256(data).hexdigest(), feature, t["codec"], t["duration"] / t["timescale"], len(t["keyframes"])))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.int64()]
            cols = list(zip(*rows, strict=True)) if rows else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True))], names)

    return _base(docs).mapInArrow(run, DIGESTS)
