"""Bytes to text: pages of mixed encodings, archives, PDF files."""

from __future__ import annotations

import codecs
import io
import shutil
import subprocess
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .batches import pieces

#: The texts of these bytes in Windows-1252; the five undefined ones stay what they are.
_UNDEFINED = {0x81, 0x8D, 0x8F, 0x90, 0x9D}
#: A document with less text than this is kept by its title alone.
LEAST_CHARS = 80


def _as_cp1252(e: UnicodeDecodeError) -> tuple[str, int]:
    b = e.object[e.start]
    return (chr(b) if b in _UNDEFINED else bytes([b]).decode("cp1252")), e.start + 1


codecs.register_error("lodestrand-cp1252", _as_cp1252)


def mixed_text(data: bytes | None) -> str | None:
    """Valid UTF-8 sequences as UTF-8, every other byte as Windows-1252."""
    if data is None:
        return None
    codecs.register_error("lodestrand-cp1252", _as_cp1252)
    return data.decode("utf-8", "lodestrand-cp1252")


def pdf_of_zip(data: bytes) -> bytes | None:
    """Of the PDF files in an archive the first whose name has "SENZA NOTE", else the largest; null without any."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        found = [x for x in z.infolist() if not x.is_dir() and x.filename.lower().endswith(".pdf")]
        if not found:
            return None
        plain = [x for x in found if "SENZA NOTE" in x.filename.upper()]
        return z.read(plain[0] if plain else max(found, key=lambda x: x.file_size))


def pdf_text(data: bytes) -> str:
    """The text layer of a PDF by the program pdftotext, which must be installed on the executors."""
    if not shutil.which("pdftotext"):
        raise RuntimeError("pdftotext is not installed; pass another reader")
    with tempfile.TemporaryDirectory() as d:  # read again by the child process alone
        path = Path(d) / "act.pdf"
        path.write_bytes(data)
        done = subprocess.run(["pdftotext", "-enc", "UTF-8", "-q", str(path), "-"], capture_output=True, check=True)
    return done.stdout.decode("utf-8", "replace")


def document_text(data: bytes | None, reader: Callable[[bytes], str] = pdf_text) -> str | None:
    """Text of a PDF, or of the PDF to use in an archive; an archive without one is an error."""
    if data is None:
        return None
    if len(data) > 4 and data[:2] == b"PK":
        data = pdf_of_zip(data)
        if data is None:
            raise ValueError("the archive holds no PDF")
    return reader(data)


def decoded(data: Column) -> Column:
    """Column form of mixed_text(). Not a function of iterators: those take a worker each, several of this kind share one."""

    @F.arrow_udf("string")
    def run(column: pa.Array) -> pa.Array:
        done = [pa.array([mixed_text(x) for x in values], pa.string()) for (values,) in pieces(column)]
        return pa.concat_arrays(done) if done else pa.array([], pa.string())

    return run(data)


def document_texts(data: Column, reader: Callable[[bytes], str] = pdf_text) -> Column:
    """struct<text,error> of document_text(): a document that can't be read has an error and does not stop the others."""

    @F.arrow_udf("struct<text:string,error:string>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            out = []
            for x in column.to_pylist():
                try:
                    out.append({"text": document_text(x, reader), "error": None})
                except (ValueError, RuntimeError, OSError, zipfile.BadZipFile, subprocess.CalledProcessError) as e:
                    out.append({"text": None, "error": str(e).split("\n")[0]})
            yield pa.array(out, pa.struct([("text", pa.string()), ("error", pa.string())]))

    return run(data)
