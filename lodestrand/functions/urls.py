"""Resolving links against the page that holds them."""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import quote, urljoin, urlsplit

import pyarrow as pa
from pyspark.sql import functions as F

_SCHEME = re.compile(r"^[A-Za-z][A-Za-z0-9+.-]*:")
#: A path from the root without dot segments, and an address whose host it can follow: joined without taking both apart.
_ROOTED = re.compile(r"(?:/[A-Za-z0-9_~-]+(?:\.[A-Za-z0-9_~-]+)*)+")
_HOST = re.compile(r"(https?://[A-Za-z0-9.-]+)(?:/|\Z)")


def parsable(raw: str) -> bool:
    if raw.startswith(":"):
        return False
    try:
        urlsplit(raw).port
    except ValueError:
        return False
    return True


def resolve(raw: str | None, base: str | None, strict: bool = False) -> str | None:
    """An absolute link. One with a scheme stays as it is. Without a base, or if it can't be parsed: unchanged, or null if ``strict``."""
    if raw is None:
        return None
    if base and _ROOTED.fullmatch(raw) and (host := _HOST.match(base)):
        return host[1] + raw
    if not parsable(raw):
        return None if strict else raw
    if _SCHEME.match(raw):
        return raw
    if not base:
        return None if strict else raw
    try:
        return urljoin(base, quote(raw, safe="%/:?#[]@!$&'()*+,;=~-._"))
    except ValueError:
        return None if strict else raw


def _resolver(strict: bool):
    @F.arrow_udf("string")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for raw, base in batches:
            yield pa.array([resolve(a, b, strict) for a, b in zip(raw.to_pylist(), base.to_pylist(), strict=True)], pa.string())

    return run


def absolute(raw, base, strict: bool = False):
    """Column form of resolve()."""
    return _resolver(strict)(raw, base)
