"""Institutional pages: links of an index, and the full text of each page."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import htmltree
from ..functions.batches import mapped
from ..functions.dates import iso_instant, parse_date
from ..functions.text import utf16_head, utf16_length
from ..functions.urls import resolve

MOST_PAGES, LEAST_BODY, MOST_BODY = 20, 40, 8000


def _blanks(text: str) -> str:
    return re.sub(r"[ \t]+", " ", text).strip()


def _text(root: htmltree.Node, selector: str | None) -> str | None:
    node = root.one(selector) if selector else None
    return (_blanks(node.text) or None) if node is not None else None


def links(html: str | None, selector: str, base: str | None) -> list[str]:
    """The distinct absolute links that a selector finds, in page order."""
    out = {}
    for a in htmltree.parse(html).all(selector):
        href = a.attrs.get("href", "").strip()
        url = resolve(href, base, strict=True) if href else None
        if url is not None:
            out.setdefault(url)
    return list(out)


def page(html: str | None, title: str | None = None, body: str | None = None, day: str | None = None) -> dict:
    """titolo, contenuto, giorno of a page. The body falls back on the paragraphs of main, article or body."""
    root = htmltree.parse(html)
    aimed = _text(root, body)
    if aimed is None or len(aimed) < LEAST_BODY:
        holder = root.one("main") or root.one("article") or root.one("body") or root
        aimed = _blanks("\n".join(t for t in (p.text.strip() for p in holder.all("p")) if t)) or None
    return {"titolo": _text(root, title) or _text(root, "h1") or _text(root, "title"), "contenuto": aimed, "giorno": _text(root, day)}


def detail_links(indexes: DataFrame, selector: str, most: int = MOST_PAGES, html: str = "html", base: str = "base") -> DataFrame:
    """fonte_id, pos, url: the first ``most`` distinct links of each index page."""

    @F.arrow_udf("array<string>")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        yield from mapped(lambda h, b: links(h, selector, b)[:most], pa.list_(pa.string()))(batches)

    return indexes.select("fonte_id", F.posexplode(run(F.col(html), F.col(base))).alias("pos", "url"))


def documents(pages: DataFrame, title: str | None = None, body: str | None = None, day: str | None = None, act_type: str | None = None, html: str = "html") -> DataFrame:
    """Institutional rows of pages (fonte_id, url, html): those with a title and a body of LEAST_BODY characters, cut at MOST_BODY."""
    kind = pa.struct([("titolo", pa.string()), ("contenuto", pa.string()), ("giorno", pa.string())])

    @F.arrow_udf("struct<titolo:string,contenuto:string,giorno:string>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from mapped(lambda h: page(h, title, body, day), kind)(batches)

    # not deterministic for the optimizer, or else it parses every page again for the filter below
    read = pages.select("fonte_id", "url", run.asNondeterministic()(F.col(html)).alias("p"))
    good = read.where(F.col("p.titolo").isNotNull() & (utf16_length(F.col("p.contenuto")) >= LEAST_BODY))
    body_ = F.col("p.contenuto")
    return good.select(
        "fonte_id", F.col("p.titolo").alias("titolo"), "url", F.lit(act_type).cast("string").alias("tipo_atto"), iso_instant(parse_date(F.col("p.giorno"))).alias("data"),
        F.when(utf16_length(body_) > MOST_BODY, utf16_head(body_, MOST_BODY)).otherwise(body_).alias("contenuto"), F.col("url").alias("dedup_key"),
    )
