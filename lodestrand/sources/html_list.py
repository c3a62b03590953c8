"""Lists of cards in HTML pages, described by CSS selectors of the source's configuration."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import htmltree
from ..functions.batches import mapped
from ..functions.dates import parse_date
from ..functions.urls import resolve
from .schema import RAW_COLUMNS

_CARD = [("titolo", pa.string()), ("url", pa.string()), ("testo", pa.string()), ("immagine", pa.string()), ("giorno", pa.string()), ("luogo", pa.string())]


@lru_cache(maxsize=256)
def selectors(config: str) -> dict:
    """The selectors of a JSON configuration; ``item`` and ``titolo`` are required."""
    found = json.loads(config)
    for k in ("item", "titolo"):
        if not isinstance(found.get(k), str):
            raise ValueError(f"selectors: {k} is missing")
    return found


def field(node: htmltree.Node, selector: str | None, default: str | None = None) -> str | None:
    """``css`` gives the text (or the attribute ``default``), ``css@attr`` an attribute, ``@attr`` one of the node itself; blank is null."""
    if selector is None:
        return None
    css, at, attr = selector.partition("@")
    if at:
        found = (node.one(css) if css else node), attr
    else:
        found = node.one(selector), default
    if found[0] is None:
        return None
    value = (found[0].text if found[1] is None else found[0].attrs.get(found[1].lower(), "")).strip()
    return value or None


def cards(html: str | None, config: str, base: str | None) -> list[dict]:
    sel, out = selectors(config), []
    for node in htmltree.parse(html).all(sel["item"]):
        title = field(node, sel["titolo"])
        if title is not None:
            link, image = field(node, sel.get("link"), "href"), field(node, sel.get("immagine"), "src")
            out.append({"titolo": title, "url": resolve(link, base) or "", "testo": field(node, sel.get("testo")), "immagine": resolve(image, base), "giorno": field(node, sel.get("data")), "luogo": field(node, sel.get("luogo"))})
    return out


def parse(pages: DataFrame, html: str = "html", selettori: str = "selettori", base: str = "base") -> DataFrame:
    """Documents of list pages; columns fonte_id, html, selettori (JSON), base. Cards without a title go; a missing link is an empty url."""

    @F.arrow_udf("array<struct<titolo:string,url:string,testo:string,immagine:string,giorno:string,luogo:string>>")
    def run(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        yield from mapped(cards, pa.list_(pa.struct(_CARD)))(batches)

    # not deterministic for the optimizer, or else it parses every page again for a filter on the array's size
    found = pages.select("fonte_id", run.asNondeterministic()(F.col(html), F.col(selettori), F.col(base)).alias("cards"))
    listed = found.select("fonte_id", F.posexplode("cards").alias("pos", "c"))
    return listed.select("fonte_id", F.col("pos").cast("long").alias("pos"), "c.titolo", "c.url", "c.testo", "c.immagine", parse_date(F.col("c.giorno")).alias("data"), "c.luogo").select(RAW_COLUMNS)


def texts(html: Column) -> Column:
    """The text of HTML fragments: tags gone, entities decoded."""

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from mapped(htmltree.fragment_text, pa.string())(batches)

    return run(html)


def _container(html: str | None, selector: str | None) -> str | None:
    node = htmltree.parse(html).one(selector) if html and selector else None
    return (htmltree.squeezed(node.text) or None) if node is not None else None


def container_text(html: Column, selector: Column) -> Column:
    """The squeezed text of the first element that a selector finds; null if there is none or it is blank."""

    @F.arrow_udf("string")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        yield from mapped(_container, pa.string())(batches)

    return run(html, selector)
