"""Public job notices: cards of label and value blocks."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import htmltree
from ..functions.batches import mapped
from ..functions.dates import date_of, iso_day, iso_instant, parse_date, parse_deadline
from ..functions.text import SPACE, lookup, spaced
from ..functions.urls import resolve

#: The labels of the source and the fields that they name.
LABELS = {
    "repertorio": "repertorio",
    "scadenza": "scadenza",
    "scadenza domande": "scadenza",
    "scadenza presentazione domande": "scadenza",
    "termine presentazione domande": "scadenza",
    "termine di presentazione delle domande": "scadenza",
    "termine per la presentazione delle domande": "scadenza",
    "data emissione bando": "data_emissione",
}
LIMIT = 10
_TITLES = ("accordion__title", "accordion__subject")
_EXPIRED = re.compile(spaced(r"(?ia)-\s*SCADUT[OA]\s*-"))
_MANUAL = "(?i)manuale"
_OF_MANUAL = re.compile(_MANUAL, re.ASCII)
_BLANKS = re.compile(SPACE + "+")
_TEXT = pa.string()
_FIELDS = ("repertorio", "scadenza", "data_emissione")
_NOTICE = pa.struct([
    *((c, _TEXT) for c in ("titolo", "url", *_FIELDS)), ("text", _TEXT), ("scaduto", pa.bool_()), ("descrizione", _TEXT),
    ("allegati", pa.list_(pa.struct([("nome", _TEXT), ("url", _TEXT)]))),
])
NOTICE = "array<struct<titolo:string,url:string,repertorio:string,scadenza:string,data_emissione:string,text:string,scaduto:boolean,descrizione:string,allegati:array<struct<nome:string,url:string>>>>"


def _label(block: str) -> str | None:
    return LABELS.get(block.lower().replace(":", "").strip(" "))


def _pairs(blocks: list[str]) -> dict[str, str]:
    """fields() of one card."""
    out: dict[str, str] = {}
    labels = [_label(x) for x in blocks]
    for i, k in enumerate(labels[:-1]):
        if k is not None and k not in out and labels[i + 1] is None and not _OF_MANUAL.search(blocks[i + 1]):
            out[k] = blocks[i + 1]
    return out


def _attachments(links: list[tuple[str, str]], base: str | None) -> list[dict]:
    """The PDF links with a name, the manual left out; of equal urls the first."""
    out: dict[str, str] = {}
    for name, href in links:
        if name and ".pdf" in href.lower() and not _OF_MANUAL.search(name):
            url = resolve(href, base, strict=True)
            if url is not None:
                out.setdefault(url, name)
    return [{"nome": n, "url": u} for u, n in out.items()]


def card(node: htmltree.Node, base: str | None) -> dict | None:
    """A notice of a card; null without a title or a detail link. ``text`` is the whole text, for a deadline in prose."""
    heads: dict[str, str] = {}
    blocks, anchors, outer = [], [], set()
    for x in node.walk():
        if x.name in ("p", "div"):
            blocks.append(x)
            up = x.parent
            while up is not node and up not in outer:
                outer.add(up)
                up = up.parent
        elif x.name == "a" and "href" in x.attrs:
            anchors.append(x)
        if "class" in x.attrs:
            for c in x.attrs["class"].split():
                if c in _TITLES and c not in heads:
                    heads[c] = htmltree.squeezed(x.text)
    title = next((heads[c] for c in _TITLES if heads.get(c)), None)
    if title is None:
        return None
    links = [(htmltree.squeezed(a.text), a.attrs["href"].strip()) for a in anchors]
    # the first link of that name counts, whether or not it can be resolved
    href = next((h for n, h in links if h and n.lower() == "visualizza"), None)
    url = resolve(href, base, strict=True)
    if url is None:
        return None
    inner = [(x.name, t) for x, t in ((x, htmltree.squeezed(x.text)) for x in blocks if x not in outer) if t]
    clean = _BLANKS.sub(" ", _EXPIRED.sub(" ", title)).strip(" ")
    told = (t for n, t in inner if n == "p" and (len(t) > 80 or len(t) > 40 and len(t) + sum(c > "\uffff" for c in t) > 80) and t not in (title, clean) and _label(t) is None)
    return {
        "titolo": clean, "url": url, "scaduto": _EXPIRED.search(title) is not None, "text": htmltree.squeezed(node.text), "descrizione": next(told, None), "allegati": _attachments(links, base),
    } | _pairs([t for _, t in inner])


def cards(html: str | None, base: str | None, limit: int) -> list[dict]:
    """The first ``limit`` notices of a page, counted after skipping the cards without a title or link."""
    every = (card(node, base) for node in htmltree.parse(html).all(".accordion"))
    return list(islice((c for c in every if c is not None), max(limit, 0)))


def label_of(block: Column) -> Column:
    """The field that a block is the label of, or null."""
    return lookup(F.trim(F.replace(F.lower(block), F.lit(":"), F.lit(""))), LABELS)


def fields(blocks: Column) -> Column:
    """map<field, value>: a label's value is the next block, unless that is a label or the manual's link; the first pair counts."""
    kind = "map<string,string>"
    pairs = F.transform(blocks, lambda x, i: F.struct(label_of(x).alias("k"), F.get(blocks, i + 1).alias("v")))
    good = F.filter(pairs, lambda p: p["k"].isNotNull() & p["v"].isNotNull() & label_of(p["v"]).isNull() & ~p["v"].rlike(_MANUAL))
    step = lambda m, p: F.when(F.map_contains_key(m, p["k"]), m).otherwise(F.map_concat(m, F.create_map(p["k"], p["v"])))
    return F.aggregate(good, F.create_map().cast(kind), step)


def parse(pages: DataFrame, html: str = "html", base: str = "base", limit: int = LIMIT) -> DataFrame:
    """Notices of pages (fonte_id, html, base): at most ``limit`` a page, counted after skipping those without a title or link.

    Columns fonte_id, pos, titolo, url, repertorio, data_emissione (timestamp), scadenza, scadenza_il (timestamp), scaduto,
    descrizione, allegati.
    """

    @F.arrow_udf(NOTICE)
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        yield from mapped(lambda h, b: cards(h, b, limit), pa.list_(_NOTICE))(batches)

    # not deterministic for the optimizer, or else it parses every page again for a filter on the array's size
    found = pages.select("fonte_id", run.asNondeterministic()(F.col(html), F.col(base)).alias("cards"))
    each = found.select("fonte_id", F.posexplode("cards").alias("pos", "c"))
    return each.select(
        "fonte_id", F.col("pos").cast("long").alias("pos"), "c.titolo", "c.url", "c.repertorio", parse_date(F.col("c.data_emissione")).alias("data_emissione"), "c.scadenza",
        F.coalesce(parse_deadline(F.col("c.scadenza")), parse_deadline(F.col("c.text"), prose=True)).alias("scadenza_il"), "c.scaduto", "c.descrizione", "c.allegati",
    )


def to_review(notices: DataFrame, beside: tuple[str, ...] = ()) -> DataFrame:
    """The rows of the review queue, and the columns named in ``beside``. scadenza_origine is ``campo`` where the field has text, even if the instant came from the prose."""
    return notices.select(
        *beside, "titolo", "url", "repertorio", "descrizione", iso_day(date_of(F.col("data_emissione"))).alias("data_emissione"), F.col("scadenza").alias("scadenza_testo"), iso_instant(F.col("scadenza_il")).alias("scadenza_il"),
        F.when(F.col("scadenza_il").isNotNull(), F.when(F.col("scadenza").isNotNull(), "campo").otherwise("prosa")).alias("scadenza_origine"), "scaduto", "allegati",
    )


def to_json(notices: DataFrame, source: str) -> DataFrame:
    """One JSON envelope {fonte, count, items} for the notices of one run (a page's few)."""
    item = F.struct("titolo", "repertorio", iso_day(date_of(F.col("data_emissione"))).alias("data_emissione"), "scadenza", iso_instant(F.col("scadenza_il")).alias("scadenza_il"), "scaduto", "descrizione", F.col("url").alias("url_dettaglio"), "allegati")
    rows = F.array_sort(F.collect_list(F.struct("fonte_id", "pos", item.alias("item"))))
    return notices.groupBy("fonte_id").agg(rows.alias("r")).select("fonte_id", F.to_json(F.struct(F.lit(source).alias("fonte"), F.size("r").alias("count"), F.transform("r", lambda x: x["item"]).alias("items"))).alias("json"))


def bullets(notices: DataFrame) -> Iterator[str]:
    """The notices as text for a dry run, a page at a time: title, day, number and state, deadline, attachments."""
    for r in notices.orderBy("fonte_id", "pos").toLocalIterator():
        day = r.data_emissione.strftime("%d/%m/%Y") if r.data_emissione else "?"
        yield f"• {r.titolo}\n  {day} · {r.repertorio or 'senza repertorio'} · {'SCADUTO' if r.scaduto else 'aperto'}"
        if r.scadenza:
            yield f"  scadenza: {r.scadenza}"
        for a in r.allegati or []:
            yield f"  PDF {a.nome}\n      {a.url}"
