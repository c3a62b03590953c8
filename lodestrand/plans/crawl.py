"""Crawls through a transport: pages of the legal archive, texts of its acts, details of an institutional index, posts
with their images. Every window, address and endpoint is read by a task; what was read is stored before it is parsed.

A transport is a function from an address to bytes (sources.rest.get, or from_folder for a landing folder). A refused
request goes through the gateway, if one is given; a pause stands behind every request of a task.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.decode import document_text, mixed_text, pdf_text
from ..operators import archive_runs, sinks
from ..sources import archive, institutional, rest, wp_json
from ..sources.schema import ACT
from ..tables import Written
from .runner import Result, delivered

Transport = Callable[[str], bytes]
#: Pages of one window at most; requests that one task makes at a time; seconds between requests of a task.
MOST_PAGES, TASKS, PAUSE = 60, 4, 1.2
#: What goes wrong with one address and must not end a crawl.
FAILURES = (OSError, rest.Missing, rest.Refused, ValueError, RuntimeError)


class Fetcher:
    """Retried requests of a crawl, through the gateway where refused, until the clock time ``until``."""

    def __init__(self, transport: Transport, gateway: Transport | None = None, pause: float = PAUSE, waits: tuple = rest.WAITS, until: float | None = None):
        self.transport, self.gateway, self.pause, self.waits, self.until = transport, gateway, pause, waits, until

    def late(self) -> bool:
        return self.until is not None and time.time() >= self.until

    def __call__(self, url: str) -> bytes:
        try:
            return rest.retried(url, lambda u: rest.with_gateway(u, self.transport, self.gateway), self.waits)
        finally:
            time.sleep(self.pause)


def landed(spark: SparkSession, url: str, fetch: Fetcher) -> str:
    """Fetches one page into the shared folder and returns its path."""
    return Written(spark.createDataFrame([(mixed_text(fetch(url)),)], "value string").coalesce(1), "landed", "text").path


def fetched(addresses: DataFrame, fetch: Fetcher, read: Callable[[bytes], str] = mixed_text) -> DataFrame:
    """url, testo, errore of each address (column url) that was tried in time; an error names what went wrong in a line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for url in batch.column("url").to_pylist():
                if fetch.late():
                    return
                text, error = None, None
                try:
                    text = read(fetch(url))
                except FAILURES as e:
                    error = f"{type(e).__name__}: {e}".split("\n")[0]
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.string()) for x in (url, text, error)], ["url", "testo", "errore"])

    return addresses.select("url").repartition(TASKS).mapInArrow(run, "url string, testo string, errore string")


def listing_pages(windows: DataFrame, page: str, fetch: Fetcher, rows: int = archive.ROWS_A_PAGE, most: int = MOST_PAGES) -> DataFrame:
    """The listing pages of year windows (n, da, a): page (by window, then number), html, base, letti (acts on it), totale
    (as first stated), errore. A window ends with an empty page, when all that was stated is read, after the first page if
    nothing is stated, or after ``most`` pages; one that can't be read ends with an error."""
    kind = pa.schema([("page", pa.int64()), ("da", pa.int64()), ("html", pa.string()), ("base", pa.string()), ("letti", pa.int64()), ("totale", pa.int64()), ("errore", pa.string())])

    def window(n: int, first: int, last: int) -> Iterator[tuple]:
        read, total = 0, None
        for number in range(1, most + 1):
            url = archive.listing_url(page, first, last, number, rows)
            try:
                html = mixed_text(fetch(url))
            except FAILURES as e:
                yield n * 1000 + number, first, None, url, 0, total, f"{type(e).__name__}: {e}".split("\n")[0]
                return
            found = len(archive.entries(html, url))
            total = archive.stated(html) if total is None else total
            yield n * 1000 + number, first, html, url, found, total, None
            read += found
            if not found or total is None or read >= total:
                return

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.to_pylist():
                if fetch.late():
                    return
                for row in window(x["n"], x["da"], x["a"]):
                    yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, kind, strict=True)], schema=kind)

    return windows.select("n", "da", "a").repartition(TASKS).mapInArrow(run, "page long, da long, html string, base string, letti long, totale long, errore string")


def coordinated(spark: SparkSession, index: str, fetch: Fetcher) -> tuple[DataFrame, int]:
    """The consolidated texts behind an index page, an address once, and how many pages could not be read."""
    first = Written(fetched(spark.createDataFrame([(index,)], "url string"), fetch), "consolidated-index")
    found = archive.parse_index(first.df.where("testo is not null").select(F.lit(1).alias("page"), F.col("testo").alias("html"), F.col("url").alias("base")))
    pages = Written(fetched(found, fetch), "consolidated-pages")
    named = pages.df.where("testo is not null").join(found.select("url", "nome", F.col("pos").alias("page")), "url")
    acts = archive.first_by_url(archive.parse_category(named.select("page", F.col("testo").alias("html"), F.col("url").alias("base"), F.col("nome").alias("categoria"))))
    return acts, sum(x.df.where("errore is not null").count() for x in (first, pages))


def legislation(
    spark: SparkSession,
    page: str,
    first_year: int,
    last_year: int,
    fetch: Fetcher,
    target: str | None = None,
    index: str | None = None,
    most_new: int | None = None,
    reader: Callable[[bytes], str] = pdf_text,
) -> Result:
    """Lists the acts of some years, newest window first, fetches those that are not stored, and delivers them with their passages.

    With an index the consolidated texts follow, and stored ones that are no longer listed are retired. Acts that are not
    reached in time or within ``most_new`` tries are left for the next run, which finds the others stored. Without a target
    nothing is fetched but the listing: the rows are the acts that would be new.
    """
    listing = Written(listing_pages(archive.windows(spark, first_year, last_year), page, fetch), "listing")
    windows = listing.df.groupBy("da").agg(F.sum("letti").alias("letti"), F.max("totale").alias("totale"), F.max("errore").alias("errore"))
    bad = windows.where("errore is not null or letti < totale").count()
    acts = archive.first_by_url(archive.parse_listing(listing.df.where("html is not null"))).drop("totale")
    todo = [acts]
    if index and not fetch.late():
        current, errors = coordinated(spark, index, fetch)
        bad += errors + int(current.select("url").distinct().limit(sinks.LEAST_CURRENT).count() < sinks.LEAST_CURRENT)
        todo.append(current)
    parents = sinks.KeyedTable(spark, f"{target}/atto_normativo", ACT) if target else None
    if not parents:
        every = todo[0] if len(todo) == 1 else todo[0].unionByName(todo[1])
        return Result(1 if bad else 0, every, {"elencati": every.count(), "elenchi_incompleti": bad})
    total: dict[str, int] = {}
    for listed in todo:
        left = None if most_new is None else most_new - total.get("tentati", 0)
        new = Written(archive_runs.chosen(archive_runs.unknown(listed, parents.keys()), left).select("url"), "acts-to-fetch")
        texts = Written(fetched(new.df, fetch, lambda data: document_text(data, reader)), "act-texts")
        counts = archive_runs.deliver(spark, listed, texts.df, target, tried=True)
        total = {k: total.get(k, 0) + v for k, v in counts.items()}
    if len(todo) > 1 and not bad:
        total["ritirati"] = archive_runs.retire(spark, target, todo[1])
    return delivered(spark, target, total | {"elenchi_incompleti": bad})


def institutional_pages(spark: SparkSession, index: str, links: str, fetch: Fetcher, most: int = 40) -> DataFrame:
    """url, html, errore of the detail pages that an index page links to by a selector, ``most`` of them."""
    (page,) = fetched(spark.createDataFrame([(index,)], "url string"), fetch).collect()
    if page.errore:
        raise OSError(page.errore)
    found = institutional.links(page.testo, links, index)[:most]
    return fetched(spark.createDataFrame([(u,) for u in found], "url string"), fetch).withColumnRenamed("testo", "html")


def posts_with_images(spark: SparkSession, endpoint: str, fonte: int, now: Column, folder: str | None = None, days_ahead: int = wp_json.DAYS_AHEAD) -> DataFrame:
    """The events of a paged endpoint with the addresses of the images that they name, asked for in blocks."""
    rest.register(spark)
    options = {"endpoints": f'[{{"fonte_id": {fonte}, "url": "{endpoint}"}}]'} | ({"folder": folder} if folder else {})
    pages = Written(spark.read.format("paged_json").options(**options).load(), "posts")
    wanted = wp_json.wanted_media(pages.df, now, days_ahead=days_ahead)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transport = rest.from_folder(folder) if folder else rest.get
        for batch in batches:
            got = list(rest.media_urls(endpoint, batch.column("media").to_pylist(), transport))
            yield pa.RecordBatch.from_arrays([pa.array([m for m, _ in got], pa.int64()), pa.array([u for _, u in got], pa.string())], ["media", "immagine"])

    images = wanted.select(F.col("media").cast("long").alias("media")).distinct().mapInArrow(run, "media long, immagine string")
    return wp_json.parse(pages.df.select("fonte_id", "json"), now, images, days_ahead=days_ahead)
