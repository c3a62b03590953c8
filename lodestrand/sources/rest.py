"""Fetching: retries, gateway fallback, paged listings. The transport is a function, so runs without a network read files.

The paged reader is a Spark data source: every endpoint is a task, for its pages end where the server says so, and the fetched pages never pass the driver.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from hashlib import sha1
from pathlib import Path
from urllib.error import HTTPError
from urllib.parse import quote
from urllib.request import Request, urlopen

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Seconds in front of each try, and of a request at most.
WAITS, TIMEOUT = (0, 3, 10), 60
HEADERS = {"User-Agent": "Mozilla/5.0 (compatible; lodestrand)", "Accept": "*/*"}
PAGE_SIZE, MOST_PAGES, MEDIA_BLOCK = 100, 20, 100
#: Characters of a file name in a landing folder.
LONGEST_NAME = 180
FIELDS = "id,link,title,acf,featured_media"


class Missing(Exception):
    """The address does not exist (404), or a listing has no such page (400)."""

    def __init__(self, status: int):
        super().__init__(f"status {status}")
        self.status = status


class Refused(Exception):
    """The server refuses this client (403, 429)."""


def get(url: str) -> bytes:
    """One request over the network."""
    try:
        with urlopen(Request(url, headers=HEADERS), timeout=TIMEOUT) as answer:
            return answer.read()
    except HTTPError as e:
        if e.code in (400, 404):
            raise Missing(e.code) from e
        if e.code in (403, 429):
            raise Refused(f"status {e.code}") from e
        raise OSError(f"status {e.code} from {url}") from e


def file_name(url: str) -> str:
    """The name of an address in a landing folder: each character that no file name has as "_", a long one cut and told by its digest."""
    plain = "".join(c if c.isalnum() or c in ".-=&" else "_" for c in url)
    return plain if len(plain) <= LONGEST_NAME else f"{plain[:LONGEST_NAME - 41]}-{sha1(url.encode()).hexdigest()}"


def from_folder(folder: str) -> Callable[[str], bytes]:
    """A transport that reads files named by the address."""

    def read(url: str) -> bytes:
        path = Path(folder) / file_name(url)
        if not path.exists():
            raise Missing(404)
        return path.read_bytes()

    return read


def retried(url: str, transport: Callable[[str], bytes] = get, waits: tuple = WAITS, sleep: Callable = time.sleep) -> bytes:
    """Up to len(waits) tries; a missing page ends them at once."""
    last: Exception | None = None
    for wait in waits:
        sleep(wait)
        try:
            return transport(url)
        except Missing:
            raise
        except OSError as e:
            last = e
    raise last or OSError(url)


def with_gateway(url: str, transport: Callable[[str], bytes], gateway: Callable[[str], bytes] | None = None) -> bytes:
    """A refused request goes through the gateway, if there is one."""
    try:
        return transport(url)
    except Refused:
        if gateway is None:
            raise
        return gateway(url)


def through(address: str, transport: Callable[[str], bytes]) -> Callable[[str], bytes]:
    """A gateway that fetches the address appended to its own."""
    return lambda url: transport(address + quote(url, safe=""))


def page_url(endpoint: str, page: int) -> str:
    return f"{endpoint}?per_page={PAGE_SIZE}&page={page}&_fields={FIELDS}"


def pages(endpoint: str, transport: Callable[[str], bytes] = get, most: int = MOST_PAGES) -> Iterator[str]:
    """The JSON pages of a listing: ends at a short or empty page, or where the server knows no further page."""
    for n in range(1, most + 1):
        try:
            text = transport(page_url(endpoint, n)).decode()
        except Missing as e:
            if e.status == 400 and n > 1 or e.status == 404 and n > 1:
                return
            raise
        found = json.loads(text)
        if not isinstance(found, list) or not found:
            return
        yield text
        if len(found) < PAGE_SIZE:
            return


def media_urls(endpoint: str, ids: list[int], transport: Callable[[str], bytes] = get) -> Iterator[tuple[int, str]]:
    """(media, address) for ids asked in blocks; a block that fails is skipped, for images are an extra."""
    media = endpoint.rsplit("/", 1)[0] + "/media"
    for at in range(0, len(ids), MEDIA_BLOCK):
        part = ",".join(map(str, ids[at : at + MEDIA_BLOCK]))
        try:
            found = json.loads(transport(f"{media}?include={part}&per_page={MEDIA_BLOCK}&_fields=id,source_url"))
        except (OSError, Missing, Refused, ValueError):
            continue
        for m in found:
            if isinstance(m, dict) and m.get("id") is not None and m.get("source_url"):
                yield int(m["id"]), m["source_url"]


class Endpoint(InputPartition):
    def __init__(self, fonte_id: int, url: str):
        self.fonte_id, self.url = fonte_id, url


class PagedReader(DataSourceReader):
    def __init__(self, options: dict):
        self.endpoints = json.loads(options["endpoints"])
        self.folder, self.most = options.get("folder"), int(options.get("most", MOST_PAGES))

    def partitions(self) -> list[InputPartition]:
        return [Endpoint(e["fonte_id"], e["url"]) for e in self.endpoints]

    def read(self, part: InputPartition) -> Iterator[tuple]:
        transport = from_folder(self.folder) if self.folder else get
        for n, text in enumerate(pages(part.url, transport, self.most)):
            yield part.fonte_id, n, text


class PagedJson(DataSource):
    """format("paged_json"): columns fonte_id, page, json. Options: endpoints (JSON list of fonte_id and url), folder, most."""

    @classmethod
    def name(cls) -> str:
        return "paged_json"

    def schema(self) -> str:
        return "fonte_id int, page int, json string"

    def reader(self, schema) -> DataSourceReader:
        return PagedReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PagedJson)
