"""RSS 2.0 feeds through Spark's XML reader."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import parse_date
from ..functions.text import blank_to_null, first_image, strip
from .schema import RAW_COLUMNS

_LINK = "array<struct<_url:string>>"
ITEM = (
    f"title array<string>, link array<string>, description array<string>, pubDate array<string>, enclosure {_LINK}, `media:content` {_LINK}, "
    f"`media:thumbnail` {_LINK}, image array<string>, `content:encoded` array<string>"
)
_OPTIONS = {"mode": "FAILFAST", "attributePrefix": "_", "ignoreSurroundingSpaces": "true"}


def _first(item: Column, tag: str) -> Column:
    """The text of the first child element of that name; null if it is blank, whatever follows it."""
    return blank_to_null(strip(F.get(item[tag], F.lit(0))))


def image(item: Column) -> Column:
    """The attached, media, or stated image, else the first inline one of the body."""
    linked = [blank_to_null(F.get(item[t], F.lit(0))["_url"]) for t in ("enclosure", "media:content", "media:thumbnail")]
    stated = blank_to_null(strip(F.regexp_replace(F.get(item["image"], F.lit(0)), "<[^>]*>", "")))
    inline = [first_image(F.get(item[t], F.lit(0))) for t in ("content:encoded", "description")]
    return F.coalesce(*linked, stated, *inline)


def _documents(items: DataFrame, keep: list[str]) -> DataFrame:
    """items: pos, item and the columns to keep. Items without a title or a link go."""
    i = F.col("item")
    docs = items.select(
        *keep, "pos", _first(i, "title").alias("titolo"), _first(i, "link").alias("url"), _first(i, "description").alias("testo"), image(i).alias("immagine"),
        parse_date(_first(i, "pubDate"), zoned=True).alias("data"), F.lit(None).cast("string").alias("luogo"),
    )
    return docs.where("titolo is not null and url is not null")


def parse(feeds: DataFrame, xml: str = "xml") -> DataFrame:
    """Documents of the feeds in a string column; the column fonte_id goes along. A malformed feed raises."""
    schema = f"channel array<struct<item:array<struct<{_inner()}>>>>, item array<struct<{_inner()}>>"
    tree = F.from_xml(F.col(xml), schema, _OPTIONS)
    items = feeds.select("fonte_id", tree.alias("t")).select("fonte_id", F.posexplode(F.concat(F.coalesce(F.flatten(F.transform("t.channel", lambda c: F.coalesce(c["item"], F.array()))), F.array()), F.coalesce("t.item", F.array()))).alias("pos", "item"))
    return _documents(items.withColumn("pos", F.col("pos").cast("long")), ["fonte_id"]).select(RAW_COLUMNS)


def _inner() -> str:
    return ITEM.replace(" array", ": array")


def read(spark: SparkSession, path: str, fonte_id: int) -> DataFrame:
    """Documents of feed files, split by item wherever items stand; only the named elements are read."""
    rows = spark.read.format("xml").options(rowTag="item", **_OPTIONS).schema(ITEM).load(path)
    items = rows.select(F.lit(fonte_id).alias("fonte_id"), F.monotonically_increasing_id().alias("pos"), F.struct("*").alias("item"))
    return _documents(items, ["fonte_id"]).select(RAW_COLUMNS)
