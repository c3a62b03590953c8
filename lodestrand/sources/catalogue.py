"""The catalogue of sources, and which of them a run should read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .schema import DETAIL, SOURCE

#: Passes of a run: type, format and whether that pass looks at the hours of a source.
PASSES = [("notizia", "rss", False), ("evento", "html", False), ("evento", "json", True), ("istituzionale", "html", False)]
FORMATS, TYPES = ("rss", "html", "json"), ("notizia", "evento", "istituzionale")


def read(spark: SparkSession, path: str) -> DataFrame:
    """Sources of JSON files {"fonti": [...]}; a file without that list is an error."""
    return parse(spark.read.text(path, wholetext=True), "value")


def parse(df: DataFrame, json: str) -> DataFrame:
    listed = F.from_json(json, f"fonti array<struct<{_fields()}>>", {"mode": "FAILFAST"})["fonti"]
    checked = F.when(listed.isNull(), F.raise_error(F.lit("the catalogue has no list of sources"))).otherwise(listed)
    return df.select(F.explode(checked).alias("f")).select("f.*")


def _fields() -> str:
    return SOURCE.replace("id int, nome string, config ", "id:int,nome:string,config:")


def normal(config: Column) -> Column:
    """struct<url,tipo,formato,...>: a missing format is rss."""
    return config.withField("formato", F.coalesce(config["formato"], F.lit("rss")))


def due(sources: DataFrame, kind: str, form: str, hour: int | None = None) -> DataFrame:
    """The sources of a type and format with an address; with ``hour`` only those whose ore_utc is missing or has it."""
    c = F.col("config")
    found = sources.where((c["tipo"] == kind) & (c["formato"] == form) & (F.coalesce(c["url"], F.lit("")) != ""))
    return found if hour is None else found.where(c["ore_utc"].isNull() | F.array_contains(c["ore_utc"], F.lit(hour)))


def compatible(kind: str, form: str) -> bool:
    """JSON holds events only, institutional pages are HTML; news in HTML pages are accepted."""
    return kind in TYPES and form in FORMATS and (form != "json" or kind == "evento") and (kind != "istituzionale" or form == "html")


def detail_config(config: Column) -> Column:
    """The detail-page settings, max 8 unless set; null without a container."""
    d = F.from_json(config, DETAIL)
    return F.when(F.coalesce(d["contenitore"], F.lit("")) != "", d.withField("max", F.coalesce(d["max"], F.lit(8))))
