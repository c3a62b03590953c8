"""Events of WordPress JSON whose dates stand in custom fields: one row for each occurrence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_of, parse_yyyymmdd
from ..functions.text import blank_to_null, squeeze, strip
from .html_list import texts
from .schema import RAW_COLUMNS

DAYS_AHEAD, MOST_OCCURRENCES = 30, 4


def _kind(v: Column, path: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(v, path, "variant"))


def _string(v: Column, path: str) -> Column:
    """A JSON string; other types (false stands for an empty field) are null."""
    return F.when(_kind(v, path) == "STRING", F.try_variant_get(v, path, "string"))


def occurrences(fields: Column, now: Column, days_ahead: int = DAYS_AHEAD, most: int = MOST_OCCURRENCES) -> Column:
    """The distinct days of the single and the recurring dates from today to ``days_ahead`` days on, the first ``most``."""
    single = F.array(parse_yyyymmdd(F.try_variant_get(fields, "$.data_inizio", "string")))
    recurring = F.transform(F.try_variant_get(fields, "$.data_ricorrente", "array<variant>"), lambda x: parse_yyyymmdd(F.try_variant_get(x, "$.data", "string")))
    today = date_of(now)
    every = F.array_union(single, F.coalesce(recurring, F.array().cast("array<timestamp>")))
    return F.slice(F.array_sort(F.filter(every, lambda d: d.isNotNull() & date_of(d).between(today, F.date_add(today, days_ahead)))), F.lit(1), F.lit(most))


def posts(catalogue: DataFrame, json: str = "json") -> DataFrame:
    """fonte_id, post (number), v (variant) for the JSON objects of each array; other elements go."""
    each = catalogue.select("fonte_id", F.posexplode(F.from_json(json, "array<string>")).alias("post", "raw"))
    parsed = each.select("fonte_id", F.col("post").cast("long").alias("post"), F.try_parse_json("raw").alias("v"))
    return parsed.where(F.col("v").isNotNull() & _kind(F.col("v"), "$.acf").startswith("OBJECT"))


def parse(catalogue: DataFrame, now: Column, images: DataFrame | None = None, json: str = "json", days_ahead: int = DAYS_AHEAD, most: int = MOST_OCCURRENCES) -> DataFrame:
    """Documents of the posts in JSON arrays; images: table (media long, immagine string), each media once.

    Posts without a title, a link or a date in the window go. The images are joined after that, so only the kept posts
    look theirs up; Spark broadcasts the table if it is small.
    """
    v = F.col("v")
    # plain columns come first, texts of the four marked-up fields go to Python in one batch
    raw = posts(catalogue, json).select(
        "fonte_id", "post", F.coalesce(strip(_string(v, "$.link")), F.lit("")).alias("url"), _string(v, "$.title.rendered").alias("title"), F.try_variant_get(v, "$.featured_media", "double").cast("long").alias("media"),
        occurrences(F.try_variant_get(v, "$.acf", "variant"), now, days_ahead, most).alias("giorni"), *[_string(v, f"$.acf.event_{c}").alias(c) for c in ("dove", "quando", "ingresso")],
    ).where("url != '' and title is not null and size(giorni) > 0")
    clean = raw.select("fonte_id", "post", "url", "media", "giorni", *[blank_to_null(squeeze(texts(F.col(c)))).alias(c) for c in ("title", "dove", "quando", "ingresso")]).where("title is not null")
    text = blank_to_null(F.concat_ws(" — ", "quando", F.concat(F.lit("Ingresso: "), F.col("ingresso"))))
    rows = clean.select("fonte_id", "post", "title", "url", "media", "dove", text.alias("testo"), F.posexplode("giorni").alias("n", "data"))
    if images is None:
        rows = rows.withColumn("immagine", F.lit(None).cast("string"))
    else:
        rows = rows.join(images.select(F.col("media").cast("long").alias("media"), "immagine"), "media", "left")
    return rows.select("fonte_id", (F.col("post") * 1000 + F.col("n")).alias("pos"), F.col("title").alias("titolo"), "url", "testo", "immagine", "data", F.col("dove").alias("luogo")).select(RAW_COLUMNS)


def wanted_media(catalogue: DataFrame, now: Column, json: str = "json", days_ahead: int = DAYS_AHEAD) -> DataFrame:
    """The distinct media ids (not 0) of posts with an occurrence in the window: what to ask the media endpoint for."""
    v = F.col("v")
    days = occurrences(F.try_variant_get(v, "$.acf", "variant"), now, days_ahead)
    return posts(catalogue, json).where(F.size(days) > 0).select(F.try_variant_get(v, "$.featured_media", "double").cast("long").alias("media")).where("media != 0").distinct()
