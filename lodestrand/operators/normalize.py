"""From raw documents to the rows of the news and event tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import iso_instant, months_back
from ..functions.similarity import THRESHOLD, dedup_key
from ..functions.text import excerpt
from ..sources.html_list import texts
from .dedup import keep_first

EXCERPT, MONTHS = 280, 2


def recent(docs: DataFrame, now: Column, months: int = MONTHS) -> DataFrame:
    """Documents not older than midnight of the same day some months ago; those without a date count as of now."""
    return docs.withColumn("data", F.coalesce("data", now)).where(F.col("data") >= months_back(now, months))


def news(docs: DataFrame, now: Column, months: int = MONTHS, length: int = EXCERPT, threshold: float = THRESHOLD) -> DataFrame:
    """News rows: recent documents, near-equal titles of a source and day once, the text cut to an excerpt."""
    kept = keep_first(recent(docs, now, months), threshold)
    return kept.select(
        "titolo", excerpt(texts(F.col("testo")), length).alias("estratto"), "immagine", "url", iso_instant(F.col("data")).alias("data"), "fonte_id", dedup_key(F.col("titolo"), F.col("data")).alias("dedup_key")
    )


def events(docs: DataFrame, length: int = EXCERPT, threshold: float = THRESHOLD) -> DataFrame:
    """Event rows: documents with a date, near-equal titles of a source and day once."""
    kept = keep_first(docs.where("data is not null"), threshold)
    return kept.select(
        "titolo", iso_instant(F.col("data")).alias("data_inizio"), "luogo", excerpt(texts(F.col("testo")), length).alias("descrizione"), "immagine", "url", "fonte_id", dedup_key(F.col("titolo"), F.col("data")).alias("dedup_key")
    )
