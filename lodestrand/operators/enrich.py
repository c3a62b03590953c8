"""Clock times for events whose list page gives only the day: known times are reused, the rest is read from detail pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_of, no_time, parse_date
from ..functions.similarity import dedup_key
from ..sources.html_list import container_text
from .numbering import row_numbers

MOST = 8


def detail_time(html: Column, container: Column, label: Column | None = None) -> Column:
    """The date and time in the text of a detail page's container, after the label if there is one; null at midnight."""
    text = container_text(html, container)
    if label is not None:
        at = F.position(label, text)
        text = F.when(label.isNull(), text).when(at > 0, F.substring(text, at + F.length(label), F.length(text)))
    ts = parse_date(text)
    return F.when(~no_time(ts), ts)


def candidates(docs: DataFrame) -> DataFrame:
    """The documents with a day, no time, and a link, with their dedup_key."""
    return docs.where(F.col("data").isNotNull() & no_time(F.col("data")) & (F.col("url") != "")).withColumn("dedup_key", dedup_key(F.col("titolo"), F.col("data")))


def route(docs: DataFrame, known: DataFrame) -> DataFrame:
    """Candidates with ``via``: new (not stored), reuse (stored with a time on that day: nota), retry (else). known: dedup_key, data_inizio."""
    stored = known.groupBy("dedup_key").agg(F.max("data_inizio").alias("nota"))
    at = F.col("nota")
    via = F.when(at.isNull(), "new").when(~no_time(at) & (date_of(at) == date_of(F.col("data"))), "reuse").otherwise("retry")
    return candidates(docs).join(stored, "dedup_key", "left").withColumn("via", via)


def to_open(routed: DataFrame, run: int, most: int = MOST) -> DataFrame:
    """fonte_id, pos, url, turno of the detail pages to open: for each source the first ``most`` of the new by date, then of the retries from a start that moves with ``run``."""
    new = row_numbers(routed.where("via = 'new'").select("fonte_id", "pos", "url", "data"), ["fonte_id"], ["data", "pos"], "rn", "n_new").where(F.col("rn") < most).select("fonte_id", "pos", "url", F.col("rn").alias("turno"))
    again = row_numbers(routed.where("via = 'retry'").select("fonte_id", "pos", "url", "dedup_key"), ["fonte_id"], ["dedup_key", "pos"], "rn", "n")
    turned = F.pmod(F.col("rn") - F.lit(run * most), F.col("n"))
    used = routed.where("via = 'new'").groupBy("fonte_id").agg(F.count("*").alias("used"))
    retries = again.where(turned < most).join(used, "fonte_id", "left").select("fonte_id", "pos", "url", (turned + F.coalesce("used", F.lit(0))).alias("turno")).where(F.col("turno") < most)
    return new.unionByName(retries)


def enrich(docs: DataFrame, known: DataFrame, details: DataFrame, run: int, most: int = MOST) -> DataFrame:
    """The documents with reused times, and times found on the pages to open; all others as they were.

    details: url, ora (timestamp or null), what the opened pages say. A time counts only on the document's own day.
    """
    routed = route(docs, known)
    opened = to_open(routed, run, most).select("fonte_id", "pos", "url")
    found = opened.join(details.select("url", "ora").dropDuplicates(["url"]), "url").select("fonte_id", "pos", "ora")
    reused = routed.where("via = 'reuse'").select("fonte_id", "pos", F.col("nota").alias("ora"))
    times = reused.unionByName(found).where("ora is not null")
    same = F.col("ora").isNotNull() & (date_of(F.col("ora")) == date_of(F.col("data")))
    return docs.join(times, ["fonte_id", "pos"], "left").withColumn("data", F.when(same, F.col("ora")).otherwise(F.col("data"))).select(docs.columns)
