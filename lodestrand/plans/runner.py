"""Runs: one source of news, events or institutional pages; job notices; legislation; all sources of a catalogue.

Pages and feeds are read from paths that Spark can open (a landing folder filled by sources.rest or any crawler). A run
without a target is a dry run: nothing is written, the rows come back.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import archive_runs, enrich, normalize, sinks
from ..sources import catalogue, html_list, institutional, notices, rss, schema, wp_json

#: The exit codes of a run.
OK, EMPTY, USAGE, UNCONFIGURED = 0, 1, 64, 78
TABLES = {"notizia": ("notizia", schema.NEWS), "evento": ("evento", schema.EVENT), "istituzionale": ("documento_istituzionale", schema.INSTITUTIONAL)}


@dataclass
class Job:
    """One source to read."""

    path: str
    tipo: str = "notizia"
    formato: str = "rss"
    fonte: int = 0
    base: str | None = None
    selettori: str | None = None
    dettaglio: str | None = None
    dettagli: str | None = None  # folder of fetched detail pages: JSON lines of url, html
    giorni_avanti: int = wp_json.DAYS_AHEAD
    immagini: str | None = None  # JSON lines of media, immagine
    giro: int | None = None
    target: str | None = None


@dataclass
class Result:
    code: int
    rows: DataFrame | None = None
    counts: dict = field(default_factory=dict)
    error: str | None = None


def _pages(spark: SparkSession, path: str, **columns) -> DataFrame:
    return spark.read.text(path, wholetext=True).select(F.col("value").alias("html"), *[F.lit(v).alias(k) for k, v in columns.items()])


def documents(spark: SparkSession, job: Job, now: dt.datetime, table: sinks.KeyedTable | None = None) -> DataFrame:
    """The raw documents of a job, events with the clock times that are known or found."""
    if job.formato == "rss":
        return rss.read(spark, job.path, job.fonte)
    if job.formato == "json":
        images = spark.read.schema("media long, immagine string").json(job.immagini) if job.immagini else None
        posts = spark.read.text(job.path, wholetext=True).select(F.lit(job.fonte).alias("fonte_id"), F.col("value").alias("json"))
        return wp_json.parse(posts, F.lit(now), images, days_ahead=job.giorni_avanti)
    docs = html_list.parse(_pages(spark, job.path, fonte_id=job.fonte, selettori=job.selettori, base=job.base))
    if not job.dettaglio or job.tipo != "evento":
        return docs
    set_ = spark.range(1).select(catalogue.detail_config(F.lit(job.dettaglio)).alias("d")).first().d
    if set_ is None:
        return docs
    known = table.read().select("dedup_key", F.to_timestamp("data_inizio").alias("data_inizio")) if table else spark.createDataFrame([], "dedup_key string, data_inizio timestamp")
    opened = spark.read.schema("url string, html string").json(job.dettagli) if job.dettagli else spark.createDataFrame([], "url string, html string")
    times = opened.select("url", enrich.detail_time(F.col("html"), F.lit(set_.contenitore), None if set_.etichetta is None else F.lit(set_.etichetta)).alias("ora"))
    return enrich.enrich(docs, known, times, now.hour if job.giro is None else job.giro, set_.max)


def run(spark: SparkSession, job: Job, now: dt.datetime) -> Result:
    """Reads, normalises and delivers one source. No row at all is an error: the source has changed its structure."""
    if not catalogue.compatible(job.tipo, job.formato) or (job.formato == "html" and not job.selettori):
        return Result(USAGE, error=f"{job.tipo} and {job.formato} don't go together, or selectors are missing")
    name, kind = TABLES[job.tipo]
    table = sinks.KeyedTable(spark, f"{job.target}/{name}", kind) if job.target else None
    log = f"{job.target}/ingestione_esito" if job.target else None
    said = {"fonte_id": job.fonte, "tipo": job.tipo}
    try:
        if job.tipo == "istituzionale":
            sel = spark.range(1).select(F.from_json(F.lit(job.selettori), "map<string,string>").alias("s")).first().s
            pages = spark.read.schema("url string, html string").json(job.path).withColumn("fonte_id", F.lit(job.fonte))
            n, rows = pages.count(), institutional.documents(pages, sel.get("titolo"), sel.get("testo"), sel.get("data"), sel.get("tipo_atto"))
        else:
            docs = documents(spark, job, now, table)
            n, rows = docs.count(), normalize.news(docs, F.lit(now)) if job.tipo == "notizia" else normalize.events(docs)
        if table is None:
            empty = job.tipo != "istituzionale" and not rows.limit(1).count()
            return Result(EMPTY if empty else OK, rows, {"documenti": n})
        counts = table.upsert(rows)
    except Exception as e:
        sinks.outcome(spark, log, esito="errore", errore=str(e), **said)
        return Result(EMPTY, error=str(e).split("\n")[0])
    if not counts["scritte"]:
        error = f"no row from {n} documents: has the source changed?"
        sinks.outcome(spark, log, esito="errore", documenti=n, n_righe=0, errore=error, **said)
        return Result(EMPTY, error=error)
    sinks.outcome(spark, log, esito="ok", documenti=n, n_righe=counts["scritte"], nuove=counts["nuove"], **said)
    return Result(OK, table.read(), {"documenti": n} | counts)


def run_all(spark: SparkSession, sources: DataFrame, folder: str, now: dt.datetime, target: str | None) -> tuple[int, list[str]]:
    """All due sources, pass by pass; one that fails does not stop the others. Returns the exit code and the names that failed.

    Pages lie in ``folder/<id>``. The catalogue is configuration: a row for each site, read by the driver.
    """
    failed = []
    for kind, form, by_hour in catalogue.PASSES:
        for s in catalogue.due(sources, kind, form, now.hour if by_hour else None).collect():
            c = s.config
            job = Job(f"{folder}/{s.id}", kind, form, s.id, c.base or c.url, c.selettori, c.dettaglio, giorni_avanti=c.giorni_avanti or wp_json.DAYS_AHEAD, target=target)
            if run(spark, job, now).code != OK:
                failed.append(s.nome)
    return (EMPTY if failed else OK), failed


def run_notices(spark: SparkSession, path: str, base: str, fonte: int = 0, limit: int = notices.LIMIT, target: str | None = None) -> Result:
    """The notices page: rows for the review queue, by address. No notice is an error."""
    found = notices.parse(_pages(spark, path, fonte_id=fonte, base=base), limit=limit)
    rows = notices.to_review(found)
    n = rows.count()
    log = f"{target}/ingestione_esito" if target else None
    if not n:
        sinks.outcome(spark, log, fonte_id=fonte, tipo="bando", esito="errore", documenti=0, errore="no notice was found")
        return Result(EMPTY, error="no notice was found")
    if target is None:
        return Result(OK, found, {"documenti": n})
    kind = "titolo string, url string, repertorio string, descrizione string, data_emissione string, scadenza_testo string, scadenza_il string, scadenza_origine string, scaduto boolean, allegati array<struct<nome:string,url:string>>"
    counts = sinks.KeyedTable(spark, f"{target}/bando", kind, "url").upsert(rows)
    sinks.outcome(spark, log, fonte_id=fonte, tipo="bando", esito="ok", documenti=n, n_righe=counts["scritte"], nuove=counts["nuove"])
    return Result(OK, rows, {"importati": counts["nuove"], "aggiornati": counts["scritte"] - counts["nuove"]})


def run_legislation(spark: SparkSession, listing: DataFrame, texts: DataFrame, target: str, most_new: int | None = None) -> Result:
    """New acts of a listing (archive.parse_listing or parse_category) with their texts (url, testo, errore), newest first.

    Known acts are left out before any text is split. ``most_new`` bounds the tries of a run, not its successes.
    """
    return delivered(spark, target, archive_runs.deliver(spark, listing, texts, target, most_new))


def delivered(spark: SparkSession, target: str, counts: dict) -> Result:
    """Logs a run on legislation and says whether it went well."""
    bad = sinks.too_many_errors(counts["errori"], counts["scritti"], counts["elenchi_incompleti"])
    sinks.outcome(spark, f"{target}/ingestione_esito", tipo="normativa", esito="errore" if bad else "ok", documenti=counts["elencati"], n_righe=counts["scritti"], nuove=counts["nuovi"])
    return Result(EMPTY if bad else OK, counts=counts)
