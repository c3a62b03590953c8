"""Queries on delivery: known rows, reuse, rotation, upserts, retirement, run logs, micro-batches."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import archive_runs, enrich, numbering, sinks
from ..streaming import upsert
from ..tables import shared_folder
from .registry import query, table


def _events(spark, d):
    """Event documents at midnight, a third of them with a clock time; five sources."""
    e = table(spark, d, "events")
    ts = F.expr("timestamp_seconds((19723 + event_id % 30) * 86400 + case when event_id % 3 = 0 then 3600 * (1 + event_id % 20) else 0 end)")
    return e.select(F.expr("cast(user_id % 5 as int)").alias("fonte_id"), F.col("event_id").alias("pos"), F.concat(F.lit("Evento n "), "event_id").alias("titolo"), F.expr("case when event_id % 10 = 7 then '' else concat('https://e.example/', event_id) end").alias("url"), F.lit(None).cast("string").alias("testo"), F.lit(None).cast("string").alias("immagine"), ts.alias("data"), F.lit(None).cast("string").alias("luogo"))


def _known(docs):
    """Half of the events are stored: some with a time on their day, some without, some on another day."""
    stored = docs.where("pos % 2 = 0")
    shift = F.expr("case pos % 8 when 0 then interval 20 hours when 2 then interval 0 hours when 4 then interval 30 hours else interval 21 hours end")
    from ..functions.similarity import dedup_key

    return stored.select(dedup_key(F.col("titolo"), F.col("data")).alias("dedup_key"), (F.date_trunc("day", "data") + shift).alias("data_inizio"))


_ROUTED = """
WITH e AS (SELECT event_id AS pos, (user_id % 5)::INTEGER AS fonte_id, event_id % 30 AS day FROM events WHERE event_id % 3 <> 0 AND event_id % 10 <> 7),
r AS (SELECT *, 'evento n ' || pos || '|' || strftime(DATE '2024-01-01' + day::INTEGER, '%Y-%m-%d') AS k, CASE WHEN pos % 2 = 1 THEN 'new' WHEN pos % 8 IN (0, 6) THEN 'reuse' ELSE 'retry' END AS via FROM e)"""


@query(_ROUTED + " SELECT pos, fonte_id, k AS dedup_key, via FROM r")
def known_time_routes(spark, d):
    docs = _events(spark, d)
    return enrich.route(docs, _known(docs)).select("pos", "fonte_id", "dedup_key", "via")


@query(_ROUTED + """, n AS (SELECT fonte_id, pos, row_number() OVER (PARTITION BY fonte_id ORDER BY day, pos) - 1 AS rn FROM r WHERE via = 'new'),
t AS (SELECT fonte_id, pos, row_number() OVER (PARTITION BY fonte_id ORDER BY k, pos) - 1 AS rn, count(*) OVER (PARTITION BY fonte_id) AS n FROM r WHERE via = 'retry'),
c AS (SELECT fonte_id, pos, rn AS turno FROM n UNION ALL SELECT fonte_id, pos, ((rn - 9 * 600) % n + n) % n + (SELECT count(*) FROM n x WHERE x.fonte_id = t.fonte_id) FROM t)
SELECT fonte_id, pos, turno::BIGINT AS turno FROM c WHERE turno < 600""")
def retry_rotation(spark, d):
    docs = _events(spark, d)
    return enrich.to_open(enrich.route(docs, _known(docs)), run=9, most=600).select("fonte_id", "pos", "turno")


@query("""
SELECT event_id AS pos, strftime(DATE '2024-01-01' + (event_id % 30)::INTEGER + to_hours(CASE WHEN event_id % 3 = 0 THEN 1 + event_id % 20 WHEN event_id % 10 = 7 THEN 0 WHEN event_id % 8 = 0 THEN 20 WHEN event_id % 8 = 6 THEN 21 WHEN event_id % 2 = 1 AND event_id % 7 < 3 THEN 18 ELSE 0 END), '%Y-%m-%dT%H:%M:%S.000Z') AS data FROM events""")
def known_time_reuse(spark, d):
    from ..functions.dates import iso_instant

    docs = _events(spark, d)
    # what the detail pages of new events say: some a time on the day, some none, some one on another day
    details = docs.where("pos % 2 = 1").select("url", (F.date_trunc("day", "data") + F.expr("case when pos % 7 < 3 then interval 18 hours when pos % 7 < 5 then null else interval 40 hours end")).alias("ora"))
    return enrich.enrich(docs, _known(docs), details, run=0, most=1_000_000_000).select("pos", iso_instant(F.col("data")).alias("data"))


@query("SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey % 3 ORDER BY o_orderdate, o_orderkey) - 1 AS rn, count(*) OVER (PARTITION BY o_custkey % 3) AS n FROM orders")
def row_numbers(spark, d):
    o = table(spark, d, "orders").withColumn("g", F.expr("o_custkey % 3"))
    return numbering.row_numbers(o, ["g"], ["o_orderdate", "o_orderkey"], "rn", "n").select("o_custkey", "o_orderkey", "rn", "n")


@query("SELECT 'u' || o_orderkey AS url, o_orderdate::DATE AS data FROM orders WHERE o_orderkey % 3 <> 0")
def known_anti(spark, d):
    o = table(spark, d, "orders")
    listed = o.select(F.concat(F.lit("u"), "o_orderkey").alias("url"), F.col("o_orderdate").cast("date").alias("data"))
    return archive_runs.unknown(listed, o.where("o_orderkey % 3 = 0").select(F.concat(F.lit("u"), "o_orderkey").alias("dedup_key")))


def _table(spark, schema="dedup_key string, v long", key="dedup_key"):
    return sinks.KeyedTable(spark, f"{shared_folder(spark)}/lodestrand/table-{uuid.uuid4().hex}", schema, key)


@query("""
WITH a AS (SELECT 0 AS run, o_custkey % 400 AS k, o_orderkey AS v FROM orders WHERE o_orderkey % 3 = 0 UNION ALL SELECT 1, o_custkey % 500, o_orderkey FROM orders WHERE o_orderkey % 3 = 1 UNION ALL SELECT 2, o_custkey % 300, o_orderkey FROM orders WHERE o_orderkey % 3 = 2),
r AS (SELECT k, min(run) AS first FROM a GROUP BY k)
SELECT a.run::BIGINT AS run, count(DISTINCT a.k) AS scritte, count(DISTINCT a.k) FILTER (WHERE r.first = a.run) AS nuove FROM a JOIN r USING (k) GROUP BY a.run""")
def upsert_new_count(spark, d):
    o, t, out = table(spark, d, "orders"), _table(spark), []
    for run, size in enumerate((400, 500, 300)):
        rows = o.where(f"o_orderkey % 3 = {run}").select(F.expr(f"cast(o_custkey % {size} as string)").alias("dedup_key"), F.col("o_orderkey").alias("v"))
        n = t.upsert(rows)
        out.append((run, n["scritte"], n["nuove"]))
    return spark.createDataFrame(out, "run long, scritte long, nuove long")


@query("""
WITH a AS (SELECT o_orderkey % 2 AS run, o_custkey AS k, max(o_orderkey) AS v FROM orders GROUP BY 1, 2)
SELECT k::VARCHAR AS dedup_key, max_by(v, run) AS v FROM a GROUP BY k""")
def upsert_rows(spark, d):
    o, t = table(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("dedup_key"), F.col("o_orderkey").alias("v")), _table(spark)
    for run in (0, 1):
        t.upsert(o.where(f"v % 2 = {run}"))
    t.upsert(o.where("v % 2 = 1"), 1)  # the same delivery again changes nothing
    t.compact()
    return t.read()


@query("SELECT 'u' || p_partkey AS url FROM part WHERE p_size % 2 = 0 AND p_partkey % 3 <> 0")
def retire_guard(spark, d):
    p = table(spark, d, "part").select(F.concat(F.lit("u"), "p_partkey").alias("url"), F.expr("p_size % 2 = 0").alias("coordinato"), "p_partkey")
    return sinks.retired(p, p.where("p_partkey % 3 = 0")).select("url")


@query("""
SELECT l_orderkey % 20 AS giro, count(*) AS tentati, count(*) FILTER (WHERE l_linenumber % 7 <> 0) AS scritti, count(*) FILTER (WHERE l_linenumber % 7 <> 0 AND l_returnflag = 'N') AS nuovi,
count(*) FILTER (WHERE l_linenumber % 7 <> 0 AND l_quantity < 3) AS senza_testo, count(*) FILTER (WHERE l_linenumber % 7 = 0) AS errori FROM lineitem GROUP BY 1""")
def run_counters(spark, d):
    li = table(spark, d, "lineitem").select(F.expr("l_orderkey % 20").alias("giro"), F.expr("l_linenumber % 7 != 0").alias("scritto"), F.expr("l_returnflag = 'N'").alias("nuovo"), F.expr("case when l_quantity < 3 then 0 else l_quantity end").alias("caratteri"), F.expr("case when l_linenumber % 7 = 0 then 'x' end").alias("errore"))
    return sinks.counters(li.groupBy("giro"))


@query("""
WITH l AS (SELECT (o_custkey % 10)::INTEGER AS fonte_id, CASE WHEN o_orderkey % 2 = 0 THEN 'notizia' ELSE 'evento' END AS tipo, o_orderstatus AS s, o_orderkey % 30 AS righe, o_orderkey % 7 AS nuove FROM orders)
SELECT fonte_id, tipo, sum(righe)::BIGINT AS righe, sum(nuove)::BIGINT AS nuove, CASE WHEN sum(righe) > 0 THEN round(sum(nuove)::DOUBLE / sum(righe), 9) END AS quota FROM l WHERE s <> 'F' GROUP BY fonte_id, tipo""")
def run_log_novelty(spark, d):
    o = table(spark, d, "orders")
    log = o.select(F.expr("cast(o_custkey % 10 as int)").alias("fonte_id"), F.expr("case when o_orderkey % 2 = 0 then 'notizia' else 'evento' end").alias("tipo"), F.expr("case when o_orderstatus = 'F' then 'errore' else 'ok' end").alias("esito"), F.expr("o_orderkey % 30").alias("n_righe"), F.expr("o_orderkey % 7").alias("nuove"))
    return sinks.novelty(log).withColumn("quota", F.round("quota", 9))


@query("SELECT e::BIGINT AS errori, w::BIGINT AS scritti, e > 3 AND e * 20 > w AS guasto FROM (SELECT o_custkey % 8 AS e, (o_custkey % 8) * 10 + o_orderkey % 120 AS w FROM orders GROUP BY ALL)")
def error_gate(spark, d):
    o = table(spark, d, "orders").selectExpr("o_custkey % 8 as errori", "(o_custkey % 8) * 10 + o_orderkey % 120 as scritti").distinct()
    rows = [(r.errori, r.scritti, sinks.too_many_errors(r.errori, r.scritti)) for r in o.collect()]  # 8 * 120 rows at most
    return spark.createDataFrame(rows, "errori long, scritti long, guasto boolean")


@query("SELECT user_id::VARCHAR AS dedup_key, max(event_id) AS v FROM events GROUP BY user_id")
def stream_upsert(spark, d):
    t, folder = _table(spark), f"{shared_folder(spark)}/lodestrand/stream-{uuid.uuid4().hex}"
    events = table(spark, d, "events").select(F.col("user_id").cast("string").alias("dedup_key"), F.col("event_id").alias("v"))
    for part in (0, 1):  # two landings, two runs of the query, one checkpoint
        half = events.where("v < 5000") if part == 0 else events.where("v >= 5000")
        half.write.mode("append").json(f"{folder}/in")
        upsert.upserts(upsert.landed(spark, f"{folder}/in", "dedup_key string, v long"), t, f"{folder}/state").awaitTermination()
    return t.read()
