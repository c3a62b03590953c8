"""Queries on dates: spellings that must read back as what they were made from."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates
from .registry import query, table

_ISO = "'%Y-%m-%dT%H:%M:%S.000Z'"
#: Clock time of an order, from its key.
_AT = "(o_orderdate + to_hours((o_orderkey % 24)::INTEGER) + to_minutes((o_orderkey * 7 % 60)::INTEGER))"


def _orders(spark, d):
    """o_orderkey, day (date), ts (timestamp): an order date with a clock time made from the key."""
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    return o.withColumn("ts", dates.instant(F.unix_date("day"), F.expr("o_orderkey % 24"), F.expr("o_orderkey * 7 % 60")))


def _clock(sep=":"):
    return F.concat(F.expr("lpad(cast(o_orderkey % 24 as string), 2, '0')"), F.lit(sep), F.expr("lpad(cast(o_orderkey * 7 % 60 as string), 2, '0')"))


def _italian(full=True):
    name = F.element_at(F.array(*[F.lit(m) for m in dates.MONTHS]), F.month("day"))
    return name if full else F.substring(name, 1, 3)


@query(f"""
SELECT o_orderkey, strftime(CASE o_orderkey % 6 WHEN 0 THEN {_AT} - INTERVAL 2 HOUR WHEN 1 THEN {_AT} + INTERVAL 330 MINUTE WHEN 2 THEN {_AT} - INTERVAL 1 HOUR ELSE {_AT} END, {_ISO}) AS istante,
strftime({_AT}, {_ISO}) AS parete FROM orders""")
def date_rfc_roundtrip(spark, d):
    o = _orders(spark, d)
    day, year = F.dayofmonth("day").cast("string"), F.year("day").cast("string")
    english = F.date_format("day", "MMM")
    spell = (
        F.when(F.expr("o_orderkey % 6 = 0"), F.concat(F.lit("Wed, "), F.lpad(day, 2, "0"), F.lit(" "), english, F.lit(" "), year, F.lit(" "), _clock(), F.lit(":00 +0200")))
        .when(F.expr("o_orderkey % 6 = 1"), F.concat(day, F.lit(" "), english, F.lit(" "), year, F.lit(" "), _clock(), F.lit(" -05:30")))
        .when(F.expr("o_orderkey % 6 = 2"), F.concat(day, F.lit(" "), english, F.lit(" "), year, F.lit(" "), _clock(), F.lit(" CET")))
        .when(F.expr("o_orderkey % 6 = 3"), F.concat(F.lit("martedì, "), day, F.lit(" "), F.initcap(_italian()), F.lit(" "), year, F.lit(" -"), _clock()))
        .when(F.expr("o_orderkey % 6 = 4"), F.concat(day, F.lit(" "), _italian(False), F.lit(" "), year, F.lit(", ore "), _clock(".")))
        .otherwise(F.concat(F.lit("  "), day, F.lit(" "), _italian(False), F.lit(" "), year, F.lit("\n"), _clock(), F.lit(" XYZ ")))
    )
    return o.select("o_orderkey", dates.iso_instant(dates.parse_date(spell, zoned=True)).alias("istante"), dates.iso_instant(dates.parse_date(spell)).alias("parete"))


@query(f"SELECT o_orderkey, strftime(CASE o_orderkey % 4 WHEN 0 THEN {_AT} - INTERVAL 90 MINUTE WHEN 1 THEN {_AT} WHEN 2 THEN o_orderdate ELSE {_AT} END, {_ISO}) AS istante FROM orders")
def date_iso_roundtrip(spark, d):
    o = _orders(spark, d)
    k = F.expr("o_orderkey % 4")
    text = (
        F.when(k == 0, F.concat(F.date_format("day", "yyyy-MM-dd"), F.lit("T"), _clock(), F.lit(":00+01:30")))
        .when(k == 1, F.concat(F.date_format("day", "yyyy-MM-dd"), F.lit(" "), _clock(), F.lit(":00.000Z")))
        .when(k == 2, F.date_format("day", "yyyyMMdd"))
        .otherwise(F.concat(F.date_format("day", "yyyyMMdd"), F.lit("T"), _clock("")))
    )
    return o.select("o_orderkey", dates.iso_instant(dates.parse_date(text)).alias("istante"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 8 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS giorno FROM orders")
def date_numeric_roundtrip(spark, d):
    o = _orders(spark, d)
    text = F.when(F.expr("o_orderkey % 9 = 8"), F.concat(F.lit("il "), F.date_format("day", "dd/MM/yyyy"))).when(F.expr("o_orderkey % 2 = 0"), F.date_format("day", "dd/MM/yyyy")).otherwise(F.date_format("day", "d-M-yyyy"))
    return o.select("o_orderkey", dates.iso_day(dates.date_of(dates.parse_date(text))).alias("giorno"))


@query("""
SELECT o_orderkey, strftime(make_date(year(o_orderdate), 1, 1) + to_months((o_orderkey % 15)::INTEGER) + to_days((o_orderkey % 35)::INTEGER - 1), '%Y-%m-%d') AS giorno FROM orders""")
def date_overflow(spark, d):
    o = _orders(spark, d)
    text = F.concat(F.expr("cast(o_orderkey % 35 as string)"), F.lit("/"), F.expr("cast(o_orderkey % 15 + 1 as string)"), F.lit("/"), F.year("day").cast("string"))
    return o.select("o_orderkey", dates.iso_day(dates.date_of(dates.parse_date(text))).alias("giorno"))


@query("""
SELECT o_orderkey, strftime(try_strptime(s, '%Y%m%d'), '%Y-%m-%d') AS giorno FROM (
SELECT o_orderkey, CASE WHEN o_orderkey % 17 = 0 THEN '2026' ELSE strftime(o_orderdate, '%Y') || lpad((o_orderkey % 14)::VARCHAR, 2, '0') || lpad((o_orderkey % 33)::VARCHAR, 2, '0') END AS s FROM orders)""")
def yyyymmdd_strict(spark, d):
    o = _orders(spark, d)
    text = F.when(F.expr("o_orderkey % 17 = 0"), "2026").otherwise(F.concat(F.year("day").cast("string"), F.expr("lpad(cast(o_orderkey % 14 as string), 2, '0')"), F.expr("lpad(cast(o_orderkey % 33 as string), 2, '0')")))
    return o.select("o_orderkey", dates.iso_day(dates.date_of(dates.parse_yyyymmdd(text))).alias("giorno"))


_SUNDAY = "(last_day({0}) - (dayofweek(last_day({0})))::INTEGER)"
_UTC = f"""
CASE WHEN t >= {_SUNDAY.format("make_date(year(t), 3, 1)")} + INTERVAL 2 HOUR AND t < {_SUNDAY.format("make_date(year(t), 10, 1)")} + INTERVAL 3 HOUR THEN t - INTERVAL 2 HOUR ELSE t - INTERVAL 1 HOUR END"""


def _deadline():
    return F.concat(F.lit("ore "), _clock("."), F.lit(" di lunedì "), F.dayofmonth("day").cast("string"), F.lit(" "), F.initcap(_italian()), F.lit(" "), F.year("day").cast("string"))


@query(f"SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 9 THEN NULL ELSE strftime({_UTC}, {_ISO}) END AS scadenza FROM (SELECT o_orderkey, {_AT} AS t FROM orders)")
def deadline_utc(spark, d):
    o = _orders(spark, d)
    text = F.when(F.expr("o_orderkey % 10 = 9"), F.concat(F.lit("entro il giorno "), F.dayofmonth("day").cast("string"))).when(F.expr("o_orderkey % 3 = 0"), F.concat(F.lit("dalle ore 08:00 di 1 gennaio 2020 ed entro le "), _deadline())).otherwise(F.concat(F.lit("entro le "), _deadline(), F.lit(" a mezzo posta")))
    return o.select("o_orderkey", dates.iso_instant(dates.parse_deadline(text)).alias("scadenza"))


@query(f"SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN strftime({_UTC}, {_ISO}) END AS scadenza FROM (SELECT o_orderkey, {_AT} AS t FROM orders)")
def deadline_prose(spark, d):
    o = _orders(spark, d)
    text = (
        F.when(F.expr("o_orderkey % 3 = 0"), F.concat(F.lit("Si apre a partire dalle ore 14:00 di giovedì 14 maggio 2026 e le domande, in carta semplice e complete di ogni allegato richiesto dal bando, arrivano sino alle "), _deadline(), F.lit(".")))
        .when(F.expr("o_orderkey % 3 = 1"), F.concat(F.lit("Lo sportello apre alle "), _deadline()))
        .otherwise(F.concat(F.lit("non oltre le "), _deadline(), F.lit(" oppure entro le ore 12:00 di 2 giugno 2026")))
    )
    return o.select("o_orderkey", dates.iso_instant(dates.parse_deadline(text, prose=True)).alias("scadenza"))


@query(f"SELECT o_orderkey, strftime(date_trunc('month', o_orderdate) - INTERVAL 2 MONTH + to_days((day(o_orderdate) - 1)::INTEGER), {_ISO}) AS soglia FROM orders")
def month_threshold(spark, d):
    return _orders(spark, d).select("o_orderkey", dates.iso_instant(dates.months_back(F.col("ts"), 2)).alias("soglia"))


@query("""
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN date_trunc('month', o_orderdate)::DATE ELSE o_orderdate::DATE END AS aggiornato FROM orders""")
def updated_to(spark, d):
    o = _orders(spark, d)
    long = F.concat(F.dayofmonth("day").cast("string"), F.lit(" "), _italian(), F.lit(" "), F.year("day").cast("string"))
    k = F.expr("o_orderkey % 4")
    text = (
        F.when(k == 0, F.concat(F.lit("Testo coordinato del "), long))
        .when(k == 1, F.concat(F.lit("Codice (aggiornamento a "), _italian(), F.lit(" "), F.year("day").cast("string"), F.lit(")")))
        .when(k == 2, F.concat(F.lit("Codice (Aggiornato al "), long, F.lit(")")))
        .otherwise(F.concat(F.lit("Codice (aggiornata all'"), long, F.lit(")")))
    )
    return o.select("o_orderkey", dates.parse_updated(text).alias("aggiornato"))
