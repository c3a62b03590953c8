"""Delivery of listed acts: what is new, its passages, and the run's counters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import archive
from ..sources.schema import ACT, PASSAGES
from ..tables import Written
from . import passages, sinks

CHILD = f"dedup_key string, brani {PASSAGES}"


def unknown(listed: DataFrame, known: DataFrame) -> DataFrame:
    """Listed acts whose address is not stored. The anti join comes before texts are fetched or split."""
    return listed.join(known.select(F.col("dedup_key").alias("url")), "url", "left_anti")


def chosen(acts: DataFrame, most: int | None) -> DataFrame:
    """The newest acts up to the budget of a run."""
    return acts if most is None else acts.orderBy(F.desc_nulls_last("data"), F.desc_nulls_last("numero"), "url").limit(most)


def deliver(spark: SparkSession, listed: DataFrame, texts: DataFrame, target: str, most: int | None = None, tried: bool = False) -> dict[str, int]:
    """Writes new acts and their passages, with ``tried`` only those that texts has a row of; counters elencati, tentati, scritti, nuovi, senza_testo, errori, elenchi_incompleti."""
    parents = sinks.KeyedTable(spark, f"{target}/atto_normativo", ACT)
    children = sinks.KeyedTable(spark, f"{target}/atto_normativo_brano", CHILD, follows=parents)
    acts = Written(archive.first_by_url(listed), "acts")
    whole = archive.completeness(listed).first() if "totale" in listed.columns else None
    todo = Written(chosen(unknown(acts.df, parents.keys()), most).join(texts.select("url", "testo", "errore").dropDuplicates(["url"]), "url", "inner" if tried else "left"), "acts-new")
    good = todo.df.where("errore is null")
    split = Written(
        passages.act_passages(good.select(F.col("url").alias("dedup_key"), "titolo", "testo")).groupBy("dedup_key").agg(F.array_sort(F.collect_list(F.struct("ordine", "etichetta", "testo"))).alias("brani")), "passages"
    )  # a row of an array is one act: its length is bounded by the passage limits
    rows = archive.to_acts(good.join(split.df.withColumnRenamed("dedup_key", "url"), "url"), passages.chars(F.col("brani")))
    counts = sinks.replace_children(parents, children, rows, split.df)
    n = todo.df.agg(F.count("*").alias("tentati"), F.count_if(F.col("errore").isNotNull()).alias("errori"), F.count_if(F.col("errore").isNull() & (F.length(F.coalesce("testo", F.lit(""))) < passages.LEAST_CHARS)).alias("senza_testo")).first()
    return {
        "elencati": acts.df.count(), "tentati": n.tentati, "scritti": counts["scritte"], "nuovi": counts["nuove"], "senza_testo": n.senza_testo, "errori": n.errori,
        "elenchi_incompleti": int(whole is not None and not whole.completa),
    }


def retire(spark: SparkSession, target: str, current: DataFrame) -> int:
    """Deletes stored consolidated texts that the current listing no longer has."""
    table = sinks.KeyedTable(spark, f"{target}/atto_normativo", ACT)
    return table.delete(sinks.retired(table.read(), current).select("dedup_key"))
