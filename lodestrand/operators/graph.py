"""The citation graph of legal acts: which act is recalled by which."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def edges(acts: DataFrame) -> DataFrame:
    """(url, cita): one row for each act and cited key. acts: url, chiave, cita (array)."""
    return acts.select("url", F.explode("cita").alias("cita"))


def recalled_by(acts: DataFrame) -> DataFrame:
    """(chiave, url, da): for each act the address of every act that cites its key. Both sides are narrow; Spark splits hot keys."""
    return edges(acts).withColumnRenamed("url", "da").join(acts.where("chiave is not null").select(F.col("chiave").alias("cita"), "url"), "cita").select(F.col("cita").alias("chiave"), "url", "da")


def recall_counts(acts: DataFrame) -> DataFrame:
    """(chiave, url, richiami): how many acts cite each act; counts are taken before the join, so a hot key is one row."""
    n = edges(acts).groupBy("cita").agg(F.count("*").alias("richiami"))
    return acts.where("chiave is not null").select("chiave", "url").join(n.withColumnRenamed("cita", "chiave"), "chiave", "left").select("chiave", "url", F.coalesce("richiami", F.lit(0)).alias("richiami"))
