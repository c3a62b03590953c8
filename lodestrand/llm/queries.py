"""The registered queries of the text operators: each over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import bpe, langid, licenses, linededup, lm, media, neardup, packing, quality, secrets

PIECE_COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(documents(spark, sf_dir))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.summaries(documents(spark, sf_dir))


def op3_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(documents(spark, sf_dir))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir)).select(PIECE_COLUMNS)


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality.judge(docs, quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.report(documents(spark, sf_dir))


def op8_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.digests(documents(spark, sf_dir))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return langid.predict(docs, langid.fit(docs))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.groups(documents(spark, sf_dir))


def queries() -> dict:
    return {f.__name__: f for f in (op1_secrets, op2_licenses, op3_lm_scores, op4_packing, op5_byte_bpe, op6_quality, op7_line_dedup, op8_media, op9_language, op10_near_duplicates)}


def oracle_sql() -> dict[str, str]:
    return {}
