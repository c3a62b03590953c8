"""Micro-batches: files that land in a folder become upserts, once each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators.sinks import KeyedTable


def landed(spark: SparkSession, folder: str, schema: str, form: str = "json", **options) -> DataFrame:
    return spark.readStream.format(form).schema(schema).options(**options).load(folder)


def upserts(stream: DataFrame, table: KeyedTable, checkpoint: str, prepare: Callable[[DataFrame], DataFrame] = lambda df: df, report: Callable[[int, dict], None] = lambda n, counts: None):
    """Starts a query that handles what has landed and ends: each batch is prepared and upserted under its own number.

    A batch that runs again after a failure replaces what it wrote, so every row counts once. ``prepare`` may read the
    table, for instance to keep known times (enrich); if that fails the batch fails, and nothing is delivered.
    """

    def deliver(batch: DataFrame, number: int) -> None:
        report(number, table.upsert(prepare(batch), number))

    return stream.writeStream.foreachBatch(deliver).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def first_seen(stream: DataFrame, key: str = "dedup_key", at: str = "data", delay: str = "62 days") -> DataFrame:
    """Each key once across batches, with state bounded by the watermark on ``at``."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark([key])
