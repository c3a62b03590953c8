"""Delivery: keyed upserts into Parquet tables, run log, retirement, guards.

A table is a folder of numbered bases and deltas. An upsert appends one delta of the rows that came in; a read takes the
latest base and of each key the row of the latest delta beyond it; compaction folds the deltas into a new base. So a run
writes as much as it brings, however large the table is. A folder counts from the moment Spark has marked it complete, in
one step: the name of a base says which deltas it holds, so that these no longer count from then on, whether or not they
are still there. Folders go one compaction later, when no reader needs them.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..tables import exists, file_system, remove

#: The tables that a feed run may write.
ALLOWED = ("notizia", "evento", "documento_istituzionale")
LEAST_CURRENT = 20


class KeyedTable:
    """Rows by a key column; the latest delivery of a key wins.

    The deliveries of a table that ``follows`` another count once that one holds a delivery of the same number.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str = "dedup_key", follows: KeyedTable | None = None):
        self.spark, self.path, self.schema, self.key, self.follows = spark, path.rstrip("/"), schema, key, follows

    def _complete(self) -> tuple[list[tuple[int, int]], list[int]]:
        """(generation, number after the last delta that it holds) of the complete bases, numbers of the complete deltas."""
        if not exists(self.spark, self.path):
            return [], []
        fs, at = file_system(self.spark, self.path)
        names = [n for n in (x.getPath().getName() for x in fs.listStatus(at)) if n.startswith(("base-", "delta-")) and exists(self.spark, f"{self.path}/{n}/_SUCCESS")]
        parts = [n.split("-") for n in names]
        deltas = sorted(int(x[1]) for x in parts if x[0] == "delta")
        return sorted((int(x[1]), int(x[2])) for x in parts if x[0] == "base"), [n for n in deltas if self.follows is None or self.follows.holds(n)]

    def _folder(self, number: int) -> str:
        return f"{self.path}/delta-{number:010d}"

    def _base(self, generation: int, last: int) -> str:
        return f"{self.path}/base-{generation:010d}-{last + 1:010d}"

    def _folders(self) -> list[tuple[int, str]]:
        """(number, path) of what counts, in order: the latest base, as number -1, and the deltas that it does not hold."""
        bases, deltas = self._complete()
        last = bases[-1][1] - 1 if bases else -1
        return [(-1, self._base(g, last)) for g, _ in bases[-1:]] + [(n, self._folder(n)) for n in deltas if n > last]

    def holds(self, number: int) -> bool:
        """Whether a delivery of this number is part of the table."""
        bases, deltas = self._complete()
        return number in deltas or bool(bases) and number < bases[-1][1]

    def next_number(self) -> int:
        bases, deltas = self._complete()
        return max([n for _, n in bases] + [n + 1 for n in deltas], default=0)

    def _rows(self, below: int | None = None) -> DataFrame | None:
        out = None
        for n, p in self._folders():
            if below is None or n < below:
                rows = self.spark.read.schema(self.schema).parquet(p).withColumn("__n", F.lit(n))
                out = rows if out is None else out.unionByName(rows)
        return out

    def read(self, below: int | None = None) -> DataFrame:
        """The current rows, one a key; with ``below`` as they were before that delta."""
        rows = self._rows(below)
        if rows is None:
            return self.spark.createDataFrame([], self.schema)
        if len(self._folders()) == 1:
            return rows.drop("__n")
        own = [c for c in rows.columns if c != "__n"]
        return rows.groupBy(F.col(self.key).alias("__key")).agg(F.max_by(F.struct(*own), "__n").alias("r")).select("r.*")

    def keys(self, below: int | None = None) -> DataFrame:
        """The keys alone: Parquet reads one column."""
        rows = self._rows(below)
        return self.spark.createDataFrame([], f"{self.key} string") if rows is None else rows.select(self.key).distinct()

    def upsert(self, rows: DataFrame, number: int | None = None) -> dict[str, int]:
        """Writes rows of the table's columns; counts scritte (keys written) and nuove (keys that were not there).

        Of rows with one key in a delivery one is written, the greatest as a struct. Rows without a key raise. ``number``
        names the delivery; the same number again replaces it, or follows the last one if it is part of a base by now. An
        empty delivery changes nothing.
        """
        bases, _ = self._complete()
        number = self.next_number() if number is None or bases and number < bases[-1][1] else number
        own = [c.split()[0] for c in self.schema.split(", ")]
        key = F.when(F.col(self.key).isNull(), F.raise_error(F.lit("a row has no key"))).otherwise(F.col(self.key))
        each = rows.select(own).groupBy(key.alias("__key")).agg(F.max(F.struct(*own)).alias("r")).select("r.*")
        path = self._folder(number)
        each.write.mode("overwrite").parquet(path)
        written = self.spark.read.schema(self.schema).parquet(path).select(self.key)
        n = written.count()
        if not n:
            remove(self.spark, path)
            return {"scritte": 0, "nuove": 0}
        return {"scritte": n, "nuove": written.join(self.keys(number), self.key, "left_anti").count()}

    def delete(self, keys: DataFrame) -> int:
        """Rewrites the table without some keys; returns how many went."""
        rows = self.read()
        gone = rows.join(keys.select(self.key).distinct(), self.key, "left_semi").count()
        if gone:
            self._replace(rows.join(keys.select(self.key).distinct(), self.key, "left_anti").select(rows.columns))
        return gone

    def compact(self) -> None:
        self._replace(self.read())

    def _replace(self, rows: DataFrame) -> None:
        """A new base, whole before it counts. What the base before it had no use for goes; the rest goes next time."""
        bases, deltas = self._complete()
        generation, last = (bases[-1][0] + 1 if bases else 0), self.next_number() - 1
        rows.write.mode("overwrite").parquet(self._base(generation, last))
        held = bases[-1][1] - 1 if bases else -1
        for g, n in bases[:-1]:
            remove(self.spark, self._base(g, n - 1))
        for n in deltas:
            if n <= held:
                remove(self.spark, self._folder(n))


def replace_children(parents: KeyedTable, children: KeyedTable, acts: DataFrame, passages: DataFrame) -> dict[str, int]:
    """Acts and their passages in one step: passages are one row an act, an array, under the number of the acts' delivery.

    ``children`` follows ``parents``, so what is written of them counts from the moment the acts are complete.
    """
    number = parents.next_number()
    children.upsert(passages, number)
    return parents.upsert(acts, number)


def retired(stored: DataFrame, current: DataFrame, least: int = LEAST_CURRENT) -> DataFrame:
    """Stored consolidated texts that are no longer listed. Fewer than ``least`` listed ones mean a broken listing: an error."""
    n = current.select("url").distinct().limit(least).count()
    if n < least:
        raise ValueError(f"only {n} current texts were listed; nothing is retired")
    return stored.where("coordinato").join(current.select("url").distinct(), "url", "left_anti")


def outcome(spark: SparkSession, path: str | None, **fields) -> dict:
    """Appends one row to the run log; errors of the log itself never stop a run. A dry run has no path and writes none."""
    error = fields.get("errore")
    row = {k: fields.get(k) for k in ("fonte_id", "tipo", "esito", "documenti", "n_righe", "nuove")} | {"errore": error.split("\n")[0] if error else None}
    if path:
        try:
            spark.createDataFrame([tuple(row.values())], "fonte_id int, tipo string, esito string, documenti long, n_righe long, nuove long, errore string").write.mode("append").parquet(path)
        except Exception as e:  # the log is diagnosis, not production
            print(f"run log not written: {e!s:.200}")
    return row


def too_many_errors(errors: int, written: int, listing_errors: int = 0) -> bool:
    """More than three errors that are over a twentieth of what was written, or any error of a listing."""
    return listing_errors > 0 or (errors > 3 and errors * 20 > written)


def counters(tries: DataFrame) -> DataFrame:
    """tentati, scritti, nuovi, senza_testo, errori of the tried acts (scritto, nuovo, caratteri, errore)."""
    return tries.agg(
        F.count("*").alias("tentati"), F.count_if("scritto").alias("scritti"), F.count_if(F.col("scritto") & F.col("nuovo")).alias("nuovi"),
        F.count_if(F.col("scritto") & (F.coalesce("caratteri", F.lit(0)) == 0)).alias("senza_testo"), F.count_if(F.col("errore").isNotNull()).alias("errori"),
    )


def novelty(log: DataFrame) -> DataFrame:
    """For each source and type the share of new rows over all runs: near 1 means that items were missed between runs."""
    n = log.where("esito = 'ok'").groupBy("fonte_id", "tipo").agg(F.sum("n_righe").alias("righe"), F.sum("nuove").alias("nuove"))
    return n.withColumn("quota", F.when(F.col("righe") > 0, F.col("nuove") / F.col("righe")))


def summary(counts: dict) -> str:
    """A run's counters as a table in Markdown."""
    return "| voce | n |\n|---|---:|\n" + "".join(f"| {k} | {v} |\n" for k, v in counts.items())


def pretty(rows: DataFrame) -> Iterator[str]:
    """All rows of a dry run as indented JSON, one at a time: the driver holds one partition."""
    for (x,) in rows.select(F.to_json(F.struct("*"))).toLocalIterator():
        yield json.dumps(json.loads(x), ensure_ascii=False, indent=2)
