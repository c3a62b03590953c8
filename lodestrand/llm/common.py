"""Shared folder tables, Arrow batch helpers and connected components for the text operators.

Intermediate tables are Parquet files in the folder named by ``spark.checkpoint.dir``: every executor and the
driver can read them, so a lost executor costs a re-read and not a recomputation of the whole lineage.
"""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN: dict[str, str] = {}
#: Rows of an Arrow batch at most while a table is written: a row is a document.
BATCH_ROWS = 2000
#: Bytes of text that the Python side of an operator holds decoded at once.
SLICE_BYTES = 3 << 20


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of the session; a local one only where the setting is absent (tests, a laptop)."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if spark.sparkContext.applicationId not in _OWN:
        _OWN[spark.sparkContext.applicationId] = tempfile.mkdtemp(prefix="lodestrand-")
    return _OWN[spark.sparkContext.applicationId]


def reclaim(spark: SparkSession) -> None:
    """Lets go of the shuffle files of jobs that are over: Spark deletes them when the driver collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


class Stored:
    """A table written once into the shared folder. ``df`` reads it; ``drop()`` frees its space.

    What the job has shuffled is not needed any more and goes at once: the steps of an operator are many, and their
    shuffle files would add up to several times the input.
    """

    def __init__(self, df: DataFrame, tag: str):
        self.spark = df.sparkSession
        self.path = f"{scratch_root(self.spark)}/lodestrand/{tag}-{uuid.uuid4().hex}"
        conf, rows = self.spark.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
        before = conf.get(rows)
        conf.set(rows, str(min(int(before), BATCH_ROWS) if int(before) > 0 else BATCH_ROWS))
        try:
            df.write.parquet(self.path)
        finally:
            conf.set(rows, before)
        reclaim(self.spark)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def _files(self):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def bytes(self) -> int:
        files, path = self._files()
        return files.getContentSummary(path).getLength()

    def drop(self) -> None:
        files, path = self._files()
        files.delete(path, True)


#: Bytes of a stored table (compressed) that are broadcast at most; larger ones are joined by shuffling.
SMALL_BYTES = 4 << 20


def small(table: Stored) -> DataFrame:
    """The stored table, with a broadcast hint where its measured files are small."""
    return F.broadcast(table.df) if table.bytes() <= SMALL_BYTES else table.df


def stored(df: DataFrame, tag: str) -> DataFrame:
    return Stored(df, tag).df


def utf8(column: pa.Array) -> list[bytes]:
    """The bytes of a text column; null counts as the empty text."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b"" if x is None else x for x in column.cast(kind).to_pylist()]


def parts(column: pa.Array) -> Iterator[pa.Array]:
    """Cuts an Arrow column of texts as slices() cuts batches."""
    for piece in slices(iter([pa.RecordBatch.from_arrays([column], ["text"])])):
        yield piece.column(0)


def slices(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """Cuts Arrow batches so that each holds at most SLICE_BYTES of text, or one row."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(text)).to_pylist() if batch.num_rows else []
        begin = total = 0
        for i, n in enumerate(sizes):
            if total and total + (n or 0) > SLICE_BYTES:
                yield batch.slice(begin, i - begin)
                begin, total = i, 0
            total += n or 0
        if begin < batch.num_rows:
            yield batch.slice(begin)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, component (the least node) of the edges src, dst of one small table, by union of roots."""
    parent: dict = {}

    def root(x):
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = up
        return x

    kind = None
    for batch in batches:
        kind = batch.schema.field("src").type
        for x, y in zip(batch.column("src").to_pylist(), batch.column("dst").to_pylist(), strict=True):
            x, y = root(x), root(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
    nodes = list(parent)
    for at in range(0, len(nodes), 1 << 16):
        part = nodes[at : at + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(part, kind), pa.array(list(map(root, part)), kind)], ["node", "component"])


def components(edges: DataFrame, a: str, b: str, kind: str = "string") -> DataFrame:
    """Connected components of an edge table: one row (node, component) for every node that an edge names.

    component is the smallest node id reached. Each round takes the least label among the neighbours and then
    follows the label's own label, so stars and short chains end after two or three rounds. Labels live in the
    shared folder; nothing but the count of changed labels comes to the driver. Edges of SMALL_BYTES at most are joined by
    one task, which spares the rounds. An empty edge table gives an empty result; self loops and repeated edges are
    harmless; null ends are ignored.
    """
    edges = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    both = Stored(
        edges.select(F.col(a).cast(kind).alias("src"), F.col(b).cast(kind).alias("dst"))
        .union(edges.select(F.col(b).cast(kind), F.col(a).cast(kind)))
        .distinct(),
        "edges",
    )
    if both.bytes() <= SMALL_BYTES:
        found = Stored(both.df.select("src", "dst").coalesce(1).mapInArrow(_joined, f"node {kind}, component {kind}"), "labels")
        both.drop()
        return found.df
    labels = Stored(both.df.groupBy(F.col("src").alias("node")).agg(F.least(F.min("dst"), F.col("src")).alias("component")), "labels")
    while True:
        near = (
            both.df.join(labels.df.select(F.col("node").alias("dst"), F.col("component").alias("seen")), "dst")
            .groupBy(F.col("src").alias("node"))
            .agg(F.min("seen").alias("seen"))
        )
        step = labels.df.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "seen").alias("mid"))
        jump = labels.df.select(F.col("node").alias("mid"), F.col("component").alias("far"))
        after = Stored(step.join(jump, "mid").select("node", F.least("mid", "far").alias("component"), (F.least("mid", "far") != F.col("old")).alias("moved")), "labels")
        moved = after.df.where("moved").limit(1).count()
        labels.drop()
        labels = after
        if not moved:
            both.drop()
            return labels.df.select("node", "component")
