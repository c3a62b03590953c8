"""Row numbers within groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..tables import Written


def row_numbers(rows: DataFrame, keys: list[str], order: list[str], name: str = "rn", size: str | None = None) -> DataFrame:
    """Adds ``name``, the number from 0 of each row within its keys by ``order``, and with ``size`` the rows of the keys.

    A window over a group puts the group into one task. Here the rows are range-sorted by keys and order, so a large
    group spreads over tasks; each task numbers what it holds, and the counts of the tasks before are added. The order
    should tell all rows of a group apart; equal rows get numbers in no fixed order.
    """
    dealt = Written(rows.repartitionByRange(*keys, *order).withColumn("__part", F.spark_partition_id()), "numbered")
    counts = dealt.df.groupBy(*keys, "__part").agg(F.count("*").alias("__n"))
    before = W.partitionBy(*keys).orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    # a row for each task that a group touches; null keys are a group of their own
    offsets = counts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).withColumn("__all", F.sum("__n").over(W.partitionBy(*keys)))
    local = W.partitionBy("__part", *keys).orderBy(*order)
    own = dealt.df.withColumn("__local", F.row_number().over(local) - 1)
    out = own.join(offsets.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("__part").alias("__p"), "__before", "__all"), (F.col("__part") == F.col("__p")) & _same(keys))
    extra = [F.col("__all").alias(size)] if size else []
    return out.select(*rows.columns, (F.col("__before") + F.col("__local")).cast("long").alias(name), *extra)


def _same(keys: list[str]):
    test = F.lit(True)
    for k in keys:
        test = test & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return test
