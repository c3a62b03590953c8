"""Evaluates column functions on a handful of values."""

from pyspark.sql import functions as F


def values(spark, function, *rows, schema="a string"):
    """function of the columns a, b, ... for each row, in order; rows are values or tuples."""
    names = [c.split()[0] for c in schema.split(", ")]
    df = spark.createDataFrame([(i, *(r if isinstance(r, tuple) else (r,))) for i, r in enumerate(rows)], "i int, " + schema)
    return [r.v for r in df.select("i", function(*map(F.col, names)).alias("v")).orderBy("i").collect()]
