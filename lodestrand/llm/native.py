"""Column expressions for offsets of pattern matches, without Python on the executors."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Array elements that one step of a running sum handles; keeps the cost near linear in the number of matches.
_BLOCK = 128


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value computed once: inside higher-order functions Spark shares no common subexpressions."""
    return F.element_at(F.transform(F.array(value), use), 1)


def intervals(text: Column, pattern: str | Column) -> Column:
    """array<struct<s,e,m>> of the leftmost non-overlapping matches: start, end (code points, exclusive) and the match.

    The pattern must not match the empty string. The gaps between matches come from split(), so both sides of the
    running sum agree on the matches.
    """
    found = F.regexp_extract_all(text, F.lit(pattern) if isinstance(pattern, str) else pattern, F.lit(0))
    return bound(found, lambda m: F.when(F.size(m) > 0, bound(_pairs(F.split(text, pattern, -1), m), _offsets)).otherwise(F.array().cast(_SPANS)))


_SPANS = "array<struct<s:int,e:int,m:string>>"


def _pairs(gaps: Column, found: Column) -> Column:
    return F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found, lambda g, m: F.struct(F.length(g).alias("g"), m.alias("m")))


def _offsets(pairs: Column) -> Column:
    """Running sums over (length of the gap before, match), in blocks so that appending stays near linear."""

    def step(acc: Column, x: Column) -> Column:
        s = acc["at"] + x["g"]
        e = s + F.length(x["m"])
        return F.struct(e.alias("at"), F.concat(acc["out"], F.array(F.struct(s.alias("s"), e.alias("e"), x["m"].alias("m")))).alias("out"))

    def shift(acc: Column, b: Column) -> Column:
        moved = F.transform(b["out"], lambda x: F.struct((x["s"] + acc["at"]).alias("s"), (x["e"] + acc["at"]).alias("e"), x["m"].alias("m")))
        return F.struct((acc["at"] + b["at"]).alias("at"), F.concat(acc["out"], F.array(moved)).alias("out"))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("out")).cast(f"struct<at:int,out:{_SPANS}>")
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / _BLOCK).cast("int")), lambda b: F.aggregate(F.slice(pairs, b * _BLOCK + 1, F.lit(_BLOCK)), zero, step))
    first = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPANS}>").alias("out")).cast(f"struct<at:int,out:array<{_SPANS}>>")
    return F.flatten(F.aggregate(blocks, first, shift)["out"])


def normal_cdf(z: Column) -> Column:
    """The standard normal distribution function (Abramowitz and Stegun 26.2.17, error below 1e-7)."""
    t = 1 / (1 + 0.2316419 * F.abs(z))
    tail = 0.3989422804014327 * F.exp(-z * z / 2) * t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return F.when(z > 0, 1 - tail).otherwise(tail)
