"""License scans in column expressions: ordered signature rules with keyword prefilter and containment suppression.

A document with a word of GATE is normalised to its words; the rules whose keyword it holds are searched in it; of the
matches, those that lie within a match of at least their priority are dropped.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .license_rules import GATE, RULES
from .native import intervals

#: One word of the contract, upper-case ASCII included (it is lower-cased before use).
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
_PHRASE = " (?:" + "|".join(PHRASES) + ")(?= )"
_GATE = "(?i)" + "|".join(sorted({"licen[cs]e", *(g for g in GATE if "licen" not in g and g != "cc")})) + r"|cc[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+by"
_TOP = max(p for _, p, _, _ in RULES)


def _rules() -> Column:
    table = [{"o": i, "l": label, "p": p, "k": f" {k} ", "r": f" (?:{r})(?= )"} for i, (label, p, k, r) in enumerate(RULES)]
    return F.from_json(F.lit(json.dumps(table)), "array<struct<o:int,l:string,p:int,k:string,r:string>>")


def _words(piece: Column) -> Column:
    return F.length(piece) - F.length(F.replace(piece, F.lit(" "), F.lit("")))


def detect(docs: DataFrame, beside: list[str] | None = None) -> DataFrame:
    """doc_id, n_words, words (normalised, null where no word of GATE occurs) and found: the rule matches left.

    found is array<struct<s,p,o,l,e>>: start and end in ``words`` (code points), priority, rule, label. A match within
    another of at least its priority is dropped; of equal matches the first rule's stays. Null texts count as empty;
    repeated rows are scanned each; very long texts whole; an empty table gives an empty result; only columns named in ``beside`` pass through.
    """
    own = beside or []
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    gated = docs.select(*own, F.col("doc_id").cast("long").alias("doc_id"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_words"), F.when(text.rlike(_GATE), F.concat(F.lit(" "), F.regexp_replace(F.lower(text), BREAK, " "), F.lit(" "))).alias("w"))
    normal = gated.withColumn("words", F.regexp_replace("w", " {2,}", " ")).drop("w")
    active = normal.withColumn("rules", F.when(F.col("words").isNotNull(), F.filter(_rules(), lambda r: F.contains(F.col("words"), r["k"]))))
    each = lambda r: F.transform(intervals(F.col("words"), r["r"]), lambda m: F.struct(m["s"].alias("s"), (-m["e"]).alias("n"), (-r["p"]).alias("q"), r["o"].alias("o"), r["l"].alias("l")))
    matched = active.withColumn("all", F.when(F.size("rules") > 0, F.array_sort(F.flatten(F.transform("rules", each)))))
    state = "struct<top:array<int>,out:array<struct<s:int,p:int,o:int,l:string,e:int>>>"

    def step(acc: Column, x: Column) -> Column:
        p, e = -x["q"], -x["n"]
        # acc.top[i]: the furthest end so far of matches with priority i + 1; they all begin at or before x
        inside = F.exists(F.slice(acc["top"], p, F.lit(_TOP)), lambda end: end >= e)
        return F.when(inside, acc).otherwise(
            F.struct(
                F.transform(acc["top"], lambda end, i: F.when(i == p - 1, F.greatest(end, e)).otherwise(end)).alias("top"),
                F.concat(acc["out"], F.array(F.struct(x["s"].alias("s"), p.alias("p"), x["o"].alias("o"), x["l"].alias("l"), e.alias("e")))).alias("out"),
            ).cast(state)
        )

    zero = F.struct(F.array_repeat(F.lit(-1), _TOP).alias("top"), F.array().cast("array<struct<s:int,p:int,o:int,l:string,e:int>>").alias("out")).cast(state)
    return matched.select(*own, "doc_id", "n_words", "words", F.when(F.size("all") > 0, F.aggregate("all", zero, step)["out"]).alias("found"))


def summaries(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_rules for every document.

    Base places are those of PHRASES, all of them. score is the highest priority of a rule left (or 3 for a bare base
    phrase) over the highest there is, 0 without either. Other cases as in detect().
    """
    found = detect(docs)
    places = F.when(F.col("words").rlike(_PHRASE), F.split("words", _PHRASE, -1))
    hits = found.withColumn("pieces", places).withColumn("hits", F.when(F.size("pieces") > 1, F.regexp_extract_all("words", F.lit(_PHRASE), F.lit(0))))
    some = F.size("pieces") > 1
    label = F.create_map(*[F.lit(x) for pair in PHRASES.items() for x in (f" {pair[0]}", pair[1])])
    base = F.when(some, F.transform(F.array_distinct("hits"), lambda h: F.element_at(label, h))).otherwise(F.array().cast("array<string>"))
    rules = F.when(F.size("found") > 0, F.array_distinct(F.transform("found", lambda x: x["l"]))).otherwise(F.array().cast("array<string>"))
    last = F.element_at("pieces", -1)
    top = F.when(F.size("found") > 0, F.array_max(F.transform("found", lambda x: x["p"]))).otherwise(0)
    return hits.select(
        "doc_id",
        "n_words",
        F.when(some, F.size("hits")).otherwise(0).cast("long").alias("n_base"),
        F.when(some, _words(F.element_at("pieces", 1))).cast("long").alias("first_word"),
        F.when(some, F.col("n_words") - (_words(last) - 1) - _words(F.element_at("hits", -1))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, rules)), ",").alias("labels"),
        (F.greatest(top, F.when(some, 3).otherwise(0)) / F.lit(float(_TOP))).alias("score"),
        F.when(F.size("found") > 0, F.size("found")).otherwise(0).cast("long").alias("n_rules"),
    )
