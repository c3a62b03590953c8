"""Secret scans in column expressions: three key patterns and a battery of randomness tests.

Candidates are maximal runs of key characters. The encoding (base16, base32, base64) is inferred from the characters.
Three tests ask whether the symbols can be uniform and independent: chi-squared over the alphabet, runs about the
middle of the alphabet, lag-one serial correlation. A run passes if none of them rejects (Bonferroni). The discovery
itself is controlled: the p-value of a run is the chance that structured text of the same length looks as uniform, so
short runs carry little evidence, and a length-weighted Benjamini-Hochberg step over a document's candidates keeps the
share of false discoveries below FDR.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .native import bound, intervals, normal_cdf

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
RUN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}"
KINDS = ["assign", "access", "hex", "random"]

#: Significance of the battery, and the share of false discoveries among a document's discoveries.
ALPHA, FDR = 0.001, 0.05
_B16, _B16U, _B32 = "0123456789abcdef", "0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_B64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
#: Excess of the chi-squared statistic per symbol in structured text: alphabet size times the coincidence rate, less 1.
_EXCESS = {16: 0.6, 32: 1.1, 64: 2.8}

SPAN = "array<struct<s:int,k:int,e:int>>"


def _spans(found: Column, kind: int) -> Column:
    return F.transform(found, lambda x: F.struct(x["s"].alias("s"), F.lit(kind).alias("k"), x["e"].alias("e")))


def _where(text: Column, pattern: str) -> Column:
    return F.when(text.rlike(pattern), intervals(text, pattern)).otherwise(F.array().cast("array<struct<s:int,e:int,m:string>>"))


def battery(run: Column) -> Column:
    """struct<n, k, p_random, p_text> of one run of key characters; k is 0 where no encoding fits."""
    return bound(F.regexp_replace(run, "=+$", ""), _battery)


def _battery(body: Column) -> Column:
    mixed = body.rlike("[0-9]") & body.rlike("[A-Za-z]")
    k = (
        F.when(mixed & (body.rlike("^[0-9a-f]+$") | body.rlike("^[0-9A-F]+$")), 16)
        .when(mixed & body.rlike("^[A-Z2-7]+$"), 32)
        .when(mixed & body.rlike("[a-z]") & body.rlike("[A-Z]"), 64)
        .otherwise(0)
    )
    alphabet = lambda x: F.when(x["k"] == 16, F.when(x["b"].rlike("[a-f]"), _B16).otherwise(_B16U)).when(x["k"] == 32, _B32).otherwise(_B64)
    # every step is bound, so that nothing that looks at the whole run is done again for each of its characters
    values = lambda x: F.transform(F.filter(F.split(x["b"], ""), lambda c: c != ""), lambda c: F.instr(x["a"], c) - 1)
    named = bound(F.struct(k.alias("k"), F.translate(body, "-_", "+/").alias("b")), lambda x: F.struct(x["k"].alias("k"), x["b"].alias("b"), alphabet(x).alias("a")))
    head = bound(named, lambda x: F.struct(x["k"].alias("k"), x["b"].alias("b"), F.when(x["k"] > 0, values(x)).otherwise(F.array().cast("array<int>")).alias("v")))

    def sums(h: Column) -> Column:
        n, k, v = F.size(h["v"]).cast("double"), h["k"].cast("double"), h["v"]
        square = F.aggregate(F.array_distinct(F.split(h["b"], "")), F.lit(0.0), lambda a, c: F.when(c == "", a).otherwise(a + F.pow((F.length(h["b"]) - F.length(F.replace(h["b"], c, F.lit("")))).cast("double"), F.lit(2.0))))
        follow = F.zip_with(F.slice(v, F.lit(1), F.greatest(F.size(v) - 1, F.lit(0))), F.slice(v, F.lit(2), F.greatest(F.size(v) - 1, F.lit(0))), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        changes = lambda f: F.size(F.filter(f, lambda x: (x["a"] * 2 >= h["k"]) != (x["b"] * 2 >= h["k"]))).cast("double")
        serial = lambda f: F.aggregate(f, F.lit(0.0), lambda s, x: s + (x["a"] - (k - 1) / 2) * (x["b"] - (k - 1) / 2))
        return F.struct(n.alias("n"), k.alias("k"), (k / n * square - n).alias("x2"), changes(follow).alias("changes"), serial(follow).alias("serial"))

    def tests(t: Column) -> Column:
        n, k = t["n"], t["k"]
        z_chi = (t["x2"] - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
        z_runs = (t["changes"] - (n - 1) / 2) / F.sqrt((n - 1) / 4)
        z_serial = t["serial"] / ((k * k - 1) / 12) / F.sqrt(n - 1)
        two = lambda z: 2 * normal_cdf(-F.abs(z))
        p_random = F.least(F.lit(1.0), 3 * F.least(normal_cdf(-z_chi), two(z_runs), two(z_serial)))
        excess = F.when(k == 16, _EXCESS[16]).when(k == 32, _EXCESS[32]).otherwise(_EXCESS[64])
        p_text = normal_cdf((t["x2"] - (k - 1) - (n - 1) * excess) / F.sqrt(2 * (k - 1) + 4 * n * excess))
        return F.struct(n.alias("n"), k.alias("k"), p_random.alias("p_random"), p_text.alias("p_text"))

    none = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("k"), F.lit(0.0).alias("p_random"), F.lit(1.0).alias("p_text"))
    return bound(head, lambda h: F.when((h["k"] == 0) | (F.size(h["v"]) < 20), none).otherwise(bound(sums(h), tests)))


def find(docs: DataFrame, beside: list[str] | None = None) -> DataFrame:
    """doc_id, text (null as empty), base (spans of the three patterns), spans (base and the battery's), sorted.

    A span is struct<s, k, e>: start, index into KINDS, end; code points, end exclusive. Spans of a kind don't overlap;
    the battery adds only runs that no base span touches. Repeated rows are scanned each; an empty table gives an
    empty result; only the columns named in ``beside`` pass through. Texts without any candidate skip all but four pattern searches.
    """
    t, own = F.col("text"), beside or []
    base = docs.select(*own, F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = base.select(*own, "doc_id", "text", _where(t, ASSIGN).alias("a"), _where(t, ACCESS).alias("c"), _where(t, HEX).alias("h"), _where(t, RUN).alias("r"))
    kept = found.select(
        *own,
        "doc_id",
        "text",
        F.array_sort(
            F.concat(
                _spans(F.filter("a", lambda x: F.length(F.regexp_extract(x["m"], ASSIGN, 2)) >= 6), 0),
                _spans(F.col("c"), 1),
                _spans(F.col("h"), 2),
            )
        ).alias("base"),
        "r",
    )
    judged = kept.select(
        *own,
        "doc_id",
        "text",
        "base",
        F.when(
            F.size("r") > 0,
            F.filter(
                F.transform(
                    F.filter("r", lambda c: ~F.exists("base", lambda b: (b["s"] < c["e"]) & (b["e"] > c["s"]))),
                    lambda c: F.struct(c["s"].alias("s"), c["e"].alias("e"), battery(c["m"]).alias("t")),
                ),
                lambda x: x["t"]["k"] > 0,
            ),
        ).alias("j"),
    )
    # Benjamini-Hochberg with weights n / mean n: a run counts if p / weight is at most rank / m * FDR for the largest such rank
    ranked = judged.withColumn(
        "q",
        F.when(F.size("j") > 0, F.transform("j", lambda x: F.struct((x["t"]["p_text"] / x["t"]["n"] * (F.aggregate("j", F.lit(0.0), lambda a, y: a + y["t"]["n"]) / F.size("j"))).alias("q"), x["t"]["p_random"].alias("p"), x["s"].alias("s"), x["e"].alias("e")))),
    )
    limit = F.array_max(F.transform(F.array_sort(F.transform("q", lambda x: x["q"])), lambda q, i: F.when(q <= (i + 1) / F.size("q") * FDR, q)))
    random = F.when(F.size("q") > 0, F.transform("c", lambda x: F.struct(x["s"].alias("s"), F.lit(3).alias("k"), x["e"].alias("e")))).otherwise(F.array().cast(SPAN))
    limited = ranked.withColumn("limit", F.when(F.size("q") > 0, limit))
    chosen = limited.withColumn("c", F.when(F.size("q") > 0, F.filter("q", lambda x: F.coalesce(x["q"] <= F.col("limit"), F.lit(False)) & (x["p"] >= ALPHA))))
    return chosen.select(*own, "doc_id", "text", "base", F.when(F.size("c") > 0, F.array_sort(F.concat("base", random))).otherwise(F.col("base")).alias("spans"))


def _written(spans: str) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(kinds, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random for every document; cases as in find()."""
    count = lambda kind, of="base": F.size(F.filter(of, lambda x: x["k"] == kind)).cast("long")
    return find(docs).select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(_written("base").cast("binary"), 256).alias("base_sha256"), _written("spans").alias("spans"), count(3, "spans").alias("n_random"),
    )


def redact(docs: DataFrame, mark: str = "[SECRET]", columns: list[str] | None = None) -> DataFrame:
    """The documents with every span (overlapping ones as one) replaced by ``mark``, and n_chars set anew.

    Texts without a span, null ones included, stay as they are; all columns pass through in their order.
    """
    columns = columns or docs.columns
    packed = docs.select(F.col("doc_id"), F.col("text"), F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"))
    spans = find(packed, ["row"])
    merged = F.aggregate(
        "spans",
        F.array().cast("array<struct<s:int,e:int>>"),
        lambda acc, x: F.when((F.size(acc) > 0) & (F.element_at(acc, -1)["e"] >= x["s"]), F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(F.element_at(acc, -1)["s"].alias("s"), F.greatest(F.element_at(acc, -1)["e"], x["e"]).alias("e"))))).otherwise(F.concat(acc, F.array(F.struct(x["s"].alias("s"), x["e"].alias("e"))))),
    )
    text, m = F.col("text"), F.col("merged")
    edges = F.concat(F.array(F.lit(0)), F.transform(m, lambda x: x["e"]))
    clean = F.array_join(F.transform(F.arrays_zip(edges.alias("b"), F.concat(F.transform(m, lambda x: x["s"]), F.array(F.length(text))).alias("e")), lambda x: F.substring(text, x["b"] + 1, x["e"] - x["b"])), mark)
    out = spans.withColumn("merged", F.when(F.size("spans") > 0, merged)).withColumn("clean", F.when(F.size("spans") > 0, clean).otherwise(F.col("row.text")))
    return out.select(*[F.col("clean").alias("text") if c == "text" else F.when(F.size("spans") > 0, F.length("clean")).otherwise(F.col("row.n_chars")).cast("long").alias("n_chars") if c == "n_chars" else F.col(f"row.`{c}`").alias(c) for c in columns])

