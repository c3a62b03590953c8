"""Column functions on strings: white space, titles, located matches, UTF-16 lengths."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The white space that the sources' own pattern language knows (Java's \s is ASCII only).
SPACE = r"[\t-\r \u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000\uFEFF]"
#: The letters that lose their accent in a title key, and what they become.
ACCENTED = "àáâäãèéêëìíîïòóôöõùúûüçñ"
PLAIN = "aaaaaeeeeiiiiooooouuuucn"

#: Not a letter, digit or underscore of ASCII: \b of Java is not the same beside accented letters.
END_OF_WORD = r"(?![A-Za-z0-9_])"


def spaced(pattern: str) -> str:
    """The pattern with every ``\\s`` widened to SPACE, also within character classes."""
    inside, out, i = False, [], 0
    while i < len(pattern):
        two = pattern[i : i + 2]
        if two == r"\s":
            out.append(SPACE[1:-1] if inside else SPACE)
            i += 2
            continue
        if two[:1] == "\\":
            out.append(two)
            i += 2
            continue
        inside = pattern[i] == "[" or inside and pattern[i] != "]"
        out.append(pattern[i])
        i += 1
    return "".join(out)


def strip(c: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(c, spaced(r"^\s+|\s+\z"), "")


def squeeze(c: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(c, f"{SPACE}+", " "))


def blank_to_null(c: Column) -> Column:
    return F.when(c != "", c)


def normal_title(c: Column) -> Column:
    """Lower case, accents of ACCENTED removed, all but a-z and 0-9 as single spaces. Null stays null."""
    return F.trim(F.regexp_replace(F.translate(F.lower(c), ACCENTED, PLAIN), "[^a-z0-9]+", " "))


def tokens(normal: Column) -> Column:
    """The distinct words of a normal title in order; none of an empty one."""
    return F.filter(F.array_distinct(F.split(normal, " ")), lambda x: x != "")


_ASTRAL = r"[\x{10000}-\x{10FFFF}]"


def utf16_length(c: Column) -> Column:
    """Length in UTF-16 units: characters beyond the basic plane count as two."""
    return F.length(c) + F.regexp_count(c, F.lit(_ASTRAL))


def utf16_head(c: Column, n: int) -> Column:
    """The first n UTF-16 units; half a pair at the cut is left out."""
    short = F.substring(c, 1, n)

    def step(acc: Column, x: Column) -> Column:
        units = acc["units"] + F.when(x == "", 0).when(x.rlike(_ASTRAL), 2).otherwise(1)
        return F.struct(units.alias("units"), (acc["fit"] + F.when((x != "") & (units <= n), 1).otherwise(0)).alias("fit"))

    fit = F.aggregate(F.split(short, ""), F.struct(F.lit(0).alias("units"), F.lit(0).alias("fit")), step)["fit"]
    return F.when(short.rlike(_ASTRAL), F.substring(short, F.lit(1), fit)).otherwise(short)


def excerpt(plain: Column, length: int = 280) -> Column:
    """Squeezed text, cut at ``length`` UTF-16 units with an ellipsis; null if nothing is left."""
    cut = lambda t: F.concat(F.rtrim(utf16_head(t, length)), F.lit("…"))
    return bound(squeeze(plain), lambda t: F.when(t == "", None).when(utf16_length(t) <= length, t).otherwise(cut(t)))


def first_image(html: Column) -> Column:
    """The first img source that is neither blank nor an inline ``data:`` image."""
    found = F.regexp_extract_all(html, F.lit(spaced(r"""(?i)<img[^>]+src\s*=\s*["']([^"']+)["']""")), F.lit(1))
    return F.try_element_at(F.filter(F.transform(found, strip), lambda x: (x != "") & ~x.startswith("data:")), F.lit(1))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def groups(match: Column, pattern: str, n: int) -> Column:
    """The n groups of a pattern that matches the whole of ``match``, as an array; an absent group is an empty string."""
    bar = "\x1f"
    return F.split(F.regexp_replace(match, pattern, bar.join(f"${i}" for i in range(1, n + 1))), bar, -1)


def located(text: Column, pattern: str, back: int = 0) -> Column:
    """array<struct<s,m,before>> of the leftmost non-overlapping matches: start, match, the ``back`` characters in front of it.

    The gaps between matches come from split(), so that starts are sums of lengths; nothing is searched twice.
    """
    kind = "array<struct<s:int,m:string,before:string>>"
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("tail"), F.array().cast(kind).alias("out")).cast(f"struct<at:int,tail:string,out:{kind}>")

    def step(acc: Column, x: Column) -> Column:
        s = acc["at"] + F.length(x["g"])
        before = F.right(F.concat(acc["tail"], x["g"]), F.lit(back)) if back else F.lit("")
        tail = F.right(F.concat(acc["tail"], x["g"], x["m"]), F.lit(back)) if back else F.lit("")
        return F.struct((s + F.length(x["m"])).alias("at"), tail.alias("tail"), F.concat(acc["out"], F.array(F.struct(s.alias("s"), x["m"].alias("m"), before.alias("before")))).alias("out"))

    def pairs(m: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(m))
        return F.aggregate(F.zip_with(gaps, m, lambda g, x: F.struct(g.alias("g"), x.alias("m"))), zero, step)["out"]

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.when(text.rlike(pattern), bound(found, pairs)).otherwise(F.when(text.isNotNull(), F.array().cast(kind)))


def lookup(c: Column, table: dict) -> Column:
    """The value of a small fixed table, or null."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), c)
