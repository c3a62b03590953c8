"""Queries on legal texts: types, keys, citations, passages, archive pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import legal
from ..functions.text import utf16_length
from ..operators import graph, passages
from ..sources import archive
from ..tables import Written
from .registry import query, table

#: Types of the made-up acts, by order key modulo nine, and the families they belong to.
TYPES = ["Legge", "Decreto Delegato", "Legge Qualificata", "Legge Costituzionale", "Decreto - Legge", "Regolamento", "Decreto Consiliare", "Legge di Revisione Costituzionale", "Errata corrige"]
_FAMILY = "(['o', 'o', 'q', 'c', 'o', 'r', 'o', 'c', NULL])[(o_orderkey % 9)::INTEGER + 1]"
_KEY = f"{_FAMILY} || ':' || year(o_orderdate) || '/' || o_orderkey"
_TYPE = "([" + ", ".join(f"'{t}'" for t in TYPES) + "])[(o_orderkey % 9)::INTEGER + 1]"
_MONTHS = "(['gennaio', 'febbraio', 'marzo', 'aprile', 'maggio', 'giugno', 'luglio', 'agosto', 'settembre', 'ottobre', 'novembre', 'dicembre'])"


def _type():
    return F.element_at(F.array(*map(F.lit, TYPES)), F.expr("cast(o_orderkey % 9 as int) + 1"))


def _long_date(c):
    from ..functions.dates import MONTHS

    name = F.element_at(F.array(*map(F.lit, MONTHS)), F.month(c))
    return F.concat(F.dayofmonth(c).cast("string"), F.lit(" "), name, F.lit(" "), F.year(c).cast("string"))


def _acts(spark, d):
    """An act for each order; its title names its own designation and those of two other orders of the same customer."""
    from pyspark.sql import Window as W

    w = W.partitionBy("o_custkey").orderBy("o_orderkey")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("day"), _type().alias("tipo"))
    named = F.struct("o_orderkey", "tipo", "day")
    o = o.withColumn("p", F.lag(named, 1).over(w)).withColumn("q", F.lag(named, 2).over(w))
    own = F.concat(F.upper("tipo"), F.lit(" "), _long_date("day"), F.lit(" n."), "o_orderkey")
    dated = F.concat(F.lit(" - Modifica della "), "p.tipo", F.lit(" "), _long_date("p.day"), F.lit(", n. "), "p.o_orderkey")
    short = F.concat(F.lit(" e ratifica\xa0del "), F.lower("q.tipo"), F.lit(" n° "), "q.o_orderkey", F.lit(" / "), F.year("q.day"))
    title = F.concat(own, F.coalesce(dated, F.lit("")), F.coalesce(short, F.lit("")))
    return o.select("o_orderkey", "day", "tipo", title.alias("titolo"), F.concat(F.lit("https://a.example/"), "o_orderkey").alias("url"))


_CITED = f"""
WITH o AS (SELECT o_orderkey, o_custkey, o_orderdate, {_KEY} AS k FROM orders),
w AS (SELECT o_orderkey, k, lag(k, 1) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS p, lag(k, 2) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS q FROM o)"""


@query(f"SELECT o_orderkey, CASE o_orderkey % 9 WHEN 4 THEN 'Decreto-Legge' WHEN 8 THEN 'Errata corrige' WHEN 7 THEN 'Legge di Revisione Costituzionale' ELSE {_TYPE} END AS tipo, {_FAMILY} AS famiglia, {_KEY} AS chiave FROM orders")
def act_key(spark, d):
    o = table(spark, d, "orders").withColumn("tipo", F.upper(F.concat(F.lit("  "), F.replace(_type(), F.lit(" "), F.lit("\t ")))))
    kind = legal.normal_type(F.col("tipo"))
    return o.select("o_orderkey", kind.alias("tipo"), legal.family(kind).alias("famiglia"), legal.act_key(kind, F.year("o_orderdate"), F.col("o_orderkey")).alias("chiave"))


@query(f"SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 8 THEN 'Errata corrige' ELSE upper({_TYPE}) END AS tipo FROM orders")
def type_of_title(spark, d):
    return _acts(spark, d).select("o_orderkey", legal.type_of_title(F.col("titolo")).alias("tipo"))


@query(_CITED + " SELECT o_orderkey, concat_ws(',', p, q) AS cita FROM w")
def citations(spark, d):
    a = _acts(spark, d)
    own = legal.act_key(legal.normal_type(F.col("tipo")), F.year("day"), F.col("o_orderkey"))
    return a.select("o_orderkey", F.array_join(legal.cited_keys(F.col("titolo"), own), ",").alias("cita"))


@query(_CITED + ", c AS (SELECT p AS k FROM w WHERE p IS NOT NULL UNION ALL SELECT q FROM w WHERE q IS NOT NULL), n AS (SELECT k, count(*) AS n FROM c GROUP BY k) SELECT o.k AS chiave, 'https://a.example/' || o.o_orderkey AS url, coalesce(n.n, 0)::BIGINT AS richiami FROM o LEFT JOIN n USING (k) WHERE o.k IS NOT NULL")
def citation_graph(spark, d):
    return graph.recall_counts(_keyed(spark, d))


@query(_CITED + ", c AS (SELECT o_orderkey, p AS k FROM w WHERE p IS NOT NULL UNION ALL SELECT o_orderkey, q FROM w WHERE q IS NOT NULL) SELECT c.k AS chiave, 'https://a.example/' || o.o_orderkey AS url, 'https://a.example/' || c.o_orderkey AS da FROM c JOIN o ON o.k = c.k")
def recalled_by(spark, d):
    return graph.recalled_by(_keyed(spark, d))


def _keyed(spark, d):
    a = _acts(spark, d).withColumn("chiave", legal.act_key(legal.normal_type(F.col("tipo")), F.year("day"), F.col("o_orderkey")))
    return a.select("url", "chiave", legal.cited_keys(F.col("titolo"), F.col("chiave")).alias("cita"))


@query(f"SELECT o_orderkey, strftime(make_date(year(o_orderdate), month(o_orderdate), 1) + 29, '%Y-%m-%d') AS data, o_orderkey::INTEGER AS numero, year(o_orderdate)::INTEGER AS anno FROM orders")
def citation_overflow(spark, d):
    from ..functions.dates import MONTHS

    o = table(spark, d, "orders")
    month = F.element_at(F.array(*map(F.lit, MONTHS)), F.month("o_orderdate"))
    text = F.concat(F.lit("Vedi 12 marzi 2020 n.4, il decreto 30 "), month, F.lit(" "), F.year("o_orderdate"), F.lit(" numero "), "o_orderkey", F.lit(", non la legge 4 brumaio 2020 n.1"))
    return o.select("o_orderkey", F.explode(legal.citations(text)).alias("c")).select("o_orderkey", F.date_format("c.data", "yyyy-MM-dd").alias("data"), "c.numero", "c.anno")


_LINES = """
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents),
c AS (SELECT doc_id, list_filter(list_transform(x, lambda r: rtrim(regexp_replace(r, '[ \\t]+', ' ', 'g'), ' ' || chr(9) || chr(13) || chr(12) || chr(11))), lambda r: NOT regexp_matches(r, '^\\s*-?\\s*\\d{1,4}\\s*-?\\s*$')) AS x FROM l)
SELECT doc_id, regexp_replace(regexp_replace(array_to_string(x, chr(10)), '\\n{3,}', chr(10) || chr(10), 'g'), '^\\s+|\\s+$', '', 'g') AS testo FROM c"""


@query(_LINES)
def clean_text(spark, d):
    # blank lines, a page break, page numbers and other line ends go in between the lines and must go out again
    dirty = F.regexp_replace(F.regexp_replace("text", "\n", "  \t\r\n - 12 -\f"), r"\A", "  7 \n\n\n")
    return table(spark, d, "documents").select("doc_id", legal.clean_text(dirty).alias("testo"))


@query("""
WITH t AS (SELECT l_orderkey, string_agg(l_extendedprice || ' ' || l_partkey || ' ' || l_quantity || ' riga', chr(10) ORDER BY l_linenumber) AS x FROM lineitem GROUP BY l_orderkey),
u AS (SELECT l_orderkey, repeat(x, 3) || CASE WHEN l_orderkey % 3 = 0 THEN repeat('parola ', 60) ELSE '' END AS x FROM t)
SELECT l_orderkey, length(x)::BIGINT AS n, length(x) >= 400 AND length(regexp_replace(x, '[^0-9]', '', 'g')) > 0.4 * length(regexp_replace(x, '[^0-9A-Za-z]', '', 'g')) AS numerico FROM u""")
def numeric_passage_drop(spark, d):
    line = F.concat_ws(" ", F.col("l_extendedprice").cast("string"), "l_partkey", "l_quantity", F.lit("riga"))
    t = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", line.alias("t")))), lambda x: x["t"]), "\n").alias("x"))
    u = t.select("l_orderkey", F.concat(F.repeat("x", F.lit(3)), F.when(F.expr("l_orderkey % 3 = 0"), "parola " * 60).otherwise("")).alias("x"))
    return u.select("l_orderkey", F.length("x").cast("long").alias("n"), legal.mostly_digits(F.col("x")).alias("numerico"))


#: An act of lines for each customer: an order in four opens an article, one is a reference, the others are text.
_SEG = """
WITH o AS (SELECT o_custkey AS act, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders),
h AS (SELECT *, o_orderkey % 4 = 0 AS opens FROM o),
s AS (SELECT act, n, CASE WHEN opens THEN 'Art. ' || (o_orderkey % 100) END AS label, count(*) FILTER (WHERE opens) OVER (PARTITION BY act ORDER BY n) AS blocco FROM h)
SELECT act, blocco::BIGINT AS blocco, max(label) AS etichetta, count(*)::BIGINT AS righe FROM s GROUP BY act, blocco"""


@query(_SEG)
def article_segments(spark, d):
    from pyspark.sql import Window as W

    o = table(spark, d, "orders").withColumn("n", F.row_number().over(W.partitionBy("o_custkey").orderBy("o_orderkey")))
    k = F.expr("o_orderkey % 4")
    line = (
        F.when(k == 0, F.concat(F.lit("ART. "), F.expr("o_orderkey % 100"), F.lit(" - Disposizioni")))
        .when(k == 1, F.concat(F.lit("Articolo "), F.expr("o_orderkey % 100"), F.lit(" della Legge")))
        .when(k == 2, F.lit("Le domande si presentano all'ufficio competente entro i termini previsti dal bando e secondo le regole."))
        .otherwise(F.lit("testo"))
    )
    return passages.segments(o.select(F.col("o_custkey").alias("act"), "n", line.alias("line")))


_SPLIT = """
WITH RECURSIVE p AS (
SELECT doc_id, array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda r: trim(regexp_replace(r, '\\s+', ' ', 'g'))), lambda r: r <> ''), ' ') AS x FROM documents),
r AS (
SELECT doc_id, 0 AS n, '' AS piece, x AS rest FROM p WHERE length(x) > 0
UNION ALL
SELECT doc_id, n + 1, CASE WHEN length(rest) <= 3000 THEN rest ELSE trim(substr(rest, 1, cut + 1)) END, CASE WHEN length(rest) <= 3000 THEN '' ELSE trim(substr(rest, cut + 2)) END
FROM (SELECT doc_id, n, rest, CASE WHEN dot >= 1500 THEN dot WHEN blank > 0 THEN blank ELSE 3000 END AS cut FROM (
  SELECT doc_id, n, rest, 3002 - instr(reverse(substr(rest, 1, 3002)), ' .') - 1 + CASE WHEN instr(reverse(substr(rest, 1, 3002)), ' .') = 0 THEN -4000 ELSE 0 END AS dot,
  3001 - instr(reverse(substr(rest, 1, 3001)), ' ') + CASE WHEN instr(reverse(substr(rest, 1, 3001)), ' ') = 0 THEN -4000 ELSE 0 END AS blank FROM r WHERE rest <> ''))),
k AS (SELECT doc_id, n, piece FROM r WHERE n > 0 AND piece <> '')
SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY n) - 1)::INTEGER AS ordine, NULL::VARCHAR AS etichetta, piece AS testo FROM k
WHERE NOT (length(piece) >= 400 AND length(regexp_replace(piece, '[^0-9]', '', 'g')) > 0.4 * (length(regexp_replace(piece, '[^0-9]', '', 'g')) + length(regexp_replace(piece, '[^\\p{L}]', '', 'g'))))"""


@query(_SPLIT)
def passage_split(spark, d):
    one = F.array_join(F.filter(F.transform(F.split("text", "\n"), lambda r: F.trim(F.regexp_replace(r, r"\s+", " "))), lambda r: r != ""), " ")
    doc = table(spark, d, "documents").select("doc_id", one.alias("x")).where("x != ''")
    return doc.select("doc_id", F.explode(passages.passages(F.col("x"))).alias("p")).select("doc_id", "p.ordine", "p.etichetta", "p.testo")


@query("""
WITH o AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders)
SELECT o_custkey AS dedup_key, (n - 1 + 1)::INTEGER AS ordine, 'Art. ' || n || CASE WHEN o_orderkey % 2 = 0 THEN ' (Rubrica ' || o_orderkey || ')' ELSE '' END AS etichetta, 'Comma ' || o_orderkey || ' unito in riga.' AS testo FROM o
UNION ALL SELECT DISTINCT o_custkey, 0, 'Preambolo', 'Noi Consiglio Riunito' FROM orders""")
def act_passages(spark, d):
    from pyspark.sql import Window as W

    o = table(spark, d, "orders").withColumn("n", F.row_number().over(W.partitionBy("o_custkey").orderBy("o_orderkey")))
    art = F.concat(F.lit("Art. "), "n", F.lit("\n\n"), F.when(F.expr("o_orderkey % 2 = 0"), F.concat(F.lit("(Rubrica "), "o_orderkey", F.lit(")\n"))).otherwise(""), F.lit("Comma "), "o_orderkey", F.lit("  unito\nin riga.\n- 3 -\n\n\n"))
    text = o.groupBy("o_custkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", art.alias("t")))), lambda x: x["t"]), "").alias("t"))
    acts = text.select(F.col("o_custkey").alias("dedup_key"), F.lit("Legge").alias("titolo"), F.concat(F.lit("Noi Consiglio\r\nRiunito\n\n\n\n" + " " * 80), "t").alias("testo"))
    return passages.act_passages(acts)


def _listing(spark, d):
    """A listing page for each customer, a card for each order, details in the sibling block."""
    o = table(spark, d, "orders")
    k = F.col("o_orderkey").cast("string")
    row = F.concat(F.when(F.expr("o_orderkey % 5 = 0"), "").otherwise(F.concat(_type(), F.lit("\xa0"))), F.lit("numero <a href='#'>"), k, F.lit("</a> del "), F.date_format("o_orderdate", "dd/MM/yyyy"))
    card = F.concat(F.lit('<div id="card_'), k, F.lit('"><h3> '), F.upper(_type()), F.lit(" n."), k, F.lit(' </h3><a href="/documento/'), k, F.lit('.pdf">x</a></div><p>y</p><div class="z fl">'), row, F.lit("</div>"))
    cards = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", card.alias("c")))), lambda x: x["c"]), "")
    html = F.concat(F.lit("<body>Risultati trovati: <b>"), F.count("*").cast("string"), F.lit('</b><div id="card_x"><h3></h3></div>'), cards)
    return o.groupBy(F.col("o_custkey").alias("page")).agg(html.alias("html")).withColumn("base", F.lit("https://arc.example/on-line/home.html"))


@query(f"""
SELECT 'https://arc.example/documento/' || o_orderkey || '.pdf' AS url, CASE o_orderkey % 9 WHEN 4 THEN 'Decreto-Legge' WHEN 8 THEN 'Errata corrige' WHEN 7 THEN 'Legge di Revisione Costituzionale' ELSE {_TYPE} END AS tipo, o_orderkey::INTEGER AS numero,
strftime(o_orderdate, '%Y-%m-%d') AS data, {_KEY} AS chiave, upper({_TYPE}) || ' n.' || o_orderkey AS titolo, (count(*) OVER (PARTITION BY o_custkey))::INTEGER AS totale FROM orders""")
def archive_listing(spark, d):
    acts = archive.parse_listing(_listing(spark, d))
    return acts.select("url", "tipo", "numero", F.date_format("data", "yyyy-MM-dd").alias("data"), "chiave", "titolo", "totale")


@query("""
WITH c AS (SELECT count(*)::BIGINT AS n, max(k)::INTEGER AS totale FROM (SELECT count(*) OVER (PARTITION BY o_custkey) AS k FROM orders)), t AS (SELECT count(*)::BIGINT AS n FROM orders WHERE o_custkey % 5 = 0)
SELECT 'doppie' AS caso, c.n + t.n AS lette, c.n AS distinte, t.n AS doppie, totale, true AS completa FROM c, t
UNION ALL SELECT 'mancanti', n, n, 0, totale + 100000000, false FROM c""")
def archive_completeness(spark, d):
    """A crawl that read some acts twice, and one that read fewer than were stated."""
    # the pages are parsed once for both
    acts = Written(archive.parse_listing(_listing(spark, d)).select("page", "url", "totale"), "acts-read").df
    twice = archive.completeness(acts.unionByName(acts.where("page % 5 = 0"))).withColumn("caso", F.lit("doppie"))
    short = archive.completeness(acts.withColumn("totale", F.col("totale") + 100_000_000)).withColumn("caso", F.lit("mancanti"))
    return twice.unionByName(short)


#: Annexes with and without a sign, each of two paragraphs, the second of two lines.
@query("""
WITH o AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders),
l AS (SELECT *, CASE WHEN o_orderkey % 3 = 0 THEN 'Allegato' ELSE 'ALLEGATO ' || n END AS riga FROM o)
SELECT o_custkey AS dedup_key, (n - 1)::INTEGER AS ordine, replace(riga, 'ALLEGATO', 'Allegato') AS etichetta, riga || chr(10) || chr(10) || 'Voce ' || o_orderkey || ' e nota di chi legge la tabella intera, riga per riga.' AS testo FROM l""")
def annex_passages(spark, d):
    from pyspark.sql import Window as W

    o = table(spark, d, "orders").withColumn("n", F.row_number().over(W.partitionBy("o_custkey").orderBy("o_orderkey")))
    line = F.when(F.expr("o_orderkey % 3 = 0"), F.lit("Allegato")).otherwise(F.concat(F.lit("ALLEGATO "), "n"))
    annex = F.concat(line, F.lit("\n\n\n"), F.lit("Voce "), "o_orderkey", F.lit(" e nota\n di chi legge la tabella intera, riga per riga.\n"))
    text = o.groupBy("o_custkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", annex.alias("t")))), lambda x: x["t"]), "").alias("testo"))
    # the passages of every text, however short: act_passages() gives an act of a single such annex its title instead
    return text.select(F.col("o_custkey").alias("dedup_key"), F.explode(passages.passages(F.col("testo"))).alias("p")).select("dedup_key", "p.*")


@query("SELECT n_nationkey AS dedup_key, (i - 1)::INTEGER AS ordine, 'Art. ' || i AS etichetta, 'Testo ' || i || '.' AS testo FROM nation, (SELECT unnest(range(1, 451)) AS i) WHERE i <= 400")
def passage_limit(spark, d):
    """Acts of 450 articles."""
    text = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(450)), lambda i: F.concat(F.lit("Art. "), i, F.lit("\nTesto "), i, F.lit("."))), "\n")
    return passages.act_passages(table(spark, d, "nation").select(F.col("n_nationkey").alias("dedup_key"), F.lit("x").alias("titolo"), text.alias("testo")))


@query("SELECT r_regionkey AS dedup_key, count(*)::BIGINT AS brani, 285 * 2799::BIGINT AS unita FROM region, (SELECT unnest(range(0, 285)) AS i) GROUP BY r_regionkey")
def act_limit_in_units(spark, d):
    """Acts of 300 articles of 1399 characters beyond the basic plane and a stop: 800,000 UTF-16 units hold 285 of them."""
    body = F.concat(F.lit("\n"), F.repeat(F.lit("\U0001f600"), F.lit(1399)), F.lit("."))
    text = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(300)), lambda i: F.concat(F.lit("Art. "), i, body)), "\n")
    each = passages.act_passages(table(spark, d, "region").select(F.col("r_regionkey").alias("dedup_key"), F.lit("x").alias("titolo"), text.alias("testo")))
    return each.groupBy("dedup_key").agg(F.count("*").alias("brani"), F.sum(utf16_length(F.col("testo"))).cast("long").alias("unita"))


@query("""
SELECT p_partkey AS page, 'https://arc.example/documento/' || p_partkey AS url, 'Testo ' || p_name || ' (aggiornato al 15 aprile 2024)' AS titolo, 'c' || p_size AS categoria, DATE '2024-04-15' AS aggiornato_al, true AS coordinato FROM part""")
def archive_category(spark, d):
    p = table(spark, d, "part")
    html = F.concat(F.lit("<table><tr><th>x</th></tr><tr><td>Testo "), "p_name", F.lit(' (aggiornato al\n15 aprile 2024)<td><a href="documento/'), "p_partkey", F.lit('">pdf</a><tr><td>solo</table>'))
    rows = archive.parse_category(p.select(F.col("p_partkey").alias("page"), html.alias("html"), F.lit("https://arc.example/x").alias("base"), F.concat(F.lit("c"), "p_size").alias("categoria")))
    return rows.select("page", "url", "titolo", "categoria", "aggiornato_al", "coordinato")


@query("SELECT p_brand AS page, (row_number() OVER (PARTITION BY p_brand ORDER BY k) - 1)::BIGINT AS pos, 'Tipo ' || p_type AS nome, 'https://arc.example/t/testi-coordinati/docCat.' || p_type AS url FROM (SELECT p_brand, p_type, min(p_partkey) AS k FROM part GROUP BY p_brand, p_type)")
def archive_index(spark, d):
    link = F.concat(F.lit('<a href="/t/testi-coordinati/docCat.'), "p_type", F.lit('"> Tipo\n'), "p_type", F.lit('</a><a href="/altro">no</a>'))
    pages = table(spark, d, "part").groupBy(F.col("p_brand").alias("page")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", link.alias("l")))), lambda x: x["l"]), "").alias("html"))
    return archive.parse_index(pages.withColumn("base", F.lit("https://arc.example/x.html")))


@query("""
WITH u AS (SELECT o_custkey % 50 AS u, o_custkey AS page, o_orderkey AS pos FROM orders)
SELECT u, min_by(page, page * 1000000000 + pos) AS page, min_by(pos, page * 1000000000 + pos) AS pos FROM u GROUP BY u""")
def first_by_url(spark, d):
    o = table(spark, d, "orders").select(F.expr("o_custkey % 50").alias("url"), F.col("o_custkey").alias("page"), F.col("o_orderkey").alias("pos"))
    return archive.first_by_url(o).select(F.col("url").alias("u"), "page", "pos")
