"""Deduplication, enrichment, passages, delivery, micro-batches, runs."""

import datetime as dt
import json
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from lodestrand.operators import archive_runs, dedup, enrich, numbering, passages, sinks
from lodestrand.plans import queries, runner
from lodestrand.plans.registry import ORACLE
from lodestrand.sources import archive, catalogue
from lodestrand.streaming import upsert

DAY = dt.datetime(2026, 7, 10, tzinfo=dt.UTC)
RAW = "fonte_id int, pos long, titolo string, url string, testo string, immagine string, data timestamp, luogo string"


def docs(spark, *titles, day=DAY, fonte=1):
    rows = [(fonte, i, t, f"https://e.example/{i}", None, None, day, None) if isinstance(t, str) or t is None else t for i, t in enumerate(titles)]
    return spark.createDataFrame(rows, RAW)


def kept(df):
    return [r.pos for r in df.orderBy("pos").collect()]


def test_keep_first_is_not_transitive(spark):
    # a-b and b-c are duplicates, a-c are not: b goes for a, so c stays
    a, b, c = "uno due tre", "uno due tre quattro cinque sei", "quattro cinque sei"
    assert kept(dedup.keep_first(docs(spark, a, b, c))) == [0, 2]
    assert kept(dedup.keep_first(docs(spark, b, a, c))) == [0]


def test_keep_first_borders(spark):
    rows = [(1, 0, "Stessa cosa oggi", "", None, None, DAY, None), (2, 1, "Stessa cosa oggi", "", None, None, DAY, None), (1, 2, "Stessa cosa oggi", "", None, None, DAY + dt.timedelta(days=1), None), (1, 3, "stessa COSA, oggi!", "", None, None, DAY + dt.timedelta(hours=5), None), (1, 4, None, "", None, None, DAY, None), (1, 5, "Stessa cosa oggi", "", None, None, None, None), (1, 6, "!!", "", None, None, DAY, None), (1, 7, "??", "", None, None, DAY, None)]
    df = spark.createDataFrame(rows, RAW)
    assert kept(dedup.keep_first(df)) == [0, 1, 2, 4, 5, 6]
    assert dedup.keep_first(df.limit(0)).count() == 0


def test_keep_first_agrees_with_a_walk(spark):
    r = random.Random(2)
    words = [f"w{i}" for i in range(14)]
    titles = [" ".join(r.sample(words, r.randint(0, 7))) for _ in range(150)]
    held = []
    for i, t in enumerate(titles):
        w = set(t.split())
        if not any(dedup._alike(" ".join(titles[j].split()), set(titles[j].split()), t, w, 0.82) for j in held):
            held.append(i)
    assert kept(dedup.keep_first(docs(spark, *titles))) == held


def test_links_of_long_titles_are_those_of_all_pairs(spark):
    r = random.Random(7)
    words = [f"w{i}" for i in range(400)]
    titles = []
    for i in range(90):
        own = r.sample(words, r.choice([1, 2, 3, 50, 100, 200]))
        titles += [" ".join(own), " ".join(own[: max(1, round(len(own) * r.uniform(0.75, 1)))]), " ".join(own[: round(len(own) * 0.9)] + r.sample(words, len(own) // 12))]
    titles = list(dict.fromkeys(titles))
    both = spark.createDataFrame([(1, i, t, DAY) for i, t in enumerate(titles)] + [(2, i, t, DAY) for i, t in enumerate(titles[::3])], "fonte_id int, pos long, titolo string, data timestamp")
    got = sorted((x.fonte_id, x.a_pos, x.b_pos) for x in dedup.links(dedup.titles(both)).collect())
    sets = [set(t.split()) for t in titles]
    alike = lambda at: [(i, j) for i in range(len(at)) for j in range(i + 1, len(at)) if dedup._alike(titles[at[i]], sets[at[i]], titles[at[j]], sets[at[j]], 0.82)]
    want = [(1, i, j) for i, j in alike(range(len(titles)))] + [(2, i, j) for i, j in alike(range(0, len(titles), 3))]
    assert got == sorted(want) and len(want) > 100


def test_words_of_titles_are_not_all_shuffled(spark):
    # a title of 1000 words is looked for by its 181 rarest
    df = docs(spark, *(" ".join(f"x{i}w{j}" for j in range(1000)) for i in range(4)))
    each = dedup.numbered(dedup.titles(df)).df
    words = dedup._words(each)
    places = dedup._places(words, dedup._rarity(words), 0.82)
    assert places.count() == 4 * 181 and places.where("first").count() == 4
    assert dedup._members(words, places.where("first")).count() < 40


def test_keep_best_replaces_in_place(spark):
    longer = lambda a, b: b if len(b["titolo"]) > len(a["titolo"]) else a
    got = dedup.keep_best(docs(spark, "uno due tre", "altro titolo", "uno due tre quattro", "tre quattro cinque"), longer).orderBy("pos").collect()
    assert [(r.pos, r.titolo) for r in got] == [(0, "uno due tre quattro"), (1, "altro titolo"), (3, "tre quattro cinque")]


def test_row_numbers(spark):
    df = spark.range(200).select(F.expr("case when id % 3 = 2 then null else id % 3 end").alias("g"), (200 - F.col("id")).alias("o"))
    got = numbering.row_numbers(df, ["g"], ["o"], "rn", "n").collect()
    for g in (0, 1, None):
        own = sorted((r.o, r.rn, r.n) for r in got if r.g == g)
        assert [x[1] for x in own] == list(range(len(own))) and {x[2] for x in own} == {len(own)}


def test_enrichment(spark):
    noon = DAY + dt.timedelta(hours=12)
    df = docs(spark, "alfa uno", "beta due", "gamma tre", (1, 3, "delta", "https://e.example/3", None, None, noon, None), (1, 4, "epsilon", "", None, None, DAY, None))
    key = lambda t: f"{t}|2026-07-10"
    known = spark.createDataFrame([(key("alfa uno"), DAY + dt.timedelta(hours=21)), (key("beta due"), DAY)], "dedup_key string, data_inizio timestamp")
    assert {r.titolo: r.via for r in enrich.route(df, known).collect()} == {"alfa uno": "reuse", "beta due": "retry", "gamma tre": "new"}
    page = '<div class="x">12:00 <p>QUANDO <b>10 lug 2026</b>\n 20:30 DOVE</div>'
    times = spark.createDataFrame([(f"https://e.example/{i}", page) for i in range(5)], "url string, html string").select("url", enrich.detail_time(F.col("html"), F.lit(".x"), F.lit("QUANDO")).alias("ora"))
    got = {r.titolo: r.data.hour for r in enrich.enrich(df, known, times, run=0, most=1).collect()}
    assert got == {"alfa uno": 21, "beta due": 0, "gamma tre": 20, "delta": 12, "epsilon": 0}
    other = times.withColumn("ora", F.lit(DAY + dt.timedelta(days=1, hours=3)))
    assert {r.titolo: r.data.hour for r in enrich.enrich(df, known, other, run=0).collect()}["gamma tre"] == 0


def test_rotation_reaches_all(spark):
    df = docs(spark, *[f"evento numero {i}" for i in range(6)])
    known = spark.createDataFrame([(f"evento numero {i}|2026-07-10", DAY) for i in range(6)], "dedup_key string, data_inizio timestamp")
    seen = [{r.pos for r in enrich.to_open(enrich.route(df, known), run, 2).collect()} for run in range(4)]
    assert seen == [{0, 1}, {2, 3}, {4, 5}, {0, 1}]


ACT = """Noi Consiglio Riunito
visto il decreto

Art. 1
(Finalità)
La presente legge
ha un fine.

Art. 2 - Il comma dice quanto previsto dall'
Articolo 5 della legge citata.
Art.3-bis
Testo.

Allegato A
Tabella
"""


def test_passages():
    got = [(p["ordine"], p["etichetta"], p["testo"]) for p in passages.split(ACT.strip())]
    assert got == [
        (0, "Preambolo", "Noi Consiglio Riunito visto il decreto"), (1, "Art. 1 (Finalità)", "La presente legge ha un fine."),
        (2, "Art. 2", "Il comma dice quanto previsto dall' Articolo 5 della legge citata."), (3, "Art. 3-bis", "Testo."), (4, "Allegato A", "Allegato A Tabella"),
    ]
    assert passages.split("Solo testo") == [{"ordine": 0, "etichetta": None, "testo": "Solo testo"}]
    assert [p["etichetta"] for p in passages.split("Articolo Unico\nTesto")] == ["Articolo Unico"]
    mid = "x" * 80 + " previsto\nArt. 5 stabilisce"
    assert len(passages.split(mid)) == 1


def test_long_passages():
    sentence = "Una frase di prova che si ripete. "
    text = "Art. 1\n" + sentence * 300 + "\n\n" + sentence * 20
    got = passages.split(text)
    assert [p["etichetta"] for p in got] == ["Art. 1"] + ["Art. 1 (segue)"] * (len(got) - 1)
    assert all(len(p["testo"]) <= 3000 for p in got)
    assert sum(len(p["testo"]) for p in got) > 0.95 * len(text.strip()) - 20
    assert passages.split("12 34 56 " * 80) == []
    assert len(passages.split("\n".join(f"Art. {i}\nTesto." for i in range(600)))) == 400


def test_act_without_text_has_its_title(spark):
    acts = spark.createDataFrame([("u1", "Legge n.1", None), ("u2", "Legge n.2", "corto"), ("u3", "Legge n.3", "testo lungo " * 20)], "dedup_key string, titolo string, testo string")
    got = {r.dedup_key: r.testo for r in passages.act_passages(acts).collect()}
    assert got["u1"] == "Legge n.1" and got["u2"] == "Legge n.2" and got["u3"].startswith("testo lungo")


def test_single_short_annex_is_a_passage(spark, tmp_path):
    """A customer with one order: an annex of fewer than 80 characters, as the SQL of annex_passages has it."""
    path = str(tmp_path / "orders.parquet")
    spark.createDataFrame([(1, 7, 10480), (2, 8, 3), (3, 8, 4)], "x long, o_custkey long, o_orderkey long").write.parquet(path)
    con = duckdb.connect()
    con.execute(f"create view orders as select * from read_parquet('{path}/*.parquet')")
    want = sorted(con.execute(ORACLE["annex_passages"]).fetchall())
    assert sorted(map(tuple, queries.queries()["annex_passages"](spark, str(tmp_path)).collect())) == want and len(want) == 3


def test_long_titles_move_once(spark):
    """Titles of 15,000 words on one day: no candidate row holds a text, so what is joined stays small."""
    texts = [" ".join(f"w{(i % 3) * 6000 + k}x{i // 3}" for k in range(15_000)) for i in range(12)]
    near = [x.replace(x.split()[7], "altro", 1) for x in texts]
    got = kept(dedup.keep_first(docs(spark, *texts, *near)))
    assert got == list(range(12))
    pairs = dedup.links(dedup.titles(docs(spark, "uno due tre", "uno due tre quattro", "cinque")))
    assert [(r.a, r.b, r.a_pos, r.b_pos) for r in pairs.collect()] == [("uno due tre", "uno due tre quattro", 0, 1)]


def test_upserts(spark, tmp_path):
    t = sinks.KeyedTable(spark, str(tmp_path / "t"), "dedup_key string, v int")
    rows = lambda *x: spark.createDataFrame(x, "dedup_key string, v int")
    assert t.read().count() == 0 and t.upsert(rows(("a", 1)).limit(0)) == {"scritte": 0, "nuove": 0}
    assert t.upsert(rows(("a", 1), ("b", 2), ("b", 2))) == {"scritte": 2, "nuove": 2}
    assert t.upsert(rows(("b", 3), ("c", 4))) == {"scritte": 2, "nuove": 1}
    assert t.upsert(rows(("b", 3), ("c", 4)), 1) == {"scritte": 2, "nuove": 1}
    want = [("a", 1), ("b", 3), ("c", 4)]
    assert sorted(map(tuple, t.read().collect())) == want
    t.compact()
    assert sorted(map(tuple, t.read().collect())) == want
    assert t.upsert(rows(("a", 9))) == {"scritte": 1, "nuove": 0} and t.delete(rows(("c", 0))) == 1
    assert sorted(map(tuple, t.read().collect())) == [("a", 9), ("b", 3)]
    with pytest.raises(Exception, match="no key"):
        t.upsert(rows((None, 1)))


def test_guards(spark):
    stored = spark.createDataFrame([(f"u{i}", True) for i in range(30)] + [("o", False)], "url string, coordinato boolean")
    with pytest.raises(ValueError, match="nothing is retired"):
        sinks.retired(stored, stored.where("url in ('u1', 'u2')"))
    assert sinks.retired(stored, stored.where("url < 'u3'")).count() > 0
    assert [sinks.too_many_errors(*x) for x in ((3, 0), (4, 100), (4, 80), (6, 100), (0, 10, 1))] == [False, False, False, True, True]


def test_micro_batches(spark, tmp_path):
    t, said = sinks.KeyedTable(spark, str(tmp_path / "t"), "dedup_key string, v int"), []
    for n, rows in enumerate(([("a", 1), ("b", 1)], [("b", 2), ("c", 2)])):
        spark.createDataFrame(rows, "dedup_key string, v int").coalesce(1).write.mode("append").json(str(tmp_path / "in"))
        q = upsert.upserts(upsert.landed(spark, str(tmp_path / "in"), "dedup_key string, v int"), t, str(tmp_path / "state"), report=lambda i, c: said.append((i, c["scritte"], c["nuove"])))
        q.awaitTermination()
        assert len(said) == n + 1
    assert said == [(0, 2, 2), (1, 2, 1)] and sorted(map(tuple, t.read().collect())) == [("a", 1), ("b", 2), ("c", 2)]


FEED = '<rss><channel>{}</channel></rss>'
ITEM = "<item><title>{0}</title><link>https://n.example/{0}</link><pubDate>Wed, 24 Jun 2026 09:30:00 +0000</pubDate></item>"


def test_runs_of_a_catalogue(spark, tmp_path):
    pages = tmp_path / "pages"
    for name, text in (("1", FEED.format(ITEM.format("Alfa") + ITEM.format("Beta"))), ("2", FEED.format("")), ("3", "<article><h2>Festa</h2><time>10 luglio 2026</time></article>")):
        pages.mkdir(exist_ok=True)
        (pages / name).write_text(text)
    sel = json.dumps({"item": "article", "titolo": "h2", "data": "time"})
    fonti = [{"id": 1, "nome": "buona", "config": {"url": "u", "tipo": "notizia", "formato": "rss"}}, {"id": 2, "nome": "vuota", "config": {"url": "u", "tipo": "notizia", "formato": "rss"}}, {"id": 3, "nome": "eventi", "config": {"url": "u", "tipo": "evento", "formato": "html", "selettori": sel}}]
    (tmp_path / "c.json").write_text(json.dumps({"fonti": fonti}))
    now, target = dt.datetime(2026, 6, 25, tzinfo=dt.UTC), str(tmp_path / "out")
    for n in (0, 1):
        assert runner.run_all(spark, catalogue.read(spark, str(tmp_path / "c.json")), str(pages), now, target) == (1, ["vuota"])
    log = {(r.fonte_id, r.esito, r.nuove) for r in spark.read.parquet(f"{target}/ingestione_esito").collect()}
    assert log == {(1, "ok", 2), (1, "ok", 0), (2, "errore", None), (3, "ok", 1), (3, "ok", 0)}
    dry = runner.run(spark, runner.Job(str(pages / "1")), now)
    assert dry.code == runner.OK and dry.rows.count() == 2
    assert runner.run(spark, runner.Job("x", "notizia", "json"), now).code == runner.USAGE


def test_legislation_run(spark, tmp_path):
    card = '<div id="card_{0}"><h3>LEGGE {0} marzo 2025 n.{0}</h3><a href="/documento{0}">x</a></div><div class="fl">Legge numero <a>{0}</a> del {0:02d}/03/2025</div>'
    page = lambda *n: spark.createDataFrame([(1, f"Risultati trovati: {len(n)}" + "".join(map(card.format, n)), "https://c.example/")], "page long, html string, base string")
    texts = spark.createDataFrame([(f"https://c.example/documento{i}", ACT if i < 4 else None, None if i < 5 else "404") for i in range(1, 6)], "url string, testo string, errore string")
    target = str(tmp_path)
    first = runner.run_legislation(spark, archive.parse_listing(page(1, 2, 3)), texts, target, most_new=2)
    assert first.code == runner.OK and (first.counts["tentati"], first.counts["nuovi"]) == (2, 2)
    second = runner.run_legislation(spark, archive.parse_listing(page(1, 2, 3, 4, 5)), texts, target)
    assert second.counts == {"elencati": 5, "tentati": 3, "scritti": 2, "nuovi": 2, "senza_testo": 1, "errori": 1, "elenchi_incompleti": 0}
    acts = sinks.KeyedTable(spark, f"{target}/atto_normativo", runner.schema.ACT).read()
    assert {r.numero: r.chiave for r in acts.collect()} == {n: f"o:2025/{n}" for n in (1, 2, 3, 4)}
    brani = sinks.KeyedTable(spark, f"{target}/atto_normativo_brano", archive_runs.CHILD).read()
    assert {r.dedup_key[-1]: len(r.brani) for r in brani.collect()} == {"1": 5, "2": 5, "3": 5, "4": 1}
