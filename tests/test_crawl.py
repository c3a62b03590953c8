"""Crawls over a landing folder that stands for the network, to the counters; tables that a crash leaves half written."""

import datetime as dt
import json
import time

import pytest
from pyspark.sql import functions as F

from lodestrand import __main__ as command
from lodestrand.operators import archive_runs, sinks
from lodestrand.plans import crawl, runner
from lodestrand.sources import archive, rest, schema

PAGE, INDEX = "https://arc.example/home.html", "https://arc.example/indice"


name = rest.file_name


def card(n, year):
    return f'<div id="card_{n}"><h3>LEGGE {n} marzo {year} n.{n}</h3><a href="/documento{n}">x</a></div><div class="fl">Legge numero <a>{n}</a> del {n % 28 + 1:02d}/03/{year}</div>'


def listing(cards, total):
    return f"<body>{'' if total is None else f'Risultati trovati: <b>{total}</b>'}{''.join(cards)}"


@pytest.fixture
def site(tmp_path):
    """Acts 1 to 5 on two pages of 2029 to 2033, act 6 in the window before, whose listing states two; the window before that is missing."""
    folder = tmp_path / "site"
    folder.mkdir()
    put = lambda url, text: (folder / name(url)).write_bytes(text.encode() if isinstance(text, str) else text)
    put(archive.listing_url(PAGE, 2029, 2033, 1), listing([card(n, 2033) for n in (1, 2, 3)], 6))
    put(archive.listing_url(PAGE, 2029, 2033, 2), listing([card(n, 2032) for n in (3, 4, 5)], 6))
    put(archive.listing_url(PAGE, 2024, 2028, 1), listing([card(6, 2027)], 2))
    put(archive.listing_url(PAGE, 2024, 2028, 2), listing([], 2))
    for n in (1, 2, 3, 4):
        put(f"https://arc.example/documento{n}", f"Art. 1\nTesto dell'atto {n}, che dispone quanto segue in modo abbastanza lungo da contare come testo.\nArt. 2\nFine.")
    put("https://arc.example/documento5", "breve")
    return folder


def fetcher(folder, **more):
    return crawl.Fetcher(rest.from_folder(str(folder)), pause=0, waits=(0,), **more)


def test_pages_of_windows(spark, site):
    pages = crawl.listing_pages(archive.windows(spark, 2019, 2033), PAGE, fetcher(site)).orderBy("page").collect()
    assert [(r.page, r.letti, r.totale, r.errore is None) for r in pages] == [(1, 3, 6, True), (2, 3, 6, True), (1001, 1, 2, True), (1002, 0, 2, True), (2001, 0, None, False)]
    one = crawl.listing_pages(archive.windows(spark, 2029, 2033), PAGE, fetcher(site), most=1).collect()
    assert len(one) == 1
    assert crawl.listing_pages(archive.windows(spark, 2019, 2033), PAGE, fetcher(site, until=time.time() - 1)).count() == 0


def test_legislation(spark, site, tmp_path):
    target, run = str(tmp_path / "out"), lambda first, **more: crawl.legislation(spark, PAGE, first, 2033, fetcher(site), reader=bytes.decode, **more)
    dry = run(2029)
    assert dry.code == runner.OK and dry.counts == {"elencati": 5, "elenchi_incompleti": 0} and dry.rows.count() == 5
    first = run(2029, target=target, most_new=2)
    assert first.code == runner.OK and (first.counts["elencati"], first.counts["tentati"], first.counts["nuovi"]) == (5, 2, 2)
    second = run(2019, target=target)
    assert second.code == runner.EMPTY  # a listing is short and another can't be read
    assert second.counts == {"elencati": 6, "tentati": 4, "scritti": 3, "nuovi": 3, "senza_testo": 1, "errori": 1, "elenchi_incompleti": 2}
    acts = sinks.KeyedTable(spark, f"{target}/atto_normativo", schema.ACT)
    brani = sinks.KeyedTable(spark, f"{target}/atto_normativo_brano", archive_runs.CHILD, follows=acts)
    assert {r.numero for r in acts.read().collect()} == {1, 2, 3, 4, 5}
    assert {r.dedup_key[-1]: len(r.brani) for r in brani.read().collect()} == {"1": 2, "2": 2, "3": 2, "4": 2, "5": 1}
    late = crawl.legislation(spark, PAGE, 2029, 2033, fetcher(site, until=time.time() - 1), reader=bytes.decode, target=str(tmp_path / "late"))
    assert late.counts["tentati"] == 0


def test_consolidated_texts_are_retired(spark, site, tmp_path):
    rows = lambda n: "".join(f'<tr><td>Testo {i} (aggiornato al 3 aprile 2030)<td><a href="documento9{i}">pdf</a>' for i in range(n))
    (site / name(INDEX)).write_text('<a href="testi-coordinati/docCat.1">Uno</a><a href="testi-coordinati/docCat.2">Due</a>')
    (site / name("https://arc.example/testi-coordinati/docCat.2")).write_text("<table></table>")
    category, target = site / name("https://arc.example/testi-coordinati/docCat.1"), str(tmp_path / "out")
    for i in range(25):
        (site / name(f"https://arc.example/testi-coordinati/documento9{i}")).write_text(f"Articolo unico\nTesto consolidato numero {i}, che ha parole a sufficienza per valere come testo di un atto.")
    run = lambda: crawl.legislation(spark, PAGE, 2029, 2033, fetcher(site), target=target, index=INDEX, reader=bytes.decode)
    category.write_text(f"<table>{rows(25)}</table>")
    assert run().counts | {"tentati": 0} == {"elencati": 30, "tentati": 0, "scritti": 30, "nuovi": 30, "senza_testo": 1, "errori": 0, "elenchi_incompleti": 0, "ritirati": 0}
    category.write_text(f"<table>{rows(24)}</table>")
    assert run().counts["ritirati"] == 1
    category.write_text(f"<table>{rows(3)}</table>")
    short = run()
    assert short.code == runner.EMPTY and "ritirati" not in short.counts  # too few to believe
    assert sinks.KeyedTable(spark, f"{target}/atto_normativo", schema.ACT).read().where("coordinato").count() == 24


def test_refused_requests_go_through_the_gateway(spark, site):
    def refused(url):
        if not url.startswith("https://gate.example/?u="):
            raise rest.Refused("status 403")
        return b"through " + url.encode()

    both = crawl.Fetcher(refused, rest.through("https://gate.example/?u=", refused), pause=0, waits=(0,))
    alone = crawl.Fetcher(refused, pause=0, waits=(0,))
    urls = spark.createDataFrame([("https://arc.example/a b",)], "url string")
    assert crawl.fetched(urls, both).first().testo == "through https://gate.example/?u=https%3A%2F%2Farc.example%2Fa%20b"
    assert crawl.fetched(urls, alone).first().errore == "Refused: status 403"


def test_institutional_details(spark, site):
    (site / name(INDEX)).write_text('<ul><li><a href="/d/1">a</a><li><a href="/d/2">b</a><li><a href="/d/1">c</a></ul>')
    (site / name("https://arc.example/d/1")).write_text("<h1>Delibera</h1><main><p>" + "parole " * 20 + "</p></main>")
    got = crawl.institutional_pages(spark, INDEX, "li a", fetcher(site)).collect()
    assert {r.url: r.errore for r in got} == {"https://arc.example/d/1": None, "https://arc.example/d/2": "Missing: status 404"}


def test_posts_with_their_images(spark, site):
    endpoint = "https://arc.example/wp/v2/eventi"
    posts = [{"link": f"https://e.example/{i}", "title": {"rendered": f"Mostra {i}"}, "featured_media": 5, "acf": {"data_inizio": "20330310"}} for i in range(3)]
    (site / name(rest.page_url(endpoint, 1))).write_text(json.dumps(posts))
    (site / name("https://arc.example/wp/v2/media?include=5&per_page=100&_fields=id,source_url")).write_text(json.dumps([{"id": 5, "source_url": "https://e.example/5.jpg"}]))
    now = F.lit(dt.datetime(2033, 3, 1, tzinfo=dt.UTC))
    got = crawl.posts_with_images(spark, endpoint, 7, now, str(site)).collect()
    assert len(got) == 3 and {r.immagine for r in got} == {"https://e.example/5.jpg"}


def test_commands(spark, site, capsys, tmp_path, monkeypatch):
    monkeypatch.setenv("GITHUB_STEP_SUMMARY", str(tmp_path / "summary"))
    assert command.main(["legislation", "--pagina", PAGE, "--dal", "2029", "--al", "2033", "--folder", str(site), "--pausa", "0"]) == runner.OK
    assert capsys.readouterr().out.count('"titolo"') == 5 and "elencati" in (tmp_path / "summary").read_text()
    assert command.main(["legislation"]) == runner.USAGE and command.main(["feed", "--path", "x", "--push"]) == runner.UNCONFIGURED
    (site / name("https://n.example/feed")).write_text("<rss><channel><item><title>Alfa</title><link>https://n.example/a</link><pubDate>Wed, 24 Jun 2099 09:30:00 +0000</pubDate></item></channel></rss>")
    assert command.main(["feed", "--url", "https://n.example/feed", "--folder", str(site)]) == runner.OK
    assert "Alfa" in capsys.readouterr().out
    (site / "bandi.html").write_text('<div class="accordion"><div class="accordion__title">Concorso</div><p>Repertorio</p><p>4/2033</p><a href="/d">Visualizza</a><a href="m.pdf">Modulo</a></div>')
    assert command.main(["notices", "--path", str(site / "bandi.html"), "--base", "https://g.example/"]) == runner.OK
    assert capsys.readouterr().out == "• Concorso\n  ? · 4/2033 · aperto\n  PDF Modulo\n      https://g.example/m.pdf\n"


def keyed(spark, tmp_path, **more):
    return sinks.KeyedTable(spark, str(tmp_path / "t"), "dedup_key string, v int", **more)


def rows(spark, *x):
    return spark.createDataFrame(x, "dedup_key string, v int")


def test_a_crash_while_folders_go(spark, tmp_path, monkeypatch):
    t = keyed(spark, tmp_path)
    t.upsert(rows(spark, ("a", 1), ("b", 1)))
    t.upsert(rows(spark, ("b", 2), ("c", 2)))
    monkeypatch.setattr(sinks, "remove", lambda *_: (_ for _ in ()).throw(OSError("gone")))
    assert t.delete(rows(spark, ("a", 0))) == 1  # nothing is old enough to go
    with pytest.raises(OSError):
        t.compact()
    assert sorted(map(tuple, t.read().collect())) == [("b", 2), ("c", 2)]
    monkeypatch.undo()
    assert t.upsert(rows(spark, ("d", 4))) == {"scritte": 1, "nuove": 1}
    t.compact()
    assert sorted(map(tuple, t.read().collect())) == [("b", 2), ("c", 2), ("d", 4)]
    # a delivery whose number a base holds by now comes last
    assert t.upsert(rows(spark, ("b", 9)), 0) == {"scritte": 1, "nuove": 0} and ("b", 9) in map(tuple, t.read().collect())


def test_a_base_that_was_not_finished_does_not_count(spark, tmp_path):
    t = keyed(spark, tmp_path)
    t.upsert(rows(spark, ("a", 1)))
    half = tmp_path / "t" / "base-0000000000-0000000001"
    half.mkdir()
    assert list(map(tuple, t.read().collect())) == [("a", 1)]
    t.compact()
    assert list(map(tuple, t.read().collect())) == [("a", 1)] and (half / "_SUCCESS").exists()


def test_children_count_with_their_parents(spark, tmp_path):
    parents = keyed(spark, tmp_path / "p")
    children = keyed(spark, tmp_path / "c", follows=parents)
    sinks.replace_children(parents, children, rows(spark, ("a", 1)), rows(spark, ("a", 10)))
    children.upsert(rows(spark, ("b", 20)), parents.next_number())  # and then a crash
    assert [r.dedup_key for r in children.read().collect()] == ["a"]
    children.compact(), parents.compact()
    sinks.replace_children(parents, children, rows(spark, ("c", 3)), rows(spark, ("c", 30)))
    assert sorted(r.dedup_key for r in children.read().collect()) == ["a", "c"] == sorted(r.dedup_key for r in parents.read().collect())
