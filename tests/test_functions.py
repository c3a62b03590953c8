"""Column functions: dates, titles, legal keys and citations, text."""

import datetime as dt
import random

import pytest
from helpers import values
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodestrand.functions import dates, decode, legal, similarity, text, urls


def iso(spark, *rows, **options):
    return values(spark, lambda a: dates.iso_instant(dates.parse_date(a, **options)), *rows)


def test_dates_with_zones(spark):
    got = iso(spark, "Wed, 24 Jun 2026 09:30:00 +0200", "24 Jun 2026 00:30 +0100", "24 Jun 2026 20:00 -05:00", "24 Jun 2026 10:00 GMT", "24 Jun 2026 10:00 CEST", "24 Jun 2026 10:00 XYZ", zoned=True)
    assert got == ["2026-06-24T07:30:00.000Z", "2026-06-23T23:30:00.000Z", "2026-06-25T01:00:00.000Z", "2026-06-24T10:00:00.000Z", "2026-06-24T08:00:00.000Z", "2026-06-24T10:00:00.000Z"]


def test_dates_in_words(spark):
    got = iso(
        spark, "10 luglio 2026", "18/07/2026", "18-7-2026", "martedì, 10 Novembre 2026 -21:00", "10 novembre 2026 - 20:45", "11 nov 2026\n21:00", "10 novembre 2026, ore 21.00", "Wed, 24 Jun 2026 09:30:00 +0200", "dal 3 al 5", "32 foo 2026", "", "  ", None, "31/02/2026", "10 nov 2026 21:00",
    )
    day = lambda d, t="00:00": f"{d}T{t}:00.000Z"
    assert got == [
        day("2026-07-10"), day("2026-07-18"), day("2026-07-18"), day("2026-11-10", "21:00"), day("2026-11-10", "20:45"), day("2026-11-11", "21:00"), day("2026-11-10", "21:00"), day("2026-06-24", "09:30"),
        None, None, None, None, None, day("2026-03-03"), day("2026-11-10", "21:00"),
    ]


def test_iso_dates(spark):
    got = iso(spark, "2026-06-24", "20261001", "2026-06-24T10:00:00Z", "2026-06-24T10:00:00.123456+02:00", "2026-13-45", "2026-06-24 10:00", "2026-06-24x")
    assert got == ["2026-06-24T00:00:00.000Z", "2026-10-01T00:00:00.000Z", "2026-06-24T10:00:00.000Z", "2026-06-24T08:00:00.123456Z", "2027-02-14T00:00:00.000Z", "2026-06-24T10:00:00.000Z", None]


def test_deadlines(spark):
    read = lambda prose: lambda a: dates.iso_instant(dates.parse_deadline(a, prose))
    field = values(
        spark, read(False), "entro le ore 17:30 di venerdì 9 ottobre 2026", "ENTRO LE ORE 16.05 DI MARTEDÌ 8 AGOSTO 2028", "ore 13:00 del giorno sabato 6 gennaio 2029 per via telematica", "ore 25:00 di 5 gennaio 2024", "ore 10:00 di 31 febbraio 2024",
        "da ore 07:30 di mercoledì 5 luglio 2028 ed entro le ore 19:00 di venerdì 28 luglio 2028", "da ore 07:30 di mercoledì 5 luglio 2028 a ore 19:00 di venerdì 28 luglio 2028", None, "nessuna",
    )
    assert field == ["2026-10-09T15:30:00.000Z", "2028-08-08T14:05:00.000Z", "2029-01-06T12:00:00.000Z", None, None, "2028-07-28T17:00:00.000Z", None, None, None]
    far = "entro " + "x" * 60 + " ore 10:00 di 5 marzo 2026"
    prose = values(spark, read(True), "si apre alle ore 09:15 di martedì 3 novembre 2026 presso gli sportelli indicati in calce e si chiude, fino a ore 11:45 di lunedì 16 novembre 2026", "alle ore 10:00 di 5 marzo 2026", "entro le ore 10:00 di 5 marzo 2026 o entro le ore 11:00 di 6 marzo 2026", far)
    assert prose == ["2026-11-16T10:45:00.000Z", None, None, None]


def test_summer_time_borders(spark):
    rows = [(dt.date(2026, 3, 29), 1), (dt.date(2026, 3, 29), 2), (dt.date(2026, 10, 25), 2), (dt.date(2026, 10, 25), 3), (dt.date(2026, 12, 1), 12)]
    assert values(spark, dates.summer_hours, *rows, schema="a date, b int") == [1, 2, 2, 1, 1]


def test_month_threshold_runs_over(spark):
    back = lambda a: dates.iso_instant(dates.months_back(a, 2))
    rows = [dt.datetime(2026, 4, 30, 9, tzinfo=dt.UTC), dt.datetime(2026, 6, 25, 23, 59, tzinfo=dt.UTC)]
    assert values(spark, back, *rows, schema="a timestamp") == ["2026-03-02T00:00:00.000Z", "2026-04-25T00:00:00.000Z"]


def test_yyyymmdd(spark):
    assert values(spark, lambda a: dates.iso_instant(dates.parse_yyyymmdd(a)), "20260812", "20260231", "2026", " 20260101 ", "2026081x", None, "20261301") == ["2026-08-12T00:00:00.000Z", None, None, "2026-01-01T00:00:00.000Z", None, None, None]


def test_updated_dates(spark):
    got = values(spark, dates.parse_updated, "Codice (aggiornato al 26 settembre 2025)", "(aggiornamento a maggio 2026)", "(Aggiornato 31 ottobre 2022)", "(aggiornata all'11 aprile 2024)", "(aggiornato all’11 aprile 2024)", "(aggiornato al 5 brumaio 2024)", "Codice")
    day = dt.date
    assert got == [day(2025, 9, 26), day(2026, 5, 1), day(2022, 10, 31), day(2024, 4, 11), day(2024, 4, 11), None, None]


def test_titles(spark):
    assert values(spark, text.normal_title, "  Città di Fantasìa: «La Notizia»!  ", "ÀÉÎÕÜ ß ø", "***", None) == ["citta di fantasia la notizia", "aeiou", "", None]
    key = lambda a: similarity.dedup_key(a, F.lit(dt.datetime(2026, 7, 10, 23, 30, tzinfo=dt.UTC)))
    assert values(spark, key, "Sagra della Piadina!") == ["sagra della piadina|2026-07-10"]


def test_duplicate_rule(spark):
    same = lambda a, b: similarity.alike(text.normal_title(a), text.tokens(text.normal_title(a)), text.normal_title(b), text.tokens(text.normal_title(b)))
    rows = [
        ("Cena al Tramonto Collina 2026", "CENA AL TRAMONTO COLLINA"),  # contained, four words
        ("Concerto di Natale", "Concerto"),  # contained, too short
        ("Concerto Natale", "Concerto Natale Duomo"),  # two words prove nothing
        ("a b c d e f g h i", "a b c d e f g h x"),  # 0.8
        ("a b c d e f g h i j k", "a b c d e f g h i j x"),  # 10 of 12: 0.83
        ("!!!", "???"),
        ("", "parola"),
    ]
    assert values(spark, same, *rows, schema="a string, b string") == [True, False, False, False, True, True, False]


@settings(max_examples=10, deadline=None)
@given(st.text(max_size=60))
def test_normal_title_is_idempotent(spark, s):
    once = values(spark, text.normal_title, s)
    assert values(spark, text.normal_title, once[0]) == once


def test_excerpts_count_utf16_units(spark):
    cut = lambda a: text.excerpt(a, 5)
    assert values(spark, cut, "abcde", "abcdef", "abcd ef", "ab😀cd", "ab😀c", "abcd😀", "   ", None) == ["abcde", "abcde…", "abcd…", "ab😀c…", "ab😀c", "abcd…", None, None]


def test_first_image(spark):
    html = ['<img src="data:x"><IMG alt=1 src = \'https://a/b.png\'>', '<img src=" ">', "no", None]
    assert values(spark, text.first_image, *html) == ["https://a/b.png", None, None, None]


def test_act_keys(spark):
    assert values(spark, legal.family, "Legge", "Legge Qualificata", "Legge di Revisione Costituzionale", "Decreto - Legge", "Regolamento", "Errata corrige") == ["o", "q", "c", "o", "r", None]
    kinds = ["decreto  -  legge", "DECRETO LEGGE", "errata corrige del", "legge di revisione costituzionale", "DECRETO consiliare", "legge qualificata"]
    assert values(spark, legal.normal_type, *kinds) == ["Decreto-Legge", "Decreto-Legge", "Errata corrige", "Legge di Revisione Costituzionale", "Decreto Consiliare", "Legge Qualificata"]
    assert values(spark, legal.type_of_title, "DECRETO REGGENZIALE 4 aprile 2031 n.12", "Errata Corrige", "Notifica", "Leggere", "Leggeà") == ["DECRETO REGGENZIALE", "Errata corrige", "Atto", "Atto", "Legge"]


def test_citations(spark):
    title = "Regolamento 9 maggio 2031 n.77 - Attua la Legge 2 febbraio 2030, n. 61 con la legge qualificata n.8/1999, poi di nuovo Legge 2 febbraio 2030 n° 61, Legge 3 brumaio 2030 n.4"
    got = values(spark, lambda a: legal.cited_keys(a, F.lit("r:2031/77")), title, "niente", None)
    assert got == [["o:2030/61", "q:1999/8"], [], None]
    each = values(spark, legal.citations, "Legge n.5/2001 e Legge 31 aprile 2001 n.6")[0]
    assert [(c.tipo, c.anno, c.numero, c.data) for c in each] == [("Legge", 2001, 5, None), ("Legge", 2001, 6, dt.date(2001, 5, 1))]


def test_cited_keys_are_those_of_the_citations(spark):
    r = random.Random(5)
    bits = ["Legge", "DECRETO", "-", "legge di Revisione Costituzionale", "Legge Qualificata", "Regolamento", "n.", "n° ", "numero", "N.", "\xa0", "12", "31", "2001", "0012", "99999999999", "2147483648", "marzo", "MAGGIO", "brumaio", "/", ",", "º", "\U0001f600", "ſ", "٣", "13 maggio 2001 n. 4", "n.8/1999", "12 marzo 2001, numero 7"]
    titles = ["".join(r.choice(bits) + r.choice(["  ", " ", ""]) for _ in range(r.randint(1, 14))) for _ in range(4000)]
    key = lambda c: legal.act_key(c["tipo"], c["anno"], c["numero"])
    want = values(spark, lambda a: F.array_distinct(F.filter(F.transform(legal.citations(a), key), lambda k: k.isNotNull() & (k != "o:2001/4"))), *titles)
    assert [legal.keys_of(t, "o:2001/4") for t in titles] == want and sum(map(len, want)) > 100


def test_clean_text(spark):
    raw = "a  b  \r\n- 12 -\r\n\r\n\r\n\r\nc\f3\nd 4\n"
    assert values(spark, legal.clean_text, raw, "", None) == ["a b\n\nc\nd 4", "", None]


@pytest.mark.parametrize(
    ("data", "want"),
    [
        (b"modalit\xe0", "modalità"), ("40° anniversario".encode(), "40° anniversario"), (b"all\x92esportazione", "all’esportazione"),
        (b"\xe0 e " + "è".encode(), "à e è"), (b"\x80\x81\xc3", "€\x81Ã"), (b"\xed\xa0\x80", "í\xa0€"),
    ],
)
def test_mixed_encodings(data, want):
    assert decode.mixed_text(data) == want


def test_zip_choice():
    import io
    import zipfile

    def packed(**files):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            for name, data in files.items():
                z.writestr(name, data)
        return out.getvalue()

    assert decode.document_text(packed(**{"a CON NOTE.pdf": b"x" * 9, "b senza note.PDF": b"plain"}), bytes.decode) == "plain"
    assert decode.document_text(packed(**{"a.pdf": b"x", "b.pdf": b"longer", "c.txt": b"x" * 99}), bytes.decode) == "longer"
    assert decode.document_text(b"%PDF", bytes.decode) == "%PDF"
    with pytest.raises(ValueError, match="no PDF"):
        decode.document_text(packed(**{"c.txt": b"x"}), bytes.decode)


def test_links():
    base = "https://host.example/a/b.html"
    assert urls.resolve("/x y", base) == "https://host.example/x%20y"
    assert urls.resolve("c", base) == "https://host.example/a/c"
    assert urls.resolve("http://o.example/z", base) == "http://o.example/z"
    assert urls.resolve("c", None) == "c" and urls.resolve("c", None, strict=True) is None
    assert urls.resolve("http://[", base) == "http://[" and urls.resolve("http://[", base, strict=True) is None
    assert urls.resolve(None, base) is None
