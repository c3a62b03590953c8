"""Queries on tables made for one case, against their SQL."""

import duckdb

from lodestrand.plans import queries


def agrees(spark, folder, name, **tables):
    """Writes the tables (SQL of each) and compares the rows of a query with those of its SQL; returns the rows."""
    con = duckdb.connect()
    for t, sql in tables.items():
        con.execute(f"copy ({sql}) to '{folder}/{t}.parquet' (format parquet)")
        con.execute(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet')")
    df = queries.queries()[name](spark, str(folder))
    names = sorted(df.columns)
    got = sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr)
    sql = con.sql(queries.oracle_sql()[name])
    want = sorted((tuple(r[sql.columns.index(c)] for c in names) for r in sql.fetchall()), key=repr)
    assert got == want and got
    return got


def test_entities_cut_off(spark, tmp_path):
    titles = "unnest(['Uno &amp; due&amp', 'Uno &am', '&copy &quot;x&quot', 'a&amp;amp', 'due &']) AS t"
    html = "'<article><h1>' || t || '</h1><p>' || t || ' e un testo di pagina abbastanza lungo per contare &copy</p></article>'"
    pages = f"SELECT row_number() OVER () AS page_id, 'https://x.example/' || t AS url, {html} AS html FROM (SELECT {titles})"
    agrees(spark, tmp_path, "html_items", pages=pages)
    agrees(spark, tmp_path, "institutional_body", pages=pages)
