"""Physical plans: what must reach the scan, what must not shuffle, and the driver's contract."""

import __spark_entry__ as entry
from lodestrand.plans import queries


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scalar_queries_do_not_shuffle(spark, sf):
    for name in ("title_normalize", "date_rfc_roundtrip", "deadline_utc", "html_items", "act_key", "clean_text", "mixed_decode"):
        assert "Exchange" not in plan(queries.queries()[name](spark, sf)), name


def test_only_needed_columns_are_read(spark, sf):
    text = plan(queries.queries()["title_normalize"](spark, sf))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text
    assert "lang" not in text


def test_contract():
    found = entry.queries()
    assert set(entry.oracle_sql()) <= set(found) and len(found) >= 60


def test_entry(spark):
    assert entry.entry(spark).columns == ["titolo", "estratto", "url", "data", "fonte_id", "dedup_key"]


def test_titles_are_searched_once(spark, sf):
    # no second evaluation for a filter that the optimizer infers, no chain of higher-order functions over each title
    for name in ("citations", "citation_graph", "recalled_by"):
        text = plan(queries.queries()[name](spark, sf))
        assert text.count("ArrowEvalPython [") == 1 and "regexp_extract_all" not in text, name


def test_pages_are_parsed_once(spark, sf):
    # no second evaluation for a filter on the array's size, no worker for each column
    for name in ("notices_parse", "notices_limit", "archive_listing", "archive_category", "archive_index", "html_items", "html_attr", "mixed_decode"):
        assert plan(queries.queries()[name](spark, sf)).count("ArrowEvalPython [") == 1, name
