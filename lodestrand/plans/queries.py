"""All registered queries of the ingestion engine."""

from __future__ import annotations

from . import q_dates, q_legal, q_pages, q_runs, q_titles  # noqa: F401  (each registers its queries)
from .registry import ORACLE, QUERIES


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
