"""All registered queries of the catalogue engine, with the SQL that checks them."""

from __future__ import annotations

from . import layout_queries, record_queries, segment_queries, source_queries, text_queries

_MODULES = (text_queries, segment_queries, layout_queries, record_queries, source_queries)


def queries() -> dict:
    return {name: query for m in _MODULES for name, query in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, sql in m.SQL.items()}
