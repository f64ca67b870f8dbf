"""The registered queries of the engine, each with its SQL where SQL can say it."""

from __future__ import annotations

from siftline.plans import census_queries, document_queries, review_queries, session_queries, stream_queries, text_queries
from siftline.plans.registry import ORACLES, QUERIES, Query

MODULES = (census_queries, session_queries, text_queries, review_queries, stream_queries, document_queries)


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
