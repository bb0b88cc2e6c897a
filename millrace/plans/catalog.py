"""All registered queries."""

from __future__ import annotations

from millrace.plans import reading_queries, series_queries, stream_queries, text_queries  # noqa: F401
from millrace.plans.registry import ORACLES, QUERIES, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
