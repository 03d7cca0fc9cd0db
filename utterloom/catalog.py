"""All registered queries of the engine and their DuckDB equivalents."""

from __future__ import annotations

from utterloom.plans import audio, datasets, retrieval, segments, sessions, texts  # noqa: F401  registers
from utterloom.registry import QUERIES, SQL, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
