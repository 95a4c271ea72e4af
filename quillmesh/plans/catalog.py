"""All core queries by name."""

from __future__ import annotations

from .registry import Query


def _parts():
    from . import cleaning, documents, functions, graph, quality, text

    return [functions.R, cleaning.R, graph.R, text.R, quality.R, documents.R]


def queries() -> dict[str, Query]:
    return {k: v for r in _parts() for k, v in r.queries.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for r in _parts() for k, v in r.sql.items()}
