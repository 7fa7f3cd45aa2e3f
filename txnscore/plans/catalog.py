"""All registered queries and their oracle SQL."""

from __future__ import annotations

from . import batch, encoders, ml, reports, streams  # noqa: F401  (registers queries)
from .oracle import SQL
from .registry import QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return {k: v for k, v in SQL.items() if k in QUERIES}
