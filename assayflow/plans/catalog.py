"""All registered queries over the test tables."""

from __future__ import annotations

from . import articles, records, scalars, sheets  # noqa: F401  (they register their queries)
from .registry import ORACLES, QUERIES


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
