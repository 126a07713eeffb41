"""Decorator that registers a query with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from . import derived

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, relations: tuple[str, ...] = ()) -> Callable:
    """Register ``f(get)``, where ``get(relation)`` is a DataFrame, as ``name``; ``sql`` reads ``relations``."""

    def add(f: Callable) -> Callable:
        QUERIES[name] = lambda spark, sf_dir: f(lambda relation: derived.frame(spark, sf_dir, relation))
        if sql is not None:
            ORACLES[name] = derived.with_tables(sql, *relations) if relations else sql
        return f

    return add
