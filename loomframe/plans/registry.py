"""Queries over the driver's tables and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Registers a function (spark, sf_dir) -> DataFrame under name, with its SQL."""

    def add(f: Callable) -> Callable:
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add
