"""Registers queries under their inventory id, with the DuckDB SQL that has to give the same rows."""

from __future__ import annotations

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE_SQL[name] = sql
        return fn

    return add
