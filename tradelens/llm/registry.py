"""Queries of this subpackage with their DuckDB twins (None: tested against brute force)."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

QUERIES: dict[str, Callable] = {}
SQL: dict[str, str] = {}

MODULES = ("q_repeats", "q_tokens", "q_fingerprints", "q_vectors", "q_classify", "q_pii", "q_jaccard", "q_runs", "q_audit", "q_exact")


def register(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return add


def load_all() -> dict[str, Callable]:
    for module in MODULES:
        import_module(f"tradelens.llm.{module}")
    return QUERIES
