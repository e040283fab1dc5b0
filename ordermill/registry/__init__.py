"""Registered queries: name -> callable(session, folder), each with its comparison SQL."""

from __future__ import annotations

from ordermill.registry import checking, loading, reporting, running, transforming

_MODULES = (reporting, checking, transforming, loading, running)


def all_queries() -> dict:
    return {name: query for module in _MODULES for name, query in module.QUERIES.items()}


def all_sql() -> dict:
    return {name: text for module in _MODULES for name, text in module.SQL.items()}
